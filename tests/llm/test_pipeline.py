"""The pipeline's stages against brute force, each on its own input."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline as cp
from emberline.llm import bpe
from emberline.llm.quality_lines import MAX_DOCS, MAX_SHARE, MIN_LEFT
from tests.llm.cases import AWKWARD, SCHEMA, frame
from tests.llm.test_minhash import FOLD, WORD
from tests.llm.test_minhash import brute as near_brute
from tests.llm.test_packing import gapless
from tests.llm.test_quality_lines import base

tokenizers = pytest.importorskip("tokenizers")


def quality_brute(rows):
    """(id, text, host) of what the rules keep."""
    parsed = []
    for k, (i, t, host) in enumerate(rows):
        lines = [tuple(WORD.findall(x.translate(FOLD))) for x in (t or "").split("\n")]
        parsed.append((i, k, host, [x for x in lines if x]))
    bodies, n_docs = defaultdict(dict), defaultdict(set)
    for i, k, host, lines in parsed:
        if lines:
            n_docs[host].add(tuple(lines))  # documents of one body are one, empty ones none
        for x in set(lines):
            known = bodies[host, x].setdefault(tuple(lines), (i, k))
            bodies[host, x][tuple(lines)] = min(known, (i, k))
    keeper = {key: min(b.values()) for key, b in bodies.items() if len(b) > MAX_DOCS and len(b) > len(n_docs[key[0]]) * MAX_SHARE}
    out = []
    for (i, t, host), (_, k, _, lines) in zip(rows, parsed):
        n_words, _, _, _, n_repeat = base(t)
        drop = [x for x in lines if (host, x) in keeper and keeper[host, x] != (i, k)]
        left = n_words - sum(map(len, drop))
        if n_words >= 20 and 100 * n_repeat <= 30 * n_words and left >= n_words * MIN_LEFT:
            gone = set(drop)
            out.append((i, "\n".join(x for x in t.split("\n") if tuple(WORD.findall(x.translate(FOLD))) not in gone or not WORD.search(x)), host))
    return out


def exact_brute(rows):
    best = {}
    for i, t, host in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", "", t)
        if key not in best or (-len(t), i) < (-len(best[key][1]), best[key][0]):
            best[key] = (i, t, host)
    return list(best.values())


def repeats_brute(rows, length=200, least=50):
    places = defaultdict(int)
    for _, t, _ in rows:
        b = t.encode()
        for k in range(len(b) - length + 1):
            places[b[k : k + length]] += 1
    out = []
    for i, t, host in rows:
        b = t.encode()
        gone = np.zeros(len(b) + 1, np.int8)
        for k in range(len(b) - length + 1):
            if places[b[k : k + length]] > 1:
                gone[k : k + length] = 1
        step = np.diff(gone, prepend=0)
        for x, y in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            if len(b[x:y].split()) < least:
                gone[x:y] = 0
        # a character goes only with all its bytes
        edge = [k for k, x in enumerate(b) if x & 0xC0 != 0x80] + [len(b)]
        out.append((i, b"".join(b[x:y] for x, y in zip(edge, edge[1:]) if not gone[x:y].all()).decode(), host))
    return out


def near_kept(rows):
    found = near_brute([r[:2] for r in rows], 5)
    return [r for r in rows if found[r[0]][1] == r[0]]


def rows_of(df):
    return sorted((r.doc_id, r.text, r.source) for r in df.collect())


def by_steps(spark, rows, docs):
    """Holds each stage's rows against brute force; returns the brute-force rows and the last result."""
    columns = docs.columns
    for (name, stage), brute in zip(cp.STAGES, (quality_brute, exact_brute, near_kept, repeats_brute)):
        docs = stage(spark, docs, None).cache()
        rows = brute(rows)
        assert docs.columns == columns and rows_of(docs) == sorted(rows), name
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    return rows, cp.STAGES[-1][1](spark, docs, None).collect()


def test_stages_on_real_rows(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows, got = by_steps(spark, [(d["doc_id"], d["text"], d["source"]) for d in t], docs)
    library = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    total = {i: len(library.encode(x, add_special_tokens=False).ids) + 1 for i, x, _ in rows}
    found = defaultdict(int)
    for r in got:
        found[r.doc_id] += r.length
    assert found == total and 0 < len(total) < len(t)
    gapless([(r.length, r.sequence_id, r.offset) for r in got], 2048)
    whole = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got)


def test_planted_cases(spark):
    rng = random.Random(7)
    words = lambda n: " ".join(f"{rng.choice('abcdefg')}{rng.randrange(10**5)}" for _ in range(n))
    pairs = [(i, words(60)) for i in range(40)]
    pairs += [(100 + i, pairs[0][1].replace(" ", "  ")) for i in range(3)]  # exact copies, longer
    pairs += [(200 + i, pairs[1][1] + " " + words(3)) for i in range(3)]  # near copies
    passage = words(90)
    pairs += [(300 + i, words(40) + "\n" + passage + "\n" + words(40)) for i in range(4)]  # a passage in all
    note = "subscribe to our letter é now"
    pairs += [(400 + i, words(50) + f"\n{note}\n" + words(30)) for i in range(15)]
    pairs += [(500, "short"), (501, "same words " * 50)]
    rng.shuffle(pairs)
    rows, _ = by_steps(spark, [(i, t, "s") for i, t in pairs], frame(spark, pairs))
    left = {i: t for i, t, _ in rows}
    assert set(range(40)) - {0} <= set(left) and not {500, 501} & set(left)
    assert len({0, 100, 101, 102} & set(left)) == 1 and len({1, 200, 201, 202} & set(left)) == 1
    assert all(passage[50:-50] not in left[300 + i] for i in range(4)) and sum(note in left[400 + i] for i in range(15)) == 1


def test_awkward_rows(spark):
    text = " ".join(f"w{k}" for k in range(50))
    more = [(None, text), (None, text), (70, text + " x"), (70, text + " x"), (70, text.upper() + " other " + " ".join(f"v{k}" for k in range(60))), (None, None)]
    docs = spark.createDataFrame([(i, t, None, None, None, None, "k") for i, t in AWKWARD + more], SCHEMA)
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == SCHEMA.names, name
    left = rows_of(docs.fillna({"doc_id": -1}))
    assert [r[0] for r in left].count(70) == 2 and not {1, 2, 3, 5} & {r[0] for r in left}
    assert cp.STAGES[-1][1](spark, docs, None).count() >= len(left)
    docs = frame(spark, [])
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, None)
    assert docs.count() == 0 and cp.STAGES[-1][1](spark, docs, None).count() == 0


@pytest.mark.parametrize("names", [["row", "id", "key", "drop", "n", "digest"], ["left", "row_key", "row_digest", "_text", "_id", "_drop"], ["_n", "_row", "_k", "_key", "a b.c", "component"]])
def test_clashing_names(spark, names):
    text = lambda i: " ".join(f"{i}w{k}" for k in range(40))
    pairs = [(i, text(i % 7)) for i in range(12)] + [(20, text(3) + " more")]
    docs = spark.createDataFrame([(i, t, "s", *[f"{n}{i}" for n in names]) for i, t in pairs], ["doc_id", "text", "source", *names])
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == ["doc_id", "text", "source", *names]
    rows = docs.collect()
    assert len(rows) == 7 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert cp.STAGES[-1][1](spark, docs, None).count() == 7


def test_columns_of_any_type(spark):
    text = lambda i: " ".join(f"{i}w{k}" for k in range(40))
    schema = "doc_id long, text string, source string, m map<string,int>, deep array<struct<m:map<int,array<map<string,string>>>,v:double>>"
    rows = [(i, text(i % 5), "s", {"a": i, "b": 2} if i % 2 else None, [({1: [{"x": str(i)}, {}], 2: None}, 0.5), None] if i % 3 else None) for i in range(9)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    left = {r.doc_id: r for r in docs.collect()}
    assert len(left) == 5
    for i, r in left.items():
        _, _, _, m, deep = rows[i]
        assert r.m == m and (r.deep is None) == (deep is None)
        assert deep is None or (r.deep[0].m == deep[0][0] and r.deep[0].v == 0.5 and r.deep[1] is None)
