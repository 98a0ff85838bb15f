import re
from collections import Counter

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa

from emberline.llm import textbytes as tb
from emberline.llm.quality_lines import measured, quality_rules, without_lines
from pyspark.sql import functions as F
from tests.llm.cases import AWKWARD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_counts_of_real_rows(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    got = quality_rules(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    want = dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    assert len(got) == len(want)
    for r in got:
        b = base(want[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é ", max_size=80)), max_size=6))
def test_base_counts(texts):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "host": pa.array(["h"] * len(texts), pa.string()), "text": pa.array(texts, pa.string())})
    got = [tuple(r.values())[2:7] for b in measured([batch]) for r in b.to_pylist()]
    assert got == [base(t) for t in texts]


def test_awkward(spark):
    got = {r.doc_id: r for r in quality_rules(frame(spark, AWKWARD)).collect()}
    assert len(got) == len(AWKWARD)
    for i, t in AWKWARD:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t)
    assert quality_rules(frame(spark, [])).count() == 0


def test_frequent_lines(spark):
    rng = np.random.default_rng(1)
    own = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**6, 40))
    note = "All  rights reserved by the Owners of this site"
    pairs = [(i, f"{own()}\n{note.upper() if i % 2 else note}\n{own()}") for i in range(40)]
    copies = [(100 + i, f"{note} {pairs[0][1]}") for i in range(30)]  # exact copies count once
    got = {r.doc_id: r for r in quality_rules(frame(spark, pairs + copies)).collect()}
    assert all(got[i].kept for i, _ in pairs) and got[0].n_lines_removed == 0
    assert all(got[i].n_lines_removed == 1 and list(got[i].drop_lines) == [1] for i in range(1, 40))
    assert all(got[i].kept and got[i].n_lines_removed == 1 for i, _ in copies)  # the note alone
    assert quality_rules(frame(spark, pairs, source=lambda i: f"h{i // 8}")).where("n_lines_removed > 0").count() == 0
    left = frame(spark, pairs[:5]).join(quality_rules(frame(spark, pairs)).select("doc_id", "drop_lines"), "doc_id")
    left = {r.doc_id: r.t for r in left.select("doc_id", without_lines(F.col("text"), F.col("drop_lines")).alias("t")).collect()}
    assert left[0] == pairs[0][1] and left[3] == "\n".join(x for k, x in enumerate(pairs[3][1].split("\n")) if k != 1)


def test_depleted_documents_go(spark):
    lines = [" ".join(f"shared{k}x{j}" for j in range(10)) for k in range(6)]
    pairs = [(i, "\n".join(lines) + f"\nown{i}") for i in range(30)]
    got = {r.doc_id: r for r in quality_rules(frame(spark, pairs), max_share=0.01).collect()}
    assert got[0].kept and not any(got[i].kept for i in range(1, 30))
    assert all(got[i].n_words_left == 1 for i in range(1, 30))


def test_copies_and_empty_documents_hide_no_boilerplate(spark):
    note = "All rights reserved by the owners of this site"
    pairs = [(k * 15 + i, f"{' '.join(f'w{i}x{j}' for j in range(30))}\n{note}") for k in range(100) for i in range(15)]
    pairs += [(10_000 + i, " \n" if i % 2 else None) for i in range(500)]
    got = {r.doc_id: r for r in quality_rules(frame(spark, pairs)).collect()}  # 15 of 2000 rows, of 15 bodies
    assert got[0].n_lines_removed == 0 and all(got[i].n_lines_removed == 1 for i in range(1, 1500))


def test_key_does_not_depend_on_place():
    text = np.frombuffer(b"one two one " + b"y" * (1 << 19) + b" one", np.uint8)
    w = tb.words(text, np.array([0, len(text)]), lower=False)
    assert w.key[0] == w.key[2] == w.key[4] and w.key[0] != w.key[1]
