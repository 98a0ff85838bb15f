import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import induced
from emberline.llm.induced import suffixes
from emberline.llm.repeats import op9_suffix_array, remove_repeats
from tests.llm.cases import AWKWARD, frame


def brute(texts, length):
    places = defaultdict(int)
    for t in texts:
        for i in range(len(t) - length + 1):
            places[t[i : i + length]] += 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if places[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(texts, length, least):
    places = defaultdict(int)
    for t in texts:
        for i in range(len(t) - length + 1):
            places[t[i : i + length]] += 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, np.int8)
        for i in range(len(t) - length + 1):
            if places[t[i : i + length]] > 1:
                gone[i : i + length] = 1
        step = np.diff(gone, prepend=0)
        size = [b - a for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)) if len(t[a:b].split()) >= least]
        out.append((len(size), int(sum(size))))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.sampled_from([3, 100]), st.sampled_from([(1 << 20, 1 << 20), (64, 2)]))
def test_induced_order_and_prefixes(text, depth, limits):
    parts = list(suffixes(np.array(text + text[:7]), depth, *limits))[::-1]
    text = text + text[:7]
    at, shared = (np.concatenate(c).tolist() for c in zip(*parts))
    assert sorted(at) == list(range(len(text)))
    heads = [text[i : i + depth] for i in at]
    for x, y, n in zip(heads, heads[1:], shared[1:]):
        assert x <= y
        assert n == next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))


def test_query_equals_brute_force(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    want = dict(zip(t["doc_id"].to_pylist(), brute([(x or "").encode() for x in t["text"].to_pylist()], 400)))
    rows = op9_suffix_array(spark, "/root/testdata/sf0.001").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == want and sum(w[1] for w in want.values()) > 0
    want = dict(zip(t["doc_id"].to_pylist(), passages([(x or "").encode() for x in t["text"].to_pylist()], 200, 50)))
    assert {r.doc_id: (r.n_passages, r.n_passage_bytes) for r in rows} == want and sum(w[0] for w in want.values()) > 0


@pytest.mark.parametrize("length", [8, 40])
def test_planted_and_periodic(spark, length):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 5)))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) + (passage[: rng.randint(20, 90)] if i % 3 == 0 else "") for i in range(60)]
    texts += ["ab" * 50, "ab" * 33 + "x", "a" * 90, texts[0], texts[0][5:], "", None]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, list(enumerate(texts))), length=length).collect()}
    want = brute([(t or "").encode() for t in texts], length)
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.start), hashlib.sha256(r.kept).hexdigest()) == w
    whole = remove_repeats(frame(spark, list(enumerate(texts))), length=length, characters=True).collect()
    assert all(bytes(r.kept).decode() is not None and len(r.kept) >= len(got[r.doc_id].kept) for r in whole)


def test_spills_and_recursion(spark, monkeypatch):
    """A shard several times the sorter's memory: entries go to disk, names are sorted by induction twice over."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("ab", "abé", "b", "aab")) for _ in range(120)) for _ in range(60)]
    texts += [t[40:300] for t in texts[:20]]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, list(enumerate(texts))), length=40, memory=4096, in_memory=16, passages=(20, 3)).collect()}
    want, runs = (f([t.encode() for t in texts], *a) for f, a in ((brute, (40,)), (passages, (20, 3))))
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.start), hashlib.sha256(r.kept).hexdigest()) == w
        assert (len(r.passage_start), sum(r.passage_end) - sum(r.passage_start)) == runs[i]
    calls, spills = [], []
    inner, spill = induced.starred_order, induced.Queue._spill
    monkeypatch.setattr(induced, "starred_order", lambda text, *a: calls.append(len(text)) or inner(text, *a))
    monkeypatch.setattr(induced.Queue, "_spill", lambda self: spills.append(self.held) or spill(self))
    text = np.frombuffer("".join(texts).encode(), np.uint8).astype(np.int16)
    assert sum(len(at) for at, _ in suffixes(text, 40, 4096, 16)) == len(text)
    assert len(calls) >= 3 and calls[0] > 2 * calls[1] > 4 * calls[2] and spills


def test_awkward(spark):
    pairs = AWKWARD + [(None, "z" * 900), (None, None)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept)) for r in remove_repeats(frame(spark, pairs)).collect())
    want = brute([(t or "").encode() for _, t in pairs], 400)
    assert got == sorted((str(i), w[0], w[1]) for (i, _), w in zip(pairs, want))
    assert remove_repeats(frame(spark, [])).count() == 0
