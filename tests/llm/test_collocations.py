"""Collocations against a plain count, and keys that meet."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from emberline.llm import collocations as co
from emberline.llm import textbytes as tb
from tests.llm.cases import AWKWARD, SCHEMA


def brute(rows, most, least, absorbed, top):
    f = Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for size in range(1, most + 1):
                f.update(("und" if lang is None else lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    out = []
    for lang in {k for k, _ in f}:
        n = sum(v for (g, p), v in f.items() if g == lang and len(p) == 1)
        cand = {p: v for (g, p), v in f.items() if g == lang and len(p) > 1 and v >= least}
        rank = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= absorbed * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            s, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            rank.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rank)[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0, "r", "k") for i, (g, t) in enumerate(rows)], SCHEMA)


def made(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "B", "the", "é", "ẞx", "of", "the", "the", "zu m", "\U0001f600"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]
    text = lambda: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60)))
    return [(rng.choice(["en", "de", None, "und"]), text()) for _ in range(n)]


@pytest.mark.parametrize("most,least,absorbed,top", [(2, 2, 50, 2000), (3, 3, 50, 7), (5, 2, 80, 2000)])
def test_equals_plain_count(spark, most, least, absorbed, top):
    rows = made(most) + [("en", t) for _, t in AWKWARD] + [(None, None), ("", "x y x y x y"), ("en", ""), ("en", "the " * 3000)]
    got = rows_of(co.collocations(frame(spark, rows), most, least, absorbed, top))
    assert got == brute(rows, most, least, absorbed, top) and len(got) > 10


def test_small_steps_and_hot_prefixes(spark, monkeypatch):
    rows = made(9, 80)
    want = brute(rows, 3, 3, 50, 2000)
    monkeypatch.setattr(co, "HOT_PARTS", 40)
    monkeypatch.setattr(co, "HELD", 50)  # for the driver's process; workers add up at their own pace
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows_of(co.collocations(frame(spark, rows).repartition(5), least=3)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_tables(spark):
    assert co.collocations(frame(spark, [("en", "a b")]).limit(0)).count() == 0
    assert co.collocations(frame(spark, [("en", None), (None, "")])).count() == 0
    got = co.collocations(frame(spark, [("en", "a b. " * 10)]))
    assert rows_of(got) == [("en", 1, "a b", 10, 10, 10, 20, 1000000)]
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_keys_that_meet_are_noticed(monkeypatch):
    import pyarrow as pa

    batch = pa.record_batch([pa.array(["en"]), pa.array(["one two"])], names=["lang", "text"])
    monkeypatch.setattr(tb, "keys", lambda text, start, end, table=None: np.ones(len(start), np.uint64))
    with pytest.raises(co.Clash):
        list(co.counted(0)(iter([batch])))


def test_rows_of_one_hash_are_compared(monkeypatch):
    monkeypatch.setattr(tb, "mix", lambda x: x * np.uint64(0))
    keys = np.array([[1, 2, 3], [1, 2, 4], [1, 2, 3], [5, 2, 3]], np.uint64)
    first, n = co.summed(keys, np.array([1, 1, 5, 2]))
    assert sorted((tuple(keys[f].tolist()), c) for f, c in zip(first, n)) == [((1, 2, 3), 6), ((1, 2, 4), 1), ((5, 2, 3), 2)]
