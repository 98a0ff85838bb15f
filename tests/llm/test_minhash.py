import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from emberline.llm.components import components
from emberline.llm.minhash import near_duplicates, op3_minhash
from tests.llm.cases import AWKWARD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(pairs, n, percent=80):
    sets = {}
    for i, t in pairs:
        w = WORD.findall((t or "").translate(FOLD))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        meet = Counter(j for g in s for j in index[g])
        for g in s:
            index[g].append(i)
        for j, k in meet.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_query_equals_brute_force(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    want = brute(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()), 2)
    got = op3_minhash(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_and_large_groups(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    pairs = []
    for i in range(150):  # a chain: its ends have little in common
        base[rng.randrange(len(base))] = f"c{i}"
        base[rng.randrange(len(base))] = f"d{i}"
        pairs.append((1000 - i, " ".join(base)))
    hub = [f"h{rng.randrange(10**6)}" for _ in range(60)]
    for i in range(200):  # near copies of one text
        own = list(hub)
        own[rng.randrange(60)] = f"x{i}"
        pairs.append((2000 + i, " ".join(own)))
    for i in range(100):  # half the text in common: not near
        pairs.append((3000 + i, " ".join(hub[:30] + [f"y{i}x{k}" for k in range(30)])))
    for n in (2, 5):
        got = near_duplicates(frame(spark, pairs), words=n).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(pairs, n)


def test_awkward(spark):
    got = near_duplicates(frame(spark, AWKWARD), words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(AWKWARD, 2)
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "a b c"), (7, "a b c"), (7, "a b c"), (8, "q r s"), (8, "A  B c"), (None, "z z"), (9, None)]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(frame(spark, rows), words=2).collect())
    assert got == sorted([("None", 2, "7", False), ("7", 2, "7", True), ("7", 2, "7", True), ("8", 2, "8", True), ("8", 2, "7", False), ("None", 1, "None", True), ("9", 0, "9", True)])
    with pytest.raises(ValueError):
        near_duplicates(frame(spark, []), percent=50)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(500, 501 + i) for i in range(50)] + [(3, 3), (None, 4)]
    up = {}
    for a, b in links:
        if a is not None and a != b:
            up.setdefault(a, a), up.setdefault(b, b)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a in up and b in up and a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in up} and len(got) == len(up)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
