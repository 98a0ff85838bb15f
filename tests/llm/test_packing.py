import random
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from emberline.llm import bpe
from emberline.llm.packing import best_fit, op6_best_fit_packing, pack, pieces
from tests.llm.cases import AWKWARD, frame

tokenizers = pytest.importorskip("tokenizers")


def gapless(rows, capacity):
    bins = defaultdict(list)
    for size, seq, off in rows:
        bins[seq].append((off, size))
    for items in bins.values():
        at = 0
        for off, size in sorted(items):
            assert off == at
            at += size
        assert at <= capacity
    return len(bins)


def test_best_fit_is_tightest():
    assert best_fit([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]


def test_query(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    library = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    want = {}
    for i, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist()):
        ids = library.encode(x or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 2048):
            part = ids[p : p + 2048]
            want[i, p // 2048] = (p, len(part), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in part)))
    got = op6_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    bins = gapless([(r.length, r.sequence_id, r.offset) for r in got], 2048)
    assert bins <= 1.02 * -(-sum(w[1] for w in want.values()) // 2048) + 1


@pytest.mark.parametrize("group", [50, 100_000])
def test_tree_of_groups(spark, group):
    rng = random.Random(3)
    sizes = [rng.choice([0, 1, 7, 100, 100, 100]) if rng.random() < 0.5 else rng.randint(1, 100) for _ in range(3000)] + [None]
    got = pack(spark.createDataFrame([(i % 50, s) for i, s in enumerate(sizes)], "id long, length long"), capacity=100, group=group, room=1).collect()
    assert sorted((r.id, r.length or 0) for r in got) == sorted((i % 50, s or 0) for i, s in enumerate(sizes))
    bins = gapless([(r.length or 0, r.sequence_id, r.offset) for r in got if r.length], 100)
    assert bins <= 1.03 * sum(s or 0 for s in sizes) / 100 + 2


def test_awkward(spark):
    got = pack(pieces(frame(spark, AWKWARD))).collect()
    assert {r.doc_id for r in got} == {i for i, _ in AWKWARD}
    assert {r.doc_id: r.length for r in got if r.doc_id in (2, 3, 5, 10)} == {2: 1, 3: 1, 5: 1, 10: 1}
    gapless([(r.length, r.sequence_id, r.offset) for r in got], 2048)
    assert pack(pieces(frame(spark, []))).count() == 0
    with pytest.raises(Exception, match="larger than the capacity"):
        pack(spark.createDataFrame([(3000,)], "length long")).count()


def test_groups_merge_though_no_bin_fills(spark):
    items = spark.createDataFrame([(i, 40) for i in range(64)], "id long, length long")
    got = pack(items, capacity=100, group=4, fan=2, room=1).collect()
    assert len(got) == 64 and gapless([(r.length, r.sequence_id, r.offset) for r in got], 100) == 32
