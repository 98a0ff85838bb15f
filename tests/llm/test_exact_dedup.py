import hashlib
import re
from collections import defaultdict

from emberline.llm.exact_dedup import exact_dedup
from tests.llm.cases import AWKWARD, frame


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}


def test_awkward(spark):
    want = brute(AWKWARD)
    for whole in (True, False):
        got = exact_dedup(frame(spark, AWKWARD), digest_all=whole).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {i: w[:2] for i, w in want.items()}
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
        assert all(r.digest in (want[r.doc_id][2], None if not whole else "") for r in got)


def test_empty_and_null_ids(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    got = sorted(map(tuple, exact_dedup(frame(spark, [(None, "a"), (2, "a "), (2, "a "), (None, "b"), (4, "a")])).drop("digest").collect()), key=str)
    assert (2, 2, 4, True) in got and got.count((2, 2, 4, True)) == 2
    assert (None, 2, 4, False) in got and (None, None, 1, True) in got and (4, 2, 4, False) in got
