"""Counts of windows, and the join without the last row, against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import window_cells as wc
from emberline.operators import window_counts as wn
from emberline.operators import window_join as wj
from tests.test_window_cells import DETECTION, HOUR, POINT, T0, made


@pytest.mark.parametrize("n", [1, 2, 7, 64, 300])
def test_before_equals_a_scan(n):
    rng = np.random.default_rng(n)
    us, x, y = np.sort(rng.integers(0, 40, n)), rng.integers(0, 9, n).astype(float), rng.integers(0, 9, n).astype(float)
    ends, x0, x1, y0, y1 = rng.integers(-5, 50, 200), *(rng.integers(-1, 11, 200).astype(float) for _ in range(4))
    want = [((us < e) & (x >= a) & (x <= b) & (y >= c) & (y <= d)).sum() for e, a, b, c, d in zip(ends, x0, x1, y0, y1)]
    assert wn.before(us, x, y, ends, x0, x1, y0, y1).tolist() == want


def test_counts_equal_the_join_and_no_pair_is_a_row(spark):
    p, d = made(spark, 9, 60, 1500)
    windows = wj.standard_windows()
    mark = F.col("det_id") % 3 == 0
    got = sorted(tuple(r) for r in wn.counted(p, d, windows, mark=mark).collect())
    pairs = wj.window_join(p, d, windows).groupBy("point_id", "layer").agg(F.count("*"), F.count_if(mark))
    assert got == sorted(tuple(r) for r in pairs.collect()) and len(got) > 100
    assert "gx" not in wj.window_counts(p, d, windows)._jdf.queryExecution().optimizedPlan().toString()


def test_last_is_left_out_before_the_pairs_are_made(spark):
    rng = random.Random(2)
    p = [(i, T0 + rng.randrange(-30, 30) * HOUR, 0.0, 0.0) for i in range(40)]
    d = [(i, T0 + rng.randrange(-40, 40) * HOUR, float(rng.randrange(3)), float(rng.randrange(3))) for i in rng.sample(range(500), 200)]
    got = wj.window_join_drop_last(spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION), [(0, "now", -5, 5)])
    want = set()
    for i, t, *_ in p:
        last = max((r[1:], r[0]) for r in d if r[1] < t + 5 * HOUR)[1] if any(r[1] < t + 5 * HOUR for r in d) else None
        want |= {(i, r[0]) for r in d if t - 5 * HOUR <= r[1] < t + 5 * HOUR and r[0] != last}
    assert {(r.point_id, r.det_id) for r in got.collect()} == want and len(want) > 500
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # the join that makes pairs is the topmost, so they are joined with nothing more
    assert "Inner" in next(line for line in plan.splitlines() if "Join" in line)


def test_a_task_counts_few_detections_at_once(spark, monkeypatch):
    p, d = made(spark, 10, 40, 1200, 2e4)
    windows, mark = wj.standard_windows(), F.col("det_id") % 3 == 0
    want = sorted(tuple(r) for r in wn.counted(p, d, windows, mark=mark).collect())
    pairs = wj.window_join(p, d, windows).groupBy("point_id", "layer").agg(F.count("*"), F.count_if(mark))
    assert want == sorted(tuple(r) for r in pairs.collect()) and len(want) > 150
    for batch in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            rows = wc.dealt(p, d, windows, 22500, 375, mark, points_first=True).toArrow().to_batches(int(batch))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        most, plain = [], wn.before
        with monkeypatch.context() as m:
            m.setattr(wn, "CHUNK", 32)
            m.setattr(wn, "before", lambda us, *more: most.append(len(us)) or plain(us, *more))
            run = wn._counted(np.array([(w[2] * wn.HOUR, w[3] * wn.HOUR) for w in windows]), [w[0] for w in windows], 11250.0, True)
            got = {}
            for part in run(iter(rows)):
                for r in part.to_pylist():
                    k = (r["point_id"], r["layer"])
                    got[k] = [a + b for a, b in zip(got.get(k, (0, 0)), (r["n"], r["n_marked"]))]
        assert sorted((*k, *v) for k, v in got.items()) == want
        assert max(most) == 32 and len(most) > 50
