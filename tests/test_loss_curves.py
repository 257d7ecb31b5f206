"""Loss curves vs plain sequential loops over random histories."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collidex.operators import evaluate as EVL


def _smooth_loop(losses, batch):
    out, acc = [], 0.0
    for it, v in enumerate(losses):
        acc += v
        if it % batch == 0 and it > 0:
            out.append((it, acc / batch))
            acc = 0.0
    return out


def _curve_loop(histories, bucket):
    n = max(len(h) for h in histories)
    res, ms, ss = [], [], []
    for i in range(n):
        vals = [h[i] for h in histories if i < len(h)]
        ms.append(np.mean(vals))
        ss.append(np.std(vals))
        if i % bucket == 0 or i == n - 1:
            res.append((i, float(np.mean(ms)), float(np.mean(ss))))
            ms, ss = [], []
    return res


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0, 10, allow_nan=False), min_size=1, max_size=40), st.integers(1, 7))
def test_loss_smooth(spark, losses, batch):
    df = spark.createDataFrame([("t", i, float(v)) for i, v in enumerate(losses)], "trainer string, it long, loss double")
    got = sorted((r.iteration, r.avg_loss) for r in EVL.loss_smooth(df, batch).collect())
    want = _smooth_loop(losses, batch)
    assert [g[0] for g in got] == [w[0] for w in want]
    np.testing.assert_allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-12)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.floats(0, 10, allow_nan=False), min_size=1, max_size=25), min_size=1, max_size=4),
       st.integers(1, 6))
def test_loss_curve(spark, histories, bucket):
    rows = [("t", w, i + 1, float(v)) for w, h in enumerate(histories) for i, v in enumerate(h)]
    df = spark.createDataFrame(rows, "trainer string, worker_id int, iteration long, loss double")
    got = sorted((r.iteration, r.loss, r.error) for r in EVL.loss_curve(df, bucket).collect())
    want = _curve_loop(histories, bucket)
    assert [g[0] for g in got] == [w[0] for w in want]
    np.testing.assert_allclose([g[1:] for g in got], [w[1:] for w in want], rtol=1e-9, atol=1e-12)


def test_history_positions(spark):
    ev = spark.createDataFrame([(i, i % 7, "a" if i % 2 else "b", float(i)) for i in range(40)],
                               "event_id long, user_id long, event_type string, value double")
    h = EVL.history_from_events(ev)
    for r in h.groupBy("trainer", "worker_id").agg(F.collect_list("iteration").alias("its")).collect():
        assert sorted(r.its) == list(range(1, len(r.its) + 1))
