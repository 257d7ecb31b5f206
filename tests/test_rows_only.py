"""Rows-only queries (no SQL oracle) run at sf0.001 with stable schemas and
sensible row counts."""

import __spark_entry__ as E
from tests.conftest import SF0001


def test_rows_only_queries(spark):
    q = E.queries()
    sh = q["shuffle"](spark, SF0001)
    assert sh.count() == 150 and sh.columns == ["event_id", "label"]
    rf = q["rf_predict"](spark, SF0001)
    rows = rf.collect()
    assert rows and set(rf.columns) >= {"vec_id", "label", "prediction", "probability"}
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in rows)


def test_searches_try_the_whole_default_grids(spark):
    for name, n in (("grid_search", 3 ** 5), ("random_search", 2 * 4 * 4 * 4 * 3)):
        rows = E.queries()[name](spark, SF0001).collect()
        assert len({r.combination for r in rows}) == n and {r.tested for r in rows} == {rows[0].tested}
        assert all(0 <= r.accuracy <= 1 for r in rows) and rows[0].tested > 100


def test_trained_model_queries(spark):
    q = E.queries()
    auc = q["trained_auc"](spark, SF0001).collect()
    assert {(r.model, r["class"]) for r in auc} == {(m, c) for m in ("network", "forest") for c in range(3)}
    assert sum(r.is_best for r in auc) == 3
    conf = q["trained_confusion"](spark, SF0001).collect()
    assert {r.label for r in conf} == {0, 1, 2, None} and sum(r.pred_0 + r.pred_1 + r.pred_2 for r in conf) > 20
    loss = q["training_loss"](spark, SF0001).collect()
    assert {r.trainer for r in loss} == {"all_rows", *(f"without_fold_{f}" for f in range(3))}
