"""Plan checks: the feature operators stay in the JVM (no Python nodes) and
use a bounded number of exchanges; the isolation join never compares all
pairs of an event."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonUDF")


def _plan(spark, name):
    df = E.queries()[name](spark, SF0001)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["event_features", "particle_features", "sequence_scaled",
                                  "isolation", "image_blend", "roc_curve", "loss_curve"])
def test_no_python_in_plan(spark, name):
    plan = _plan(spark, name)
    assert not any(n in plan for n in PY_NODES), name


@pytest.mark.parametrize("name,limit", [("event_features", 14), ("particle_features", 10),
                                        ("sequence_scaled", 10)])
def test_exchange_budget(spark, name, limit):
    plan = _plan(spark, name)
    n = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan))
    assert n <= limit, (name, n)


def test_isolation_join_is_keyed_by_cell(spark):
    plan = _plan(spark, "isolation")
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[([^\]]*)\]", plan)
    assert any("ce" in j and "cp" in j and "event_id" in j for j in joins), joins


def test_pushdown_to_scan(spark):
    plan = _plan(spark, "jets_ht")
    assert "ReadSchema: struct<event_id:bigint,species:string,pt:double,eta:double,btag:int>" in plan
    assert "EqualTo(species,jet)" in plan
    from collidex.sources.fixture import fixture_particles
    raw = fixture_particles(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in raw
    assert "l_shipdate" not in raw


def test_flattening_reads_and_explodes_events_once(spark, scratch):
    from collidex import schemas
    from collidex.operators.selection import preselect_nested
    from collidex.sources import events as EV
    from collidex.sources.fixture import fixture_nested_events
    path = f"{scratch}/events.parquet"
    fixture_nested_events(spark, SF0001).write.parquet(path)
    events = spark.read.schema(schemas.EVENT).parquet(path)
    plan = EV.explode_particles(preselect_nested(events))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate explode") == 1 and "Exchange" not in plan
    # the predicates on the nested row stand below the generator: rejected events are not exploded
    assert plan.index("Generate explode") < plan.index("exists(EFlowTrack") < plan.index("FileScan")
    jets = EV.explode_particles(events, ("jet",))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<event_id:bigint,Jet:", jets) and "EFlow" not in jets


def test_bucketed_tables_join_without_an_exchange(spark):
    plan = _plan(spark, "bucketed_join")
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_raster_rows_are_grouped_where_the_points_are(spark):
    """Only points are shuffled; rows and runs, many times as many, are made and grouped in their event's partition."""
    from collidex.operators import images as IM
    pts = spark.createDataFrame([(1, "track", 0, 3.1, 5.0)], "event_id long, species string, seq int, Phi double, Pt double")
    pf = pts.selectExpr("event_id", "seq", "0.5D AS Eta", "Phi", "Pt", *[f"{v} AS {c}" for c, v in zip(IM.TYPE_FEATURES, ("1D", "0D", "0D", "0D", "0D", "1D"))])
    ef = spark.createDataFrame([(1, 20.0, 0.3, 0)], "event_id long, MET double, phiMET double, label int")
    runs = IM.event_runs(pf, ef, res=10).groupBy("event_id").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = runs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert runs.collect()[0]["count"] > 0


@pytest.mark.parametrize("name", ["mlp_predict", "inclusive_predict"])
def test_features_of_a_fit_are_computed_once(spark, name):
    """Fits and the score read written features; none of them selects and isolates again."""
    plan = _plan(spark, name)
    assert "Join" not in plan and "Window" not in plan and "Exchange" not in plan


def test_unpad_keeps_rows_with_any_value(spark):
    from collidex.operators.features import FEATURE_COLS, unpad
    z, nan = [0.0] * len(FEATURE_COLS), float("nan")
    rows = [z, z[:-1] + [2.0], z, [nan] + z[1:], [-0.0] + z[1:], z[:-1] + [None], [0.0], [1.0], z]
    got = spark.createDataFrame([(rows,)], "lfeatures array<array<double>>").select(unpad().alias("f"), unpad().alias("g")).first()["f"]
    assert len(got) == 3 and got[0][-1] == 2.0 and got[1][0] != got[1][0] and got[2] == [1.0]
    zeros = spark.createDataFrame([([z] * 800,)], "lfeatures array<array<double>>").select(unpad().alias("f"))
    assert zeros.first()["f"] == [] and "NOT (" in zeros._jdf.queryExecution().optimizedPlan().toString()     # one comparison a row
