"""Sources and sinks: nested scans, the two batch jobs, table round trips,
sample stats, scaling log, model persistence."""

import os

from pyspark.sql import functions as F

from collidex.operators import models as MD
from collidex.plans import jobs
from collidex.sources import events as EV
from collidex.sources.fixture import fixture_nested_events
from tests.conftest import SF0001


def _write_samples(spark, scratch):
    nested = fixture_nested_events(spark, SF0001)
    paths = {}
    for k, name in enumerate(["qcd", "ttbar", "wjets"]):
        p = os.path.join(scratch, f"{name}_part0.parquet")
        nested.where(F.col("label") == k).drop("label").write.parquet(p)
        paths[k] = os.path.join(scratch, f"{name}*.parquet")   # glob, as the original scan
    return nested, paths


def test_read_events_minimal_schema(spark, scratch):
    nested, paths = _write_samples(spark, scratch)
    df = EV.read_events(spark, paths[1])
    plan = df.select("event_id", F.size("Jet"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,Jet:array<struct<PT:double,Eta:double,BTag:int>>>" in plan
    assert df.count() == nested.where("label = 1").count()


def test_jobs_round_trip(spark, scratch):
    nested, paths = _write_samples(spark, scratch)
    out = os.path.join(scratch, "features")
    written = jobs.events_to_features(spark, paths, out, matrix=True,
                                      stats_path=os.path.join(scratch, "stats"), auto_size=False)
    ef = spark.read.parquet(written["event_features"])
    pf = spark.read.parquet(written["particle_features"])
    assert ef.count() == 145                               # selected events at sf0.001
    assert pf.select("event_id").distinct().count() == 145
    assert sorted(r.label for r in ef.select("label").distinct().collect()) == [0, 1, 2]
    m = spark.read.parquet(written["matrix"])
    assert m.select(F.min(F.size("lfeatures")), F.max(F.size("lfeatures"))).first() == (801, 801)
    stats = spark.read.csv(os.path.join(scratch, "stats")).first()
    assert sum(int(x) for x in stats) == nested.count()
    seq = spark.read.parquet(jobs.features_to_sequences(spark, out, os.path.join(scratch, "seq")))
    assert seq.count() == 145
    n_real = pf.groupBy("event_id").count()
    sizes = seq.select("event_id", F.size("scaled_features").alias("n")).join(n_real, "event_id")
    assert sizes.where("n != count").count() == 0
    img = jobs.features_to_images(spark, out, os.path.join(scratch, "images"), res=10)
    px = spark.read.parquet(img)
    assert px.select("event_id").distinct().count() == 145
    assert px.where("r < 0 OR r > 1 OR g < 0 OR g > 1 OR b < 0 OR b > 1").count() == 0


def test_generated_event_ids(spark, scratch):
    nested = fixture_nested_events(spark, SF0001)
    p = os.path.join(scratch, "noid.parquet")
    nested.drop("event_id").repartition(3).write.parquet(p)
    df = jobs.load_samples(spark, {1: p})
    ids = df.select("event_id").collect()
    assert len(ids) == nested.count() and None not in {r.event_id for r in ids}
    assert len({r.event_id for r in ids}) == len(ids)
    assert sorted(r.event_id for r in jobs.load_samples(spark, {1: p}).select("event_id").collect()) == \
        sorted(r.event_id for r in ids)   # stable when recomputed


def test_size_shuffles(spark):
    from collidex.session import input_bytes, size_shuffles
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert input_bytes(spark, [f"{SF0001}/*.parquet"]) > 0
        assert size_shuffles(spark, [f"{SF0001}/*.parquet"], min_partitions=3) == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_tables_and_scaling_log(spark, scratch):
    df = spark.createDataFrame([(4, 100.0), (1, 380.0), (2, 200.0)], "nodes int, elapsed_time double")
    p = os.path.join(scratch, "scaling.csv")
    df.coalesce(1).write.option("header", True).csv(p)
    curve = EV.scaling_curve(EV.read_scaling_log(spark, p)).collect()
    assert [r.nodes for r in curve] == [1, 2, 4]
    assert abs(curve[2].speedup - 3.8) < 1e-12
    t = os.path.join(scratch, "prepared")
    spark.createDataFrame([([1.0] * 14, 1, [0.0, 1.0, 0.0])], "HLF_input array<double>, label int, encoded_label array<double>").write.parquet(t)
    assert EV.read_prepared(spark, t).columns == ["HLF_input", "label", "encoded_label"]


def test_model_save_load(spark, scratch):
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense([float(i % 3), float(i % 5)]), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label"])
    m = MD.train_network(df, layers=(2, 5, 3), max_iter=20)
    p = os.path.join(scratch, "mlp")
    MD.save_model(m, p)
    m2 = MD.load_model(p, "network")
    a = [r.prediction for r in MD.score(m, df).collect()]
    b = [r.prediction for r in MD.score(m2, df).collect()]
    assert a == b


def _scratch_tables(spark):
    from collidex.session import ensure_checkpoint_dir
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


def test_jobs_write_events_and_features_and_no_tables_between(spark):
    import __spark_entry__ as E
    before = _scratch_tables(spark)
    for name in ("job_event_features", "job_particle_features"):
        assert E.queries()[name](spark, SF0001).count() > 100
    made = {t.rsplit("-", 5)[0] if t.count("-") > 4 else t.rsplit("-", 1)[0] for t in _scratch_tables(spark) - before}
    assert made == {"samples", "features", "crowded-events"}


def test_job_on_a_class_without_events(spark, scratch):
    import __spark_entry__ as E
    some = spark.read.parquet(f"{SF0001}/lineitem.parquet").where("floor(l_orderkey / 10) % 3 != 1")
    some.write.parquet(f"{scratch}/lineitem.parquet")
    got = {r["label"]: r["count"] for r in E.queries()["job_event_features"](spark, scratch).groupBy("label").count().collect()}
    want = {r["label"]: r["count"] for r in E.queries()["event_features"](spark, scratch).groupBy("label").count().collect()}
    assert got == want and set(got) == {0, 2}
