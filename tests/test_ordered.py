"""Ranks, key mixing and sample ids on keys that are null, negative, huge or repeated."""

import os

from pyspark.sql import functions as F

from collidex.operators import evaluate as EVL, images as IM, prep as PR
from collidex.operators.ordered import ordered_cumsum, ordered_rank
from collidex.plans import jobs
from collidex.sources.fixture import fixture_nested_events
from tests.conftest import SF0001


def test_long_keys_beyond_double_precision(spark):
    keys = [2**53 + i for i in range(6)] + [-2**53 - i for i in range(6)] + [2**63 - 1, -2**63]
    df = spark.createDataFrame([(1, k) for k in keys], "g int, k long")
    for descending in (False, True):
        got = {r.k: r["rank"] for r in ordered_rank(df, ["g"], "k", descending=descending, n_blocks=3).collect()}
        assert got == {k: i + 1 for i, k in enumerate(sorted(keys, reverse=descending))}


def test_null_and_nan_keys_and_null_groups_keep_their_rows(spark):
    rows = [(None, 1.0), (None, None), (1, float("nan")), (1, 5.0), (1, None), (1, 7.0)]
    df = spark.createDataFrame(rows, "g int, k double")
    for descending, first in ((False, 5.0), (True, 7.0)):
        got = ordered_rank(df, ["g"], "k", descending=descending, n_blocks=4).collect()
        order = [r.k for r in sorted((r for r in got if r.g == 1), key=lambda r: r["rank"])]
        assert len(got) == 6 and order[0] == first and order[2] != order[2] and order[3] is None


def test_hot_group(spark):
    df = spark.range(3000).select((F.col("id") % 10 == 0).cast("int").alias("g"), (F.col("id") % 700).alias("k"), F.lit(1).alias("one"))
    got = ordered_cumsum(df, ["g"], "k", ["one"], n_blocks=7, tiebreak=["k"])
    assert got.groupBy("g").agg(F.max("cum_one").alias("m")).exceptAll(df.groupBy("g").agg(F.sum("one").alias("m"))).count() == 0
    assert got.select("g", "cum_one").distinct().count() == 3000


def test_split_of_hashed_and_negative_keys(spark):
    ids = spark.range(40000).select(F.xxhash64("id").alias("event_id"))
    share = PR.key_split(ids, "event_id").where("split = 'test'").count() / 40000
    assert abs(share - 0.2) < 0.01
    mixed = ids.select(PR.mix_key("event_id").alias("m"))
    assert mixed.where("m < 0 OR m >= 4294967296").count() == 0 and mixed.distinct().count() > 39990


def test_samples_that_number_their_events_alike(spark, scratch):
    nested = fixture_nested_events(spark, SF0001)
    p = os.path.join(scratch, "same.parquet")
    nested.drop("label").write.parquet(p)
    loaded = jobs.load_samples(spark, {0: p, 1: p, 2: p})
    assert loaded.select("event_id").distinct().count() == loaded.count() == 3 * nested.count()


def test_auc_with_null_and_nan_scores_and_large_counts(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (1, 0.1, 0), (1, None, 1), (1, float("nan"), 0)], "class int, score double, is_pos long")
    # order: 0.9 (pos), 0.1 (neg), NaN (neg), null (pos)
    assert EVL.auc(df, n_blocks=2).first().auc == 0.5
    last = EVL.roc_curve(df, n_blocks=2).agg(F.max("tpr"), F.max("fpr")).first()
    assert tuple(last) == (1.0, 1.0)
    big = spark.createDataFrame([(1, 0.9, 4 * 10**9, 0), (1, 0.1, 0, 4 * 10**9)], "class int, score double, pos long, neg long")
    cum = ordered_cumsum(big, ["class"], "score", ["pos"], descending=True, n_blocks=2, inclusive=False)
    assert {r.cum_pos for r in cum.collect()} == {0, 4 * 10**9}


def test_blank_events_are_white_images(spark):
    px = spark.createDataFrame([(1, 0, 0, 0.5, 0.5, 0.5)], "event_id long, x int, y int, r double, g double, b double")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "event_id long, label int")
    got = {r.event_id: r.image for r in IM.dense_images(px, 1, labels=labels).collect()}
    assert set(got) == {1, 2} and got[1][0][0] == [0.5] * 3 and all(c == 1.0 for row in got[2] for p in row for c in p)


def test_confusion_matrix_keeps_unlisted_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 7), (9, 1), (None, 0), (1, None)], "y_true int, y_pred int")
    got = {r["y_true"]: tuple(r)[1:] for r in EVL.confusion_matrix(df, [0, 1]).collect()}
    assert got == {0: (1, 1, 0), 1: (0, 0, 2), None: (1, 1, 0)}


def test_group_of_most_rows_is_dealt_over_partitions(spark):
    """Ranks are right and no partition of the written table holds more than a share of the group of 90 % of the rows."""
    from pyspark.sql import Window
    df = spark.range(20000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("x").alias("g"), (F.col("id") * 7919 % 20011).alias("k"))
    got = ordered_rank(df, ["g"], "k", n_blocks=16)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("long"))
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 20000
    scans = [p for p in got.inputFiles() if "ordered-" in p]
    folder = os.path.dirname(scans[0])
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.shiftright("_at", 33).alias("part")).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 20000 / 16


def test_binned_curve_is_within_its_bound(spark):
    df = spark.range(30000).select((F.col("id") % 3 == 0).cast("long").alias("is_pos"), F.lit(1).alias("class"),
                                   (F.col("id") * 7919 % 30011 / 30011 + (F.col("id") % 3 == 0).cast("int") * 0.2).alias("score")).cache()
    exact = {r.threshold: r for r in EVL.roc_curve(df).collect()}
    order = sorted(exact, reverse=True)
    for bins in (10, 100):
        got = EVL.roc_curve(df, bins=bins).orderBy(F.desc("threshold")).collect()
        assert bins <= len(got) <= 2 * bins + 2
        for r in got:
            i = order.index(r.threshold)          # the exact curve above the threshold is its point before
            assert abs(exact[order[i - 1]].tpr - r.tpr) <= 1 / bins and abs(exact[order[i - 1]].fpr - r.fpr) <= 1 / bins
        steps = list(zip(got, got[1:]))
        assert all(0 <= b.tpr - a.tpr <= 2 / bins and 0 <= b.fpr - a.fpr <= 2 / bins for a, b in steps)
    odd = spark.createDataFrame([(1, 0.5, 1), (1, None, 1), (1, float("nan"), 0), (2, 0.5, 0)], "class int, score double, is_pos long")
    got = {(r["class"], r.threshold): (r.tpr, r.fpr, r.P, r.N) for r in EVL.roc_curve(odd, bins=5).collect()}
    assert got == {(1, 0.5): (0.0, 0.0, 2, 1), (2, 0.5): (None, 0.0, 0, 1)}
    assert EVL.roc_curve(odd.limit(0), bins=5).count() == 0
