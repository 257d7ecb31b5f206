"""Property tests of the column functions and metrics."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collidex.functions import kinematics as K
from collidex.operators import evaluate as EVL

finite = st.floats(min_value=-20, max_value=20, allow_nan=False)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(finite, finite, finite, finite), min_size=1, max_size=30))
def test_wrap_and_delta_r(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(K.wrap_phi("a").alias("w"), K.delta_r("a", "b", "c", "d").alias("d1"),
                    K.delta_r("c", "d", "a", "b").alias("d2")).collect()
    for r in out:
        assert -3.1415 <= r.w < 3.1415
        assert r.d1 >= 0 and abs(r.d1 - r.d2) < 1e-9


def _auc_pairs(scores, truth):
    pos = [s for s, t in zip(scores, truth) if t]
    neg = [s for s, t in zip(scores, truth) if not t]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.booleans()), min_size=2, max_size=60))
def test_auc_is_rank_statistic(spark, rows):
    truth = [t for _, t in rows]
    if all(truth) or not any(truth):
        return
    df = spark.createDataFrame([(float(s), int(t)) for s, t in rows], "score double, is_pos long")
    long = df.select(F.lit(1).alias("class"), "score", "is_pos")
    got = EVL.auc(long, n_blocks=3).first().auc
    assert abs(got - _auc_pairs([float(s) for s, _ in rows], truth)) < 1e-12


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(0, 1, allow_nan=False)), min_size=1, max_size=50))
def test_prefix_sum_exact(spark, rows):
    from collidex.operators.ordered import ordered_cumsum
    data = [(g, i * 1.0 + v, float(i)) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, k double, m double")
    got = {(r.g, r.k): r.cum_m for r in ordered_cumsum(df, ["g"], "k", ["m"], n_blocks=4).collect()}
    for g, k, _ in data:
        want = sum(m for g2, k2, m in data if g2 == g and k2 <= k)
        assert got[(g, k)] == want


def test_standardised_columns(spark):
    from collidex.operators.sequences import standardise
    rng = np.random.default_rng(0)
    rows = [(int(e), float(rng.normal()), 3.0) for e in range(4) for _ in range(7)]
    df = standardise(spark.createDataFrame(rows, "event_id long, a double, b double"), ["a", "b"])
    for r in df.groupBy("event_id").agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s"),
                                        F.max(F.abs("b")).alias("bb")).collect():
        assert abs(r.m) < 1e-12 and abs(r.s - 1) < 1e-12 and r.bb == 0.0


def test_point_sizes(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (math.e ** 60,), (-3.0,)], "v double")
    r = df.select(K.point_size("v").alias("p"), K.met_size("v").alias("m")).collect()
    assert r[0].m == 0.001 and r[3].m == 0.001 and r[2].p == 10.0 and r[2].m == 10.0
    assert abs(r[0].p - math.log(1.001) / 5) < 1e-15
