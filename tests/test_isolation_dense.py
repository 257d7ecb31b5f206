"""Adaptive cells against plain cone sums: dense cores, equal points, both phi rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from collidex.operators import dense_isolation as dense_isolation_module
from collidex.operators.dense_isolation import isolation_dense
from collidex.operators.isolation import isolation

PROBE = "event_id long, species string, pos int, p_eta double, p_phi double, p_pt double"
CAND = "event_id long, species string, eta double, phi double, pt double"


@pytest.mark.parametrize("wrap", ["legacy", "periodic"])
def test_adaptive_cells_equal_pairs(spark, wrap):
    rng = np.random.default_rng(3)
    cands, probes = [], []
    for eid, (e, p, width) in enumerate([(0.3, 1.0, 0.15), (0.0, math.pi, 0.2), (-1.2, -math.pi, 0.05), (2.0, 0.0, 0.0), (0.0, 0.0, 2.0)]):
        wide = np.clip(rng.normal(p, width, 400), -math.pi, math.pi)
        for i, (x, y) in enumerate(zip(rng.normal(e, width, 400), wide)):
            cands.append((eid, ["track", "photon", "neutral"][i % 3], float(x), float(y), float(rng.uniform(0.5, 3))))
            if i % 8 == 0:
                probes.append((eid, "probe", i, float(x + rng.normal(0, 0.2)), float(y), float(rng.uniform(0, 5))))
    cands += [(0, "track", None, 1.0, 5.0), (0, "track", math.nan, 1.0, 5.0), (9, "track", 0.0, 0.0, 1.0)]
    probes += [(8, "probe", 0, 0.0, 0.0, 1.0), (3, "probe", 1, 2.0 + 0.3, 0.0, 1.0), (3, "probe", 2, 2.0, 0.0, 0.0)]
    p, c = spark.createDataFrame(probes, PROBE), spark.createDataFrame(cands, CAND)
    want = {tuple(r)[:3]: tuple(r)[6:] for r in isolation(p, c.where("eta IS NOT NULL AND NOT isnan(eta)"), wrap=wrap).collect()}
    got = {tuple(r)[:3]: tuple(r)[6:] for r in isolation_dense(p, c, wrap=wrap, limit=12, max_depth=5).collect()}
    assert got.keys() == want.keys() and len(got) == len(probes)
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9, atol=1e-9, err_msg=str(k))


def test_a_hundred_thousand_particles_in_one_cell(spark):
    ids = spark.range(100_000, numPartitions=8)
    u, v = (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1 << 20)) / (1 << 20) for i in (1, 2))
    cands = ids.select(F.lit(1).cast("long").alias("event_id"), F.lit("track").alias("species"), (u * 0.5 + 0.05).alias("eta"), (v * 0.5 + 0.05).alias("phi"), F.lit(1.0).alias("pt"))
    probes = cands.limit(200).withColumn("pos", F.monotonically_increasing_id()).select(
        "event_id", "species", "pos", F.col("eta").alias("p_eta"), F.col("phi").alias("p_phi"), F.col("pt").alias("p_pt"))
    got = isolation_dense(probes, cands).collect()
    at = np.array([tuple(r) for r in cands.select("eta", "phi").collect()])
    assert len(got) == 200
    for r in got:
        assert r.iso_ch + 1 == (((at - [r.p_eta, r.p_phi]) ** 2).sum(axis=1) < 0.09).sum()


def test_no_candidates(spark):
    p = spark.createDataFrame([(1, "probe", 0, 0.0, 0.0, 2.0)], PROBE)
    assert [tuple(r)[6:] for r in isolation_dense(p, spark.createDataFrame([], CAND)).collect()] == [(-1.0, 0.0, 0.0)]


@pytest.mark.parametrize("crowded", [0, 30, 512])
def test_only_probes_near_a_split_cell_are_copied(spark, monkeypatch, crowded):
    rng = np.random.default_rng(5)
    cands, probes = [], []
    for eid, (n, width) in enumerate([(3, 2.0), (25, 0.4), (25, 2.0), (60, 0.2)]):
        for i in range(n):
            x, y = float(rng.normal(0, width)), float(np.clip(rng.normal(3.0, width), -math.pi, math.pi))
            cands.append((eid, ["track", "photon", "neutral"][i % 3], x, y, float(rng.uniform(0.5, 3))))
            probes.append((eid, "probe", i, x, y, 1.0))
    probes.append((None, "probe", 0, 0.0, 0.0, 1.0))
    p, c = spark.createDataFrame(probes, PROBE), spark.createDataFrame(cands, CAND)
    copied = []
    cells = dense_isolation_module.probe_cells
    monkeypatch.setattr(dense_isolation_module, "probe_cells", lambda q, *a: copied.append(q) or cells(q, *a))
    want = {tuple(r)[:3]: tuple(r)[6:] for r in isolation(p, c).collect()}
    for limit in (4, 100):
        copied.clear()
        got = {tuple(r)[:3]: tuple(r)[6:] for r in isolation_dense(p, c, limit=limit, crowded=crowded).collect()}
        assert got.keys() == want.keys() and len(got) == len(probes)
        for k in want:
            np.testing.assert_allclose(got[k], want[k], rtol=1e-9, atol=1e-9, err_msg=str(k))
        if crowded == 512:
            there = {r.event_id for q in copied for r in q.collect()}
            assert there == set() if limit == 100 else 3 in there and 0 not in there
