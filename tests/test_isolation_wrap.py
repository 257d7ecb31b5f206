"""Isolation under both phi rules vs a brute-force numpy cone sum, with
particles clustered at the +-pi boundary."""

import math

import numpy as np
import pytest

from collidex.operators.isolation import isolation


def _brute(probes, cands, dr, wrap):
    out = {}
    for (eid, pos, pe, pp, ppt) in probes:
        sums = {"track": 0.0, "photon": 0.0, "neutral": 0.0}
        for (ceid, sp, ce, cp, cpt) in cands:
            if ceid != eid:
                continue
            d = cp - pp
            if wrap == "legacy":
                tw = 2 * 3.1415
                d = d - tw * (d > tw) + tw * (d < -tw)
            else:
                d = (d + math.pi) % (2 * math.pi) - math.pi
            if d * d + (ce - pe) ** 2 < dr * dr:
                sums[sp] += cpt
        out[(eid, pos)] = (sums["track"] / ppt - 1, sums["photon"] / ppt, sums["neutral"] / ppt)
    return out


@pytest.mark.parametrize("wrap", ["periodic", "legacy"])
def test_isolation_wrap(spark, wrap):
    rng = np.random.default_rng(7)
    probes, cands = [], []
    for eid in range(6):
        for pos in range(25):
            phi = float(rng.choice([-1, 1]) * (math.pi - abs(rng.normal(0, 0.2))))
            probes.append((eid, pos, float(rng.normal(0, 0.3)), phi, float(rng.uniform(1, 5))))
        for _ in range(60):
            phi = float(rng.choice([-1, 1]) * (math.pi - abs(rng.normal(0, 0.25))))
            if rng.random() < 0.1:
                phi += float(rng.choice([-1, 1]) * 2 * math.pi)   # out-of-range input
            cands.append((eid, str(rng.choice(["track", "photon", "neutral"])),
                          float(rng.normal(0, 0.3)), phi, float(rng.uniform(0.5, 3))))
    pdf = spark.createDataFrame([(e, "probe", p, a, b, c) for e, p, a, b, c in probes],
                                "event_id long, species string, pos int, p_eta double, p_phi double, p_pt double")
    cdf = spark.createDataFrame(cands, "event_id long, species string, eta double, phi double, pt double")
    # Probe phi must lie in [-pi, pi] (as from atan2); keep the generated ones there.
    got = {(r.event_id, r.pos): (r.iso_ch, r.iso_gamma, r.iso_neu)
           for r in isolation(pdf, cdf, dr=0.3, wrap=wrap).collect()}
    want = _brute([(e, p, a, max(-math.pi, min(math.pi, b)), c) for e, p, a, b, c in probes], cands, 0.3, wrap)
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-12, atol=1e-12, err_msg=str(k))


def test_crowded_events_in_cells_equal_others(spark):
    """Events beyond the limit are cut into cells, the others are not; the sums are the same."""
    rng = np.random.default_rng(4)
    rows = [(e, s, i, float(a), float(b), float(p)) for e, n in ((1, 40), (2, 6), (3, 1))
            for i, (s, a, b, p) in enumerate(zip(rng.choice(["track", "neutral", "photon"], n), rng.uniform(-1, 1, n), rng.uniform(-3.1, 3.1, n), rng.uniform(1, 9, n)))]
    cands = spark.createDataFrame(rows, "event_id long, species string, pos int, eta double, phi double, pt double")
    probes = cands.selectExpr("event_id", "species", "pos", "eta AS p_eta", "phi AS p_phi", "pt AS p_pt")
    for wrap in ("legacy", "periodic"):
        got = [{r[:3]: r[3:] for r in isolation(probes, cands, wrap=wrap, crowded=n).collect()} for n in (10**6, 30, 0)]
        assert len(got[0]) == len(rows) and any(v[3] > -1 for v in got[0].values())
        for other in got[1:]:
            assert other.keys() == got[0].keys()
            assert all(np.allclose(other[k], v, rtol=0, atol=1e-9) for k, v in got[0].items())


def test_rows_of_sparse_events_are_dealt_once(spark):
    """No copies of probes in four cells, and sums and momenta stay in the partitioning by event."""
    rows = [(e, "track", i, 0.1 * i, 0.0, 2.0) for e in range(20) for i in range(5)]
    cands = spark.createDataFrame(rows, "event_id long, species string, pos int, eta double, phi double, pt double")
    probes = cands.selectExpr("event_id", "species", "pos", "eta AS p_eta", "phi AS p_phi", "pt AS p_pt")
    out = isolation(probes, cands).groupBy("event_id").agg({"iso_ch": "max"})
    assert len(out.collect()) == 20
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "inline(" not in plan and plan.count("Exchange hashpartitioning") == 2
