"""Spark operators vs the independent per-event row model, on hand-built
edge cases and random events."""

import numpy as np
import pytest

from collidex.config import DEFAULT_CUTS, EVENT_FEATURES, PARTICLE_FEATURES
from collidex.operators import features as FE
from collidex.sources import events as EV
from tests import rowmodel
from tests.events_fixture import edge_events, random_events, to_df


def _run(spark, evs, cuts):
    df = to_df(spark, evs)
    parts, info = EV.explode_particles(df), EV.event_info(df)
    pf, ef = FE.features(parts, info, cuts)
    pf_rows = {}
    for r in pf.collect():
        pf_rows.setdefault(r["event_id"], []).append((r["seq"], [r[c] for c in PARTICLE_FEATURES]))
    ef_rows = {r["event_id"]: [r[c] for c in EVENT_FEATURES] for r in ef.collect()}
    return pf_rows, ef_rows


def _check(spark, evs, cuts, caps):
    pf_rows, ef_rows = _run(spark, evs, cuts)
    for ev in evs:
        want = rowmodel.model(ev, caps=caps)
        eid = ev["event_id"]
        if want is None:
            assert eid not in ef_rows and eid not in pf_rows, eid
            continue
        rows, hlf = want
        got = [f for _, f in sorted(pf_rows[eid])]
        assert [s for s, _ in sorted(pf_rows[eid])] == list(range(len(rows))), eid
        np.testing.assert_allclose(np.array(got), np.array(rows), rtol=1e-9, atol=1e-9, err_msg=str(eid))
        np.testing.assert_allclose(np.array(ef_rows[eid]), np.array(hlf), rtol=1e-9, atol=1e-9,
                                   err_msg=str(eid))


def test_edge_events(spark):
    _check(spark, edge_events(), DEFAULT_CUTS, (None, None, None))


def test_edge_events_small_caps(spark):
    cuts = DEFAULT_CUTS.with_(max_tracks=3, max_photons=2, max_neutrals=2)
    _check(spark, edge_events(), cuts, (3, 2, 2))


@pytest.mark.parametrize("seed", [3, 11])
def test_random_events(spark, seed):
    _check(spark, random_events(40, seed), DEFAULT_CUTS, (None, None, None))


def test_selected_edge_cases(spark):
    _, ef = _run(spark, edge_events(), DEFAULT_CUTS)
    assert 1 not in ef and 10 not in ef and 12 not in ef   # empty map, zero counters, pt cut
    assert ef[4][EVENT_FEATURES.index("LepIsEle")] == 0.0   # equal eta -> muon
    assert ef[5][EVENT_FEATURES.index("LepIsEle")] == 1.0
    assert ef[7][EVENT_FEATURES.index("MET")] == 0.0


def test_padded_matrix(spark):
    df = to_df(spark, edge_events())
    pf, _ = FE.features(EV.explode_particles(df), EV.event_info(df))
    sizes = FE.nested_sizes(FE.assemble_lfeatures(pf)).collect()
    assert sizes and all(r["n_rows"] == DEFAULT_CUTS.n_rows and r["n_cols"] == 19 for r in sizes)


def test_no_particle_is_lost_without_caps(spark):
    ev = next(e for e in random_events(40, 3) if rowmodel.model(e) is not None)
    tracks = [dict(ev["EFlowTrack"][0], PT=1.0 + 0.001 * i, Eta=2.0 + 0.00053 * i) for i in range(1000)]
    ev = dict(ev, EFlowTrack=ev["EFlowTrack"] + tracks)
    _check(spark, [ev], DEFAULT_CUTS, (None, None, None))
