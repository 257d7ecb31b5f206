"""The skew-safe (aggregation + blocked rank) forms equal the window forms."""

from pyspark.sql import functions as F

from collidex.config import DEFAULT_CUTS
from collidex.operators import features as FE
from collidex.operators import sequences as SQ
from collidex.plans.queries import rounded
from collidex.sources import events as EV
from collidex.sources.fixture import fixture
from tests.conftest import SF0001
from tests.events_fixture import edge_events, to_df


def _same(a, b):
    a, b = rounded(a), rounded(b.select(*a.columns))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_particle_features_skew_safe(spark):
    parts, events = fixture(spark, SF0001)
    cuts = DEFAULT_CUTS.with_(max_tracks=3, max_photons=2, max_neutrals=1)   # caps bind
    _same(FE.particle_features(parts, events, cuts),
          FE.particle_features_skew_safe(parts, events, cuts, n_blocks=5))


def test_sequences_skew_safe(spark):
    df = to_df(spark, edge_events())
    pf = FE.particle_features(EV.explode_particles(df), EV.event_info(df))
    _same(SQ.sequence_features(pf), SQ.sequence_features_skew_safe(pf, n_blocks=3))


def _tables_written(monkeypatch):
    from collidex import session
    from collidex.operators import ordered
    seen, real = [], session.written

    def spy(df, name):
        seen.append((name, set(df.columns)))
        return real(df, name)

    monkeypatch.setattr(session, "written", spy)
    monkeypatch.setattr(ordered, "written", spy)
    return seen


def test_values_that_follow_from_others_are_not_written(spark, monkeypatch):
    seen = _tables_written(monkeypatch)
    parts, events = fixture(spark, SF0001)
    FE.particle_features_skew_safe(parts, events)
    tables = dict(seen)
    assert {"isolated", "ordered"} <= set(tables)
    assert not any(c in tables[t] for t in ("isolated", "ordered") for c in ("e", "px", "py", "pz", "p_pt", "p_eta", "p_phi"))


def test_sequences_meet_their_event_once(spark, monkeypatch):
    seen = _tables_written(monkeypatch)
    pf = FE.particle_features(*fixture(spark, SF0001))
    some = pf.where("event_id % 2 = 0 OR seq > 0")              # no lepton row: no order, no sequence
    got = SQ.sequence_features_skew_safe(some)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and dict(seen)["ordered"] >= {"dr", "Pt"}                      # that with the offsets
    _same(SQ.sequence_features(pf.where("event_id % 2 = 0")), got)
