"""Cone isolation as an eta-phi grid range join.

For every probe the pT of candidates inside a cone of radius ``dr`` is
summed per map (charged tracks, neutral hadrons, photons) and divided by
the probe pT; the charged sum subtracts 1. A probe counts itself when it is
in a map.

Plan: probes and candidates are dealt by event, and each probe is compared with the
candidates of its event; sums, and whatever the caller does per event, stay in that
partitioning, so rows are shuffled once. Events of more than ``CROWDED`` rows are known
beforehand and keyed by (event_id, eta cell, phi cell) instead, with cell size just over
2*dr, so that a cone touches at most a 2x2 block of cells; each probe is sent to exactly
those 4 keys. That never compares all pairs of such an event and spreads it over many
join keys; its partial sums are combined by a hash aggregate on the probe key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collidex.config import PI_APPROX
from collidex.functions.kinematics import wrap_phi
from collidex.session import written

MAP_SPECIES = {"track": "s_trk", "neutral": "s_neu", "photon": "s_pho"}
#: An event of more probes and candidates than this is cut into cells.
CROWDED = 512
#: Most ids of crowded events that are broadcast.
MAX_BROADCAST = 1_000_000


def _cells(eta, phi, cell):
    return F.floor(eta / F.lit(cell)), F.floor(phi / F.lit(cell))


def candidate_copies(cands: DataFrame, cell: float, wrap: str, period: float) -> DataFrame:
    """Candidates with their cell, and copies shifted by a period where a cone may wrap."""
    # Candidate side: cell keys, plus shifted copies near the phi boundary so
    # a cone that wraps (per the chosen rule) can still reach them.
    c = cands.select("event_id", F.col("species").alias("_cs"), F.col("eta").alias("_ce"),
                     F.col("phi").alias("_cphi"), F.col("pt").alias("_cpt"))
    if wrap == "legacy":
        shifts = F.array(F.lit(0),
                         F.when(F.col("_cphi") > period - math.pi, F.lit(1)),
                         F.when(F.col("_cphi") < math.pi - period, F.lit(-1)))
    else:
        c = c.withColumn("_cphi", F.col("_cphi") - F.lit(period) * F.floor(
            (F.col("_cphi") + F.lit(math.pi)) / F.lit(period)))
        shifts = F.array(F.lit(0),
                         F.when(F.col("_cphi") > math.pi - cell, F.lit(1)),
                         F.when(F.col("_cphi") < cell - math.pi, F.lit(-1)))
    c = (c.withColumn("_k", F.explode(F.filter(shifts, lambda v: v.isNotNull())))
         .withColumn("_kphi", F.col("_cphi") - F.col("_k") * F.lit(period)))
    cce, ccp = _cells(F.col("_ce"), F.col("_kphi"), cell)
    return c.select("event_id", "_cs", "_ce", "_cphi", "_kphi", "_cpt", "_k", cce.alias("ce"), ccp.alias("cp"))


def cone_residual(dr: float, wrap: str, period: float) -> F.Column:
    """Whether a candidate lies in the cone of a probe."""
    # Exact cone residual, written as the original difference-then-wrap.
    deta = F.col("_ce") - F.col("_pe")
    raw = F.col("_cphi") - F.col("_pp")
    if wrap == "legacy":
        k = F.col("_k")
        valid = (((k == 0) & (raw <= period) & (raw >= -period))
                 | ((k == 1) & (raw > period)) | ((k == -1) & (raw < -period)))
        dphi = (raw - F.lit(period) * F.when(k == 1, 1.0).otherwise(0.0)
                + F.lit(period) * F.when(k == -1, 1.0).otherwise(0.0))
    else:
        valid = F.lit(True)
        dphi = F.col("_cphi") - F.col("_k") * F.lit(period) - F.col("_pp")
    return valid & (dphi * dphi + deta * deta < F.lit(dr * dr))


def _by_momentum(probes: DataFrame, keys: list[str], pt: str, derive=None) -> DataFrame:
    """Probes with their sums: these divided by the momentum (columns of ``derive`` are made here)."""
    agg = probes.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in MAP_SPECIES.values()})
    agg = derive(agg) if derive else agg
    payload = [c for c in agg.columns if c not in keys and c not in MAP_SPECIES.values()]
    ppt = F.col(pt)
    zero = ppt <= 0
    return agg.select(
        *keys, *payload,
        F.when(zero, F.lit(0.0)).otherwise(F.col("s_trk") / ppt - F.lit(1.0)).alias("iso_ch"),
        F.when(zero, F.lit(0.0)).otherwise(F.col("s_pho") / ppt).alias("iso_gamma"),
        F.when(zero, F.lit(0.0)).otherwise(F.col("s_neu") / ppt).alias("iso_neu"))


def probe_blocks(pe, pp, cell: float) -> F.Column:
    """The cell of a probe and its nearer neighbours in eta and in phi."""
    ce0, cp0 = _cells(pe, pp, cell)
    de = F.when(pe / F.lit(cell) - ce0 < 0.5, -1).otherwise(1)
    dp = F.when(pp / F.lit(cell) - cp0 < 0.5, -1).otherwise(1)
    return F.array(*[F.struct((ce0 + a).alias("ce"), (cp0 + b).alias("cp"))
                     for a, b in ((0, 0), (de, 0), (0, dp), (de, dp))])


def probe_cells(probes: DataFrame, keys: list[str], cell: float, eta: str, phi: str) -> DataFrame:
    """Each probe in its own cell and the nearer neighbours in eta and in phi."""
    pe, pp = F.col(eta), F.col(phi)
    return probes.select(*keys, pe.alias("_pe"), pp.alias("_pp"), F.inline(probe_blocks(pe, pp, cell)))


def crowded_events(probes: DataFrame, cands: DataFrame, limit: int = CROWDED) -> DataFrame:
    """``event_id`` of the events with more than ``limit`` probes and candidates.

    The list is written; it has a row per ``limit`` rows of the input at most, and is broadcast while it is short.
    """
    rows = probes.select("event_id").unionAll(cands.select("event_id"))
    many = rows.groupBy("event_id").agg(F.count("*").alias("_n")).where((F.col("_n") > limit) & F.col("event_id").isNotNull())
    many = written(many.select("event_id"), "crowded-events")
    return F.broadcast(many) if many.count() <= MAX_BROADCAST else many


def isolation(probes: DataFrame, cands: DataFrame, key_cols=("event_id", "species", "pos"),
              dr: float = 0.3, wrap: str = "legacy", pi_approx: float = PI_APPROX,
              eta: str = "p_eta", phi: str = "p_phi", pt: str = "p_pt", crowded: int = CROWDED, derive=None) -> DataFrame:
    """Add ``iso_ch``, ``iso_gamma``, ``iso_neu`` to every probe row.

    ``probes`` carries ``key_cols`` (unique), the probe kinematics ``eta``,
    ``phi`` (in [-pi, pi], e.g. from atan2) and ``pt``, plus any payload.
    ``cands`` carries event_id, species (track/neutral/photon), eta, phi, pt.
    ``wrap='legacy'`` wraps dphi only beyond 2*pi_approx; ``'periodic'`` wraps
    into [-pi, pi). ``crowded`` is the number of rows beyond which an event is cut into
    cells. ``derive`` makes the kinematic columns from a probe's own; they are then made
    on both sides of the shuffle and do not travel.
    """
    if wrap not in ("legacy", "periodic"):
        raise ValueError(f"wrap must be 'legacy' or 'periodic', got {wrap!r}")
    cell = 2.0 * dr * (1.0 + 1e-9)
    keys = list(key_cols)
    period = 2.0 * (pi_approx if wrap == "legacy" else math.pi)
    in_cone = cone_residual(dr, wrap, period)
    many = crowded_events(probes, cands, crowded)
    sums = [F.sum(F.when(F.col("_cs") == s, F.col("_cpt"))).alias(n) for s, n in MAP_SPECIES.items()]

    def made(df: DataFrame) -> DataFrame:
        return derive(df) if derive else df

    # Events of few rows: the payload goes through the join and the sums, which stay by event.
    p, c = (df.join(many, "event_id", "left_anti").repartition("event_id") for df in (probes, cands))
    p = made(p).select(*[F.col(x) for x in probes.columns], F.col(eta).alias("_pe"), F.col(phi).alias("_pp"))
    c = candidate_copies(c, cell, wrap, period).drop("_kphi", "ce", "cp").withColumnRenamed("event_id", "_ev")
    payload = [x for x in probes.columns if x not in keys]
    few = p.join(c, (F.col("event_id") == F.col("_ev")) & in_cone, "left").groupBy(*keys).agg(*[F.first(x).alias(x) for x in payload], *sums)
    few = _by_momentum(few.select(*probes.columns, *MAP_SPECIES.values()), keys, pt, derive)

    # Only keys and momenta travel with the pairs; their sums, combined before they are
    # shuffled, meet the probes and their payload once.
    p, c = (df.join(many, "event_id", "left_semi") for df in (probes, cands))
    px, c = probe_cells(made(p), keys, cell, eta, phi), candidate_copies(c, cell, wrap, period).drop("_kphi")
    pairs = px.join(c, ["event_id", "ce", "cp"], "inner").where(in_cone)
    return few.unionByName(_by_momentum(p.join(pairs.groupBy(*keys).agg(*sums), keys, "left"), keys, pt, derive))


def isolation_sums(probes: DataFrame, cands: DataFrame, **kw) -> DataFrame:
    """Isolation of the probes reduced to (key, iso_ch, iso_gamma, iso_neu)."""
    keys = list(kw.get("key_cols", ("event_id", "species", "pos")))
    return isolation(probes, cands, **kw).select(*keys, "iso_ch", "iso_gamma", "iso_neu")


__all__ = ["isolation", "isolation_sums", "wrap_phi"]
