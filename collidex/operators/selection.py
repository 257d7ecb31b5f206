"""Event selection: candidate maps (P5), preselection (P6, P7), first isolated
lepton per flavour (W1), lepton choice (W2), track overlap removal (J2),
selected-event restriction (J3) and per-species caps (W3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collidex.config import DEFAULT_CUTS, Cuts
from collidex.functions.kinematics import delta_r, four_vector, p4_eta, p4_phi, p4_pt
from collidex.operators.isolation import isolation

LEPTON_FIELDS = ["e", "px", "py", "pz", "p_pt", "p_eta", "p_phi",
                 "iso_ch", "iso_gamma", "iso_neu", "charge"]

#: Columns of :func:`with_kinematics`.
KINEMATICS = ["e", "px", "py", "pz", "p_pt", "p_eta", "p_phi"]


def map_condition(cuts: Cuts = DEFAULT_CUTS):
    """P5 predicate: track pt > 0.5, photon and neutral ET > 1.0 (strict)."""
    sp, pt = F.col("species"), F.col("pt")
    return (((sp == "track") & (pt > cuts.track_pt))
            | ((sp == "photon") & (pt > cuts.photon_et))
            | ((sp == "neutral") & (pt > cuts.neutral_et)))


def candidate_maps(particles: DataFrame, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    """P5: particles entering the isolation maps."""
    return particles.where(map_condition(cuts))


def with_kinematics(df: DataFrame) -> DataFrame:
    """Massless four-vector from (pt, eta, phi) and the values recomputed from it."""
    v = four_vector("pt", "eta", "phi", 0.0)
    out = df.select("*", *[c.alias(k) for k, c in v.items()])
    return out.select("*", p4_pt("px", "py").alias("p_pt"),
                      p4_eta("px", "py", "pz").alias("p_eta"),
                      p4_phi("px", "py").alias("p_phi"))


def preselect(events: DataFrame, maps: DataFrame) -> DataFrame:
    """P6 + P7: all three maps non-empty and a non-zero lepton counter.

    The per-event flags are a partial (map-side combined) aggregation.
    """
    sp = F.col("species")
    flags = (maps.groupBy("event_id")
             .agg(F.max(F.when(sp == "track", 1).otherwise(0)).alias("has_trk"),
                  F.max(F.when(sp == "photon", 1).otherwise(0)).alias("has_pho"),
                  F.max(F.when(sp == "neutral", 1).otherwise(0)).alias("has_neu"))
             .where("has_trk = 1 AND has_pho = 1 AND has_neu = 1")
             .select("event_id"))
    gated = events.where((F.col("electron_size") > 0) | (F.col("muon_size") > 0))
    return gated.join(flags, "event_id", "left_semi")


def preselect_nested(events: DataFrame, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    """P6 + P7 and the momentum part of W1 inside the nested row, before anything is flattened.

    Keeps events with a non-zero lepton counter, a particle for each of the three maps and a
    lepton above ``lep_pt``. All others are rejected later anyway, so features stay the same,
    but they are neither exploded nor shuffled nor isolated.
    """
    def some(col: str, field: str, least: float) -> Column:
        return F.coalesce(F.exists(col, lambda p: F.coalesce(p[field] > least, F.lit(False))), F.lit(False))

    return events.where(
        ((F.col("Electron_size") > 0) | (F.col("MuonTight_size") > 0))
        & some("EFlowTrack", "PT", cuts.track_pt) & some("EFlowPhoton", "ET", cuts.photon_et) & some("EFlowNeutralHadron", "ET", cuts.neutral_et)
        & (some("Electron", "PT", cuts.lep_pt) | some("MuonTight", "PT", cuts.lep_pt)))


def isolated_particles(particles: DataFrame, cuts: Cuts = DEFAULT_CUTS,
                       leptons_only: bool = False, isolate=isolation) -> DataFrame:
    """Map particles and lepton candidates with four-vectors and isolation.

    One grid join covers every probe the pipeline needs (leptons, tracks,
    photons, neutrals), so the candidate maps are shuffled once. With
    ``leptons_only`` only lepton candidates are probes (enough for event
    features). ``isolate`` is ``isolation`` or ``isolation_dense``.
    """
    maps = candidate_maps(particles, cuts)
    sp, pt = F.col("species"), F.col("pt")
    lep = sp.isin("electron", "muon") & (pt > cuts.lep_pt)
    probes = particles.where(lep if leptons_only else (map_condition(cuts) | lep))
    return isolate(probes, maps, dr=cuts.dr, wrap=cuts.wrap, pi_approx=cuts.pi_approx, derive=with_kinematics)


def choose_lepton(iso_leptons: DataFrame, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    """W1 + W2: one lepton per event.

    W1: the first (lowest ``pos``) electron and the first muon with
    pt > lep_pt and isoCh + isoNeu + isoGamma < iso_max.
    W2: if both exist, the electron iff its eta (or pt, per ``lepton_rank``)
    is strictly larger, else the muon.
    Written as one aggregation by event (``min_by`` skips NULL orderings).
    """
    sp = F.col("species")
    ok = ((F.col("iso_ch") + F.col("iso_neu") + F.col("iso_gamma")) < cuts.iso_max) & (
        F.col("pt") > cuts.lep_pt)
    st = F.struct(*[F.col(c) for c in LEPTON_FIELDS])
    firsts = (iso_leptons.where(sp.isin("electron", "muon") & ok).groupBy("event_id")
              .agg(F.min_by(st, F.when(sp == "electron", F.col("pos"))).alias("ele"),
                   F.min_by(st, F.when(sp == "muon", F.col("pos"))).alias("mu")))
    rank = {"eta": "p_eta", "pt": "p_pt"}[cuts.lepton_rank]
    pick_ele = F.col("mu").isNull() | (F.col("ele").isNotNull()
                                       & (F.col(f"ele.{rank}") > F.col(f"mu.{rank}")))
    lep = F.when(pick_ele, F.col("ele")).otherwise(F.col("mu"))
    return firsts.select(
        "event_id", *[lep[c].alias(f"lep_{c}") for c in LEPTON_FIELDS],
        F.when(pick_ele, 1.0).otherwise(0.0).alias("lep_is_ele"),
        F.when(pick_ele, 0.0).otherwise(1.0).alias("lep_is_mu"))


def select_events(particles: DataFrame, events: DataFrame, cuts: Cuts = DEFAULT_CUTS,
                  iso: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Selected events with their lepton, and the isolated particle table.

    Returns ``(selected, iso)``: ``selected`` has one row per accepted event
    (event columns + ``lep_*``); ``iso`` is :func:`isolated_particles`.
    """
    iso = iso if iso is not None else isolated_particles(particles, cuts, leptons_only=True)
    maps = candidate_maps(particles, cuts)
    pre = preselect(events, maps)
    lep = choose_lepton(iso.where(F.col("species").isin("electron", "muon")), cuts)
    return pre.join(lep, "event_id"), iso


def remove_overlap(tracks: DataFrame, selected: DataFrame, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    """J2 + J3: tracks of selected events farther than ``overlap_dr`` from the lepton.

    ``selected`` has one row per event, so this is a plain equi join.
    """
    lep = selected.select("event_id", "lep_p_eta", "lep_p_phi")
    d = delta_r("lep_p_eta", "lep_p_phi", "p_eta", "p_phi", cuts.pi_approx)
    return tracks.join(lep, "event_id").where(d > cuts.overlap_dr).drop("lep_p_eta", "lep_p_phi")


def within_caps(caps: dict[str, int | None]) -> Column:
    """W3 condition on ``species`` and ``rank``; a cap of None holds for every rank."""
    keep = F.lit(False)
    for s, n in caps.items():
        keep = F.when(F.col("species") == s, F.lit(True) if n is None else F.col("rank") <= int(n)).otherwise(keep)
    return keep


def cap(particles: DataFrame, caps: dict[str, int | None]) -> DataFrame:
    """Keep the first ``caps[species]`` rows per (event, species) in ``pos`` order.

    Adds ``rank`` (1-based); a cap of None keeps all rows. The window is partitioned by event, so it reuses
    the event-keyed partitioning of the preceding join.
    """
    w = Window.partitionBy("event_id", "species").orderBy("pos")
    return particles.withColumn("rank", F.row_number().over(w)).where(within_caps(caps))


def event_particles(particles: DataFrame, events: DataFrame, cuts: Cuts = DEFAULT_CUTS,
                    iso: DataFrame | None = None) -> DataFrame:
    """Isolated particles of selected events, each row carrying its event's lepton.

    After the isolation join everything here is per event, so it is written as
    window functions over one ``event_id`` partitioning (one exchange) instead
    of split-aggregate-rejoin branches:

    * P6: the three map flags are ``max`` over the event window;
    * W1: the first isolated electron/muon are ``min_by(.., pos)`` over it;
    * W2: the choice between them is a row expression;
    * P7 + J3: the lepton counters and event info come from one join with the
      event table (hash-partitioned on the same key).

    Output: iso rows + ``is_lep`` (the chosen lepton's own row) + ``lep_*``
    fields + label, met, met_phi.
    """
    iso = iso if iso is not None else isolated_particles(particles, cuts)
    sp = F.col("species")
    ev = Window.partitionBy("event_id")
    ok = (sp.isin("electron", "muon") & (F.col("pt") > cuts.lep_pt)
          & ((F.col("iso_ch") + F.col("iso_neu") + F.col("iso_gamma")) < cuts.iso_max))
    st = F.struct(F.col("species"), F.col("pos"), *[F.col(c) for c in LEPTON_FIELDS])
    rank = {"eta": "p_eta", "pt": "p_pt"}[cuts.lepton_rank]
    w = iso.select(
        "*",
        F.max((sp == "track").cast("int")).over(ev).alias("_has_trk"),
        F.max((sp == "photon").cast("int")).over(ev).alias("_has_pho"),
        F.max((sp == "neutral").cast("int")).over(ev).alias("_has_neu"),
        F.min_by(st, F.when(ok & (sp == "electron"), F.col("pos"))).over(ev).alias("_ele"),
        F.min_by(st, F.when(ok & (sp == "muon"), F.col("pos"))).over(ev).alias("_mu"))
    pick_ele = F.col("_mu").isNull() | (F.col("_ele").isNotNull()
                                        & (F.col(f"_ele.{rank}") > F.col(f"_mu.{rank}")))
    lep = F.when(pick_ele, F.col("_ele")).otherwise(F.col("_mu"))
    w = (w.where((F.col("_has_trk") == 1) & (F.col("_has_pho") == 1) & (F.col("_has_neu") == 1)
                 & (F.col("_ele").isNotNull() | F.col("_mu").isNotNull()))
         .select(*iso.columns, lep.alias("_lep"),
                 F.when(pick_ele, 1.0).otherwise(0.0).alias("lep_is_ele")))
    w = w.select(*iso.columns,
                 ((sp == F.col("_lep.species")) & (F.col("pos") == F.col("_lep.pos"))).alias("is_lep"),
                 *[F.col(f"_lep.{c}").alias(f"lep_{c}") for c in LEPTON_FIELDS],
                 "lep_is_ele", (F.lit(1.0) - F.col("lep_is_ele")).alias("lep_is_mu"))
    gated = (events.where((F.col("electron_size") > 0) | (F.col("muon_size") > 0))
             .select("event_id", "label", "met", "met_phi"))
    return w.join(gated, "event_id")
