"""Composite feature operators: particle features (F1), event features (F2),
jet summary (A1), the padded particle matrix (R1, R2, R7) and the event
feature vector (R4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collidex.config import DEFAULT_CUTS, EVENT_FEATURES, PARTICLE_FEATURES, Cuts
from collidex.functions.kinematics import delta_r, sign3, transverse_mass
from collidex.operators.selection import (KINEMATICS, LEPTON_FIELDS, cap, event_particles, isolated_particles, within_caps,
                                         select_events, with_kinematics)

FEATURE_COLS = list(PARTICLE_FEATURES)
EVENT_COLS = list(EVENT_FEATURES)


def _row(cols: dict) -> list:
    return [F.col(c).cast("double").alias(n) if isinstance(c, str) else F.lit(float(c)).alias(n)
            for n, c in cols.items()]


def _feature_rows(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The 19 features of lepton rows (``is_lep``) and object rows in one projection, and ``extra`` columns."""
    sp, lep = F.col("species"), F.col("is_lep")
    is_trk = sp == "track"

    def pick(lep_val, obj_val):
        return F.when(lep, lep_val).otherwise(obj_val).cast("double")

    zero = F.lit(0.0)
    vals = {
        "Energy": pick(F.col("lep_e"), F.col("e")),
        "Px": pick(F.col("lep_px"), F.col("px")),
        "Py": pick(F.col("lep_py"), F.col("py")),
        "Pz": pick(F.col("lep_pz"), F.col("pz")),
        "Pt": pick(F.col("lep_p_pt"), F.col("pt")),
        "Eta": pick(F.col("lep_p_eta"), F.col("eta")),
        "Phi": pick(F.col("lep_p_phi"), F.col("phi")),
        "vtxX": pick(zero, F.when(is_trk, F.col("x")).otherwise(0.0)),
        "vtxY": pick(zero, F.when(is_trk, F.col("y")).otherwise(0.0)),
        "vtxZ": pick(zero, F.when(is_trk, F.col("z")).otherwise(0.0)),
        "ChPFIso": F.col("iso_ch"), "GammaPFIso": F.col("iso_gamma"), "NeuPFIso": F.col("iso_neu"),
        "isChHad": pick(zero, F.when(is_trk, 1.0).otherwise(0.0)),
        "isNeuHad": pick(zero, F.when(sp == "neutral", 1.0).otherwise(0.0)),
        "isGamma": pick(zero, F.when(sp == "photon", 1.0).otherwise(0.0)),
        "isEle": pick(F.col("lep_is_ele"), zero),
        "isMu": pick(F.col("lep_is_mu"), zero),
        "Charge": pick(F.col("lep_charge"), F.when(is_trk, sign3(F.col("pid"))).otherwise(0.0)),
    }
    return df.select("event_id", "seq", "species", *[vals[c].alias(c) for c in FEATURE_COLS], *extra)


def particle_features_skew_safe(particles: DataFrame, events: DataFrame,
                                cuts: Cuts = DEFAULT_CUTS, n_blocks: int | None = None,
                                materialize: bool = True) -> DataFrame:
    """F1 without any window partitioned by event alone, for inputs where one
    event may hold a large share of all rows.

    The lepton choice and event gates are partial aggregations (one row per
    event); overlap removal is a join with that per-event table, which AQE
    can split when one event is skewed; caps use the blocked exact rank over
    (event, species) ordered by ``pos``; matrix offsets are aggregated counts
    joined back. Same result as :func:`particle_features`. The isolation table
    feeds two branches (lepton choice and object rows); with ``materialize`` it
    is written once under the checkpoint folder instead of joined twice.
    """
    from collidex.operators.ordered import ordered_rank
    iso = isolated_particles(particles, cuts).drop(*KINEMATICS)
    if materialize:
        from collidex.session import written
        iso = written(iso, "isolated")
    # Values that follow from pt, eta and phi are made where they are used: they are neither written nor shuffled.
    selected, _ = select_events(particles, events, cuts, iso=with_kinematics(iso.where(F.col("species").isin("electron", "muon"))))
    sp = F.col("species")
    lep = selected.select("event_id", "lep_p_eta", "lep_p_phi")
    objs = iso.where(sp.isin("track", "photon", "neutral")).select(
        "event_id", "species", "pos", "pt", "eta", "phi", "iso_ch", "iso_gamma", "iso_neu", *[F.when(sp == "track", F.col(c)).alias(c) for c in ("x", "y", "z", "pid")])
    objs = with_kinematics(objs.join(lep, "event_id"))
    d = delta_r("lep_p_eta", "lep_p_phi", "p_eta", "p_phi", cuts.pi_approx)
    objs = objs.where((sp != "track") | (d > cuts.overlap_dr)).drop("lep_p_eta", "lep_p_phi", *KINEMATICS)
    caps = {"track": cuts.max_tracks, "photon": cuts.max_photons, "neutral": cuts.max_neutrals}
    kept = (ordered_rank(objs, ["event_id", "species"], "pos", n_blocks=n_blocks)
            .where(within_caps(caps)))
    counts = kept.groupBy("event_id").agg(
        F.count(F.when(sp == "track", 1)).alias("n_trk"), F.count(F.when(sp == "photon", 1)).alias("n_pho"))
    offset = F.when(sp == "track", 0).when(sp == "photon", F.col("n_trk")).otherwise(
        F.col("n_trk") + F.col("n_pho"))
    kept = (with_kinematics(kept.join(counts, "event_id"))
            .withColumn("seq", (F.col("rank") + offset).cast("int"))
            .withColumn("is_lep", F.lit(False)))
    lep_rows = selected.select(
        "event_id", F.lit(0).alias("seq"), F.lit(True).alias("is_lep"),
        F.when(F.col("lep_is_ele") == 1.0, "electron").otherwise("muon").alias("species"),
        *[F.col(f"lep_{c}") for c in LEPTON_FIELDS], "lep_is_ele", "lep_is_mu",
        *[F.col(f"lep_{c}").alias(c) for c in ("iso_ch", "iso_gamma", "iso_neu")])
    return _feature_rows(kept.unionByName(lep_rows, allowMissingColumns=True))


def particle_features(particles: DataFrame, events: DataFrame, cuts: Cuts = DEFAULT_CUTS,
                      ep: DataFrame | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """one row per kept particle of each selected event.

    Columns: event_id, seq, species, the 19 features and ``extra`` ones of the per-event table. ``seq`` is the row
    of the particle in the padded matrix: 0 lepton, then tracks, photons and
    neutrals, each in array order and capped. All steps are windows over the
    event partitioning produced by :func:`event_particles`.
    """
    ep = ep if ep is not None else event_particles(particles, events, cuts)
    sp = F.col("species")
    d = delta_r("lep_p_eta", "lep_p_phi", "p_eta", "p_phi", cuts.pi_approx)
    rows = ep.where(F.col("is_lep") | ((sp == "track") & (d > cuts.overlap_dr))
                    | sp.isin("photon", "neutral"))
    # Lepton rows form their own (event, species) window partitions: never capped.
    kept = cap(rows, {"track": cuts.max_tracks, "photon": cuts.max_photons,
                      "neutral": cuts.max_neutrals, "electron": 1, "muon": 1})
    ev = Window.partitionBy("event_id")
    n_trk = F.count(F.when(sp == "track", 1)).over(ev)
    n_pho = F.count(F.when(sp == "photon", 1)).over(ev)
    offset = F.when(sp == "track", 0).when(sp == "photon", n_trk).otherwise(n_trk + n_pho)
    seq = F.when(F.col("is_lep"), 0).otherwise(F.col("rank") + offset).cast("int")
    kept = kept.withColumn("seq", seq)
    return _feature_rows(kept, extra)


#: Feature columns of an event's lepton row that hold fields of its lepton.
_LEPTON_COLS = dict(zip(LEPTON_FIELDS, ("Energy", "Px", "Py", "Pz", "Pt", "Eta", "Phi", "ChPFIso", "GammaPFIso", "NeuPFIso", "Charge")))


def lepton_rows(pf: DataFrame, events: DataFrame) -> DataFrame:
    """The lepton's row of each event of :func:`event_particles`, got back from particle features with their ``label``."""
    lep = pf.where("seq = 0").select("event_id", "label", F.lit(True).alias("is_lep"), *[F.col(c).alias(f"lep_{f}") for f, c in _LEPTON_COLS.items()],
                                     F.col("isEle").alias("lep_is_ele"), F.col("isMu").alias("lep_is_mu"))
    return lep.join(events.select("event_id", "met", "met_phi"), "event_id")


def jet_summary(particles: DataFrame, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    """A1: nJets, HT and nBjets per event over pt > jet_pt and |eta| < jet_eta."""
    jets = particles.where((F.col("species") == "jet") & (F.col("pt") > cuts.jet_pt)
                           & (F.abs(F.col("eta")) < cuts.jet_eta))
    return jets.groupBy("event_id").agg(
        F.count(F.lit(1)).cast("double").alias("nJets"),
        F.sum("pt").alias("HT"),
        F.count(F.when(F.col("btag") > 0, 1)).cast("double").alias("nBjets"))


def event_features(particles: DataFrame, events: DataFrame, cuts: Cuts = DEFAULT_CUTS,
                   ep: DataFrame | None = None) -> DataFrame:
    """the 14 event features and the label, one row per selected event.

    Standalone, only lepton candidates are isolation probes and the event
    choice is an aggregation (``select_events``); with ``ep`` from
    :func:`event_particles` the shared per-event table is reused.
    """
    if ep is not None:
        selected = ep.where(F.col("is_lep")).select(
            "event_id", "label", "met", "met_phi", *[f"lep_{c}" for c in LEPTON_FIELDS],
            "lep_is_ele", "lep_is_mu")
    else:
        selected, _ = select_events(particles, events, cuts)
    jets = jet_summary(particles, cuts)
    j = selected.join(jets, "event_id", "left")
    vals = {
        "HT": F.coalesce(F.col("HT"), F.lit(0.0)),
        "MET": F.col("met"),
        "phiMET": F.col("met_phi"),
        "MT": transverse_mass("met", "met_phi", "lep_p_pt", "lep_p_phi"),
        "nJets": F.coalesce(F.col("nJets"), F.lit(0.0)),
        "nBjets": F.coalesce(F.col("nBjets"), F.lit(0.0)),
        "LepPt": F.col("lep_p_pt"), "LepEta": F.col("lep_p_eta"), "LepPhi": F.col("lep_p_phi"),
        "LepIsoCh": F.col("lep_iso_ch"), "LepIsoGamma": F.col("lep_iso_gamma"),
        "LepIsoNeu": F.col("lep_iso_neu"), "LepCharge": F.col("lep_charge").cast("double"),
        "LepIsEle": F.col("lep_is_ele"),
    }
    return j.select("event_id", *[vals[c].cast("double").alias(c) for c in EVENT_COLS],
                    F.col("label").cast("int"))


def features(particles: DataFrame, events: DataFrame, cuts: Cuts = DEFAULT_CUTS,
             materialize: bool = False):
    """(particle_features, event_features) sharing one selection/isolation plan.

    The two outputs prune different columns, so Spark cannot reuse the
    isolation join between them when both are consumed by one plan. With
    ``materialize`` the shared per-event table is written once under the
    checkpoint folder and both outputs scan it.
    """
    ep = event_particles(particles, events, cuts)
    if materialize:
        import uuid
        from collidex.session import scratch_path
        spark = ep.sparkSession
        path = scratch_path(spark, f"event-particles-{uuid.uuid4().hex}")
        ep.write.parquet(path)
        ep = spark.read.parquet(path)
    return (particle_features(particles, events, cuts, ep),
            event_features(particles, events, cuts, ep))


def assemble_hfeatures(ev: DataFrame, as_vector: bool = False, out: str = "hfeatures") -> DataFrame:
    """The 14 event features as array<double> or a dense ML vector."""
    arr = F.array(*[F.col(c) for c in EVENT_COLS])
    if as_vector:
        from pyspark.ml.functions import array_to_vector
        arr = array_to_vector(arr)
    return ev.select("event_id", arr.alias(out), "label")


def assemble_lfeatures(pf: DataFrame, n_rows: int | None = DEFAULT_CUTS.n_rows,
                       out: str = "lfeatures") -> DataFrame:
    """R1 + R2: per-event particle matrix (array<array<double>>) in ``seq`` order,
    zero-padded to ``n_rows`` rows after the last neutral (None: no padding).

    Collects one event's rows, bounded by the caps (at most ``n_rows``).
    """
    row = F.array(*[F.col(c) for c in FEATURE_COLS])
    lf = F.transform(F.array_sort(F.collect_list(F.struct(F.col("seq"), row.alias("f")))),
                     lambda s: s["f"])
    agg = pf.groupBy("event_id").agg(lf.alias(out))
    if n_rows is None:
        return agg
    zero = F.array(*[F.lit(0.0)] * len(FEATURE_COLS))
    pad = F.array_repeat(zero, F.greatest(F.lit(n_rows) - F.size(out), F.lit(0)))
    return agg.select("event_id", F.concat(F.col(out), pad).alias(out))


def unpad(lf_col: str = "lfeatures"):
    """Drop matrix rows that are zero in all features.

    A padding row is told by one comparison; only other rows are searched for a value.
    """
    zero = F.lit([0.0] * len(FEATURE_COLS))
    return F.filter(F.col(lf_col), lambda r: (r != zero) & F.exists(r, lambda v: v != 0))


def nested_sizes(df: DataFrame, col: str = "lfeatures") -> DataFrame:
    """Rows of the matrix, columns of its first row, and non-padding rows."""
    return df.select("event_id", F.size(col).alias("n_rows"),
                     F.size(F.get(F.col(col), 0)).alias("n_cols"),
                     F.size(unpad(col)).alias("n_real"))
