"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (through the lineitem-derived event
fixture or directly) and covers them whole. Double outputs are rounded with
``r6`` so they compare exactly against the DuckDB oracle in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collidex.config import DEFAULT_CUTS, TIGHT_CUTS, Cuts
from collidex.functions import kinematics as K
from collidex.operators import features as FE
from collidex.operators import selection as SE
from collidex.operators.dense_isolation import isolation_dense
from collidex.sources import events as EV
from collidex.session import written
from collidex.sources.fixture import fixture, fixture_nested_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Apply r6 to every double column (for exact cross-engine comparison)."""
    return df.select(*[K.r6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------- sources ---

@query("events_scan")
def q_events_scan(spark, sf_dir):
    """Nested events scanned with the minimal schema, per-event sizes."""
    nested = fixture_nested_events(spark, sf_dir)
    ev = nested.select(*EV.select_required(nested).columns, "label")
    met = F.get(F.col("MissingET"), 0)
    return rounded(ev.select(
        "event_id", "label", "Electron_size", "MuonTight_size",
        F.size("EFlowTrack").alias("n_tracks"), F.size("EFlowPhoton").alias("n_photons"),
        F.size("EFlowNeutralHadron").alias("n_neutrals"), F.size("Jet").alias("n_jets"),
        met["MET"].alias("met"), met["Phi"].alias("met_phi")))


@query("particles")
def q_particles(spark, sf_dir):
    """Nested events flattened to the particle relation."""
    return rounded(EV.explode_particles(fixture_nested_events(spark, sf_dir)))


@query("union_samples")
def q_union_samples(spark, sf_dir):
    """Three class samples tagged with their literal and unioned."""
    nested = fixture_nested_events(spark, sf_dir)
    samples = [EV.tag(nested.where(F.col("label") == k), k) for k in (0, 1, 2)]
    u = EV.union_samples(samples)
    return u.select("event_id", "label", F.size("EFlowTrack").alias("n_tracks"))


@query("sample_stats")
def q_sample_stats(spark, sf_dir):
    """One-line class counts in a single pass."""
    _, events = fixture(spark, sf_dir)
    return EV.sample_stats(events)


@query("events_preview")
def q_events_preview(spark, sf_dir):
    """Deterministic bounded preview (the limit is the feature)."""
    _, events = fixture(spark, sf_dir)
    return rounded(EV.preview(events, 10, ["event_id"]))


# ------------------------------------------------------------- kinematics ---

@query("kinematics")
def q_kinematics(spark, sf_dir):
    """K1-K6: four-vectors and recomputed pt/eta/phi of every particle."""
    parts, _ = fixture(spark, sf_dir)
    v = K.four_vector("pt", "eta", "phi", 0.0)
    out = parts.select("event_id", "species", "pos", *[c.alias(k) for k, c in v.items()],
                       K.energy(*[K.four_vector("pt", "eta", "phi")[c] for c in ("px", "py", "pz")],
                                F.col("x")).alias("e_massive"),
                       K.energy(*[K.four_vector("pt", "eta", "phi")[c] for c in ("px", "py", "pz")],
                                -F.col("x") * F.lit(10.0)).alias("e_negative"))
    return rounded(out.select(
        "*", K.p4_pt("px", "py").alias("p_pt"), K.p_mag("px", "py", "pz").alias("p_mag"),
        K.cos_theta("px", "py", "pz").alias("cos_theta"), K.p4_eta("px", "py", "pz").alias("p_eta"),
        K.p4_phi("px", "py").alias("p_phi")))


@query("delta_r")
def q_delta_r(spark, sf_dir):
    """K7/K8: wrapped azimuth difference and distance to the event's MET direction."""
    parts, events = fixture(spark, sf_dir)
    j = parts.join(events.select("event_id", "met_phi"), "event_id")
    return rounded(j.select(
        "event_id", "species", "pos",
        K.wrap_phi(F.col("phi") - F.col("met_phi") * F.lit(2.0)).alias("dphi"),
        K.delta_r("eta", "phi", F.lit(0.0), F.col("met_phi") * F.lit(2.0)).alias("dr")))


# -------------------------------------------------------------- selection ---

@query("pt_map")
def q_pt_map(spark, sf_dir):
    """P5: particles entering the three isolation maps."""
    parts, _ = fixture(spark, sf_dir)
    return rounded(SE.candidate_maps(parts).select("event_id", "species", "pos", "pt", "eta", "phi"))


@query("preselect")
def q_preselect(spark, sf_dir):
    """Events with three non-empty maps and a lepton counter."""
    parts, events = fixture(spark, sf_dir)
    return SE.preselect(events, SE.candidate_maps(parts)).select(
        "event_id", "label", "electron_size", "muon_size")


@query("isolation")
def q_isolation(spark, sf_dir):
    """charged/photon/neutral cone isolation of every probe."""
    parts, _ = fixture(spark, sf_dir)
    return rounded(SE.isolated_particles(parts).select(
        "event_id", "species", "pos", "iso_ch", "iso_gamma", "iso_neu"))


@query("isolation_dense")
def q_isolation_dense(spark, sf_dir):
    """J1 over adaptive cells; the low limit splits cells of the fixture's sparse events too."""
    parts, _ = fixture(spark, sf_dir)
    iso = SE.isolated_particles(parts, isolate=partial(isolation_dense, limit=4, max_depth=6))
    return rounded(iso.select("event_id", "species", "pos", "iso_ch", "iso_gamma", "iso_neu"))


@query("lepton_first")
def q_lepton_first(spark, sf_dir):
    """First isolated electron and first isolated muon per event."""
    parts, _ = fixture(spark, sf_dir)
    c = DEFAULT_CUTS
    iso = SE.isolated_particles(parts).where(F.col("species").isin("electron", "muon"))
    ok = (F.col("iso_ch") + F.col("iso_neu") + F.col("iso_gamma")) < c.iso_max
    first = (iso.where(ok).groupBy("event_id", "species")
             .agg(F.min("pos").alias("pos")))
    return first


@query("lepton_select")
def q_lepton_select(spark, sf_dir):
    """The chosen lepton of each selected event."""
    parts, events = fixture(spark, sf_dir)
    sel, _ = SE.select_events(parts, events)
    return rounded(sel.select("event_id", F.when(F.col("lep_is_ele") == 1.0, "electron")
                              .otherwise("muon").alias("lep_species"),
                              F.col("lep_p_pt").alias("lep_pt"), F.col("lep_p_eta").alias("lep_eta"),
                              F.col("lep_charge").cast("double").alias("lep_charge")))


@query("track_overlap")
def q_track_overlap(spark, sf_dir):
    """Tracks of selected events kept and removed by the lepton overlap cut."""
    parts, events = fixture(spark, sf_dir)
    iso = SE.isolated_particles(parts)
    sel, _ = SE.select_events(parts, events, iso=iso)
    tracks = iso.where(F.col("species") == "track")
    kept = SE.remove_overlap(tracks, sel).groupBy("event_id").agg(F.count(F.lit(1)).alias("n_kept"))
    allt = tracks.join(sel.select("event_id"), "event_id").groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_all"))
    return (allt.join(kept, "event_id", "left")
            .select("event_id", F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"),
                    (F.col("n_all") - F.coalesce("n_kept", F.lit(0))).cast("long").alias("n_removed")))


@query("jets_ht")
def q_jets_ht(spark, sf_dir):
    """A1: jet count, HT and b-tag count per event."""
    parts, _ = fixture(spark, sf_dir)
    return rounded(FE.jet_summary(parts))


# --------------------------------------------------------------- features ---

def _event_features(spark, sf_dir, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    parts, events = fixture(spark, sf_dir)
    return FE.event_features(parts, events, cuts)


def _particle_features(spark, sf_dir, cuts: Cuts = DEFAULT_CUTS) -> DataFrame:
    parts, events = fixture(spark, sf_dir)
    return FE.particle_features(parts, events, cuts)


@query("event_features")
def q_event_features(spark, sf_dir):
    """the flagship - 14 event features per selected event."""
    return rounded(_event_features(spark, sf_dir))


@query("event_features_tight")
def q_event_features_tight(spark, sf_dir):
    """event features under the tight cut profile."""
    return rounded(_event_features(spark, sf_dir, TIGHT_CUTS))


@query("particle_features")
def q_particle_features(spark, sf_dir):
    """19 features per kept particle."""
    return rounded(_particle_features(spark, sf_dir))


@query("particle_caps")
def q_particle_caps(spark, sf_dir):
    """Particle features with small caps (5 tracks, 3 photons, 3 neutrals)."""
    cuts = DEFAULT_CUTS.with_(max_tracks=5, max_photons=3, max_neutrals=3)
    return rounded(_particle_features(spark, sf_dir, cuts).select(
        "event_id", "seq", "species", "Pt", "Eta", "Phi", "ChPFIso"))


# -------------------------------------------------------------- sequences ---

from collidex.operators import sequences as SQ  # noqa: E402


@query("lfeatures")
def q_lfeatures(spark, sf_dir):
    """Padded particle matrix, checked in flat form (real rows only)."""
    lf = FE.assemble_lfeatures(_particle_features(spark, sf_dir, DEFAULT_CUTS.with_matrix_caps()))
    rows = lf.select("event_id", F.posexplode("lfeatures").alias("row", "f"))
    rows = rows.where(F.exists("f", lambda v: v != 0))
    return rounded(rows.select("event_id", F.col("row").cast("int").alias("row"),
                               *[F.col("f")[i].alias(c) for i, c in enumerate(FE.FEATURE_COLS)]))


@query("lfeatures_size")
def q_lfeatures_size(spark, sf_dir):
    """Matrix sizes (801 x 19) and non-padding row counts."""
    return FE.nested_sizes(FE.assemble_lfeatures(_particle_features(spark, sf_dir, DEFAULT_CUTS.with_matrix_caps())))


@query("sequence_order")
def q_sequence_order(spark, sf_dir):
    """Particles ordered by delta R to the lepton, descending."""
    o = SQ.sequence_order(_particle_features(spark, sf_dir))
    return rounded(o.select("event_id", "seq", "idx", "dr"))


@query("sequence_scaled")
def q_sequence_scaled(spark, sf_dir):
    """Ordered, per-event standardised particle rows."""
    return rounded(SQ.sequence_features(_particle_features(spark, sf_dir)))


@query("inclusive_features")
def q_inclusive_features(spark, sf_dir):
    """pooled sequence summary joined to scaled event features."""
    parts, events = fixture(spark, sf_dir)
    pf, ef = FE.features(parts, events, materialize=True)
    return rounded(SQ.inclusive_features(SQ.sequence_features(pf), ef))


# ------------------------------------------------------------- evaluation ---

from collidex.operators import evaluate as EVL  # noqa: E402


def _embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")


def _class_scores(shift: int = 0):
    """Scores of ten classes, each a signed integer weighting of all embedding values.

    Values are taken in units of 2^-20, so sums are exact and independent of their order.
    """
    def score(c):
        terms = F.transform("embedding", lambda v, j: F.floor(v.cast("double") * 1048576)
                            * (((j + 1 + shift) * (2 * c + 3)) % 11 - 5))
        return F.aggregate(terms, F.lit(0).cast("long"), lambda s, x: s + x) / 1048576
    return F.array(*[score(c) for c in range(10)])


def _emb_predictions(spark, sf_dir):
    """Fixed arithmetic scores over the whole embedding stand in for a classifier's."""
    e = _embeddings(spark, sf_dir).withColumn("scores", _class_scores())
    return e.select("vec_id", F.col("label").alias("y_true"), EVL.argmax("scores").alias("y_pred"))


@query("label_counts")
def q_label_counts(spark, sf_dir):
    """A2: events per class."""
    _, events = fixture(spark, sf_dir)
    return EVL.label_counts(events)


@query("class_counts")
def q_class_counts(spark, sf_dir):
    """A4: counts of predicted classes after argmax, most frequent first."""
    return EVL.label_counts(_emb_predictions(spark, sf_dir), "y_pred")


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    """Zero-filled confusion matrix, rows = true label."""
    return EVL.confusion_matrix(_emb_predictions(spark, sf_dir), list(range(10)))


@query("accuracy")
def q_accuracy(spark, sf_dir):
    """Accuracy of argmax predictions."""
    return rounded(EVL.accuracy(_emb_predictions(spark, sf_dir)))


def _emb_long(spark, sf_dir):
    e = _embeddings(spark, sf_dir).withColumn("scores", _class_scores())
    return EVL.one_vs_rest(e, "scores", "label", list(range(10)))


@query("roc_curve")
def q_roc_curve(spark, sf_dir):
    """One-vs-rest ROC curve per class."""
    r = EVL.roc_curve(_emb_long(spark, sf_dir))
    return r.select("class", "threshold", "tp", "fp", K.r6("tpr").alias("tpr"), K.r6("fpr").alias("fpr"))


@query("roc_curve_binned")
def q_roc_curve_binned(spark, sf_dir, bins: int = 50):
    """W7 with ``bins``: the bounded curve per class, and whether each of its points is within 1/bins of the exact curve."""
    from collidex.operators.ordered import ordered_cumsum
    long = written(_emb_long(spark, sf_dir), "scores")
    binned = EVL.roc_curve(long, bins=bins)
    exact = ordered_cumsum(EVL.roc_points(long), ["class"], "score", ["pos", "neg"], descending=True, inclusive=False).select(
        "class", F.col("score").alias("threshold"), "cum_pos", "cum_neg")
    off = F.greatest(F.abs(F.col("tpr") - F.col("cum_pos") / F.col("P")), F.abs(F.col("fpr") - F.col("cum_neg") / F.col("N")))
    return binned.join(exact, ["class", "threshold"], "left").groupBy("class").agg(
        F.first("P").alias("n_pos"), F.first("N").alias("n_neg"), F.bool_and(F.coalesce(off <= 1 / bins, F.lit(False))).alias("within_bound"),
        (F.count(F.lit(1)) <= 2 * bins + 2).alias("bounded"))


@query("auc")
def q_auc(spark, sf_dir):
    """Trapezoidal AUC per class."""
    return rounded(EVL.auc(_emb_long(spark, sf_dir)))


@query("model_compare")
def q_model_compare(spark, sf_dir):
    """AUC per (model, class) for three fixed-score models, best flagged."""
    e = _embeddings(spark, sf_dir)
    models = F.explode(F.array(*[F.struct(F.lit(name).alias("model"),
                                          _class_scores(shift=i).alias("scores"))
                                 for i, name in enumerate(["baseline", "grid", "random"])]))
    m = e.select("label", models.alias("m")).select("label", "m.model", "m.scores")
    long = EVL.one_vs_rest(m, "scores", "label", list(range(10)), model_col="model")
    return rounded(EVL.compare_models(long))


def _history(spark, sf_dir):
    return EVL.history_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("worker_iterations")
def q_worker_iterations(spark, sf_dir):
    """A5: iterations per (trainer, worker)."""
    return EVL.worker_iterations(_history(spark, sf_dir))


@query("loss_curve")
def q_loss_curve(spark, sf_dir):
    """Bucketed mean loss and spread across workers."""
    return rounded(EVL.loss_curve(_history(spark, sf_dir), bucket=100))


@query("loss_smooth")
def q_loss_smooth(spark, sf_dir):
    """Loss averaged per batch of 100 iterations, per trainer."""
    from collidex.operators.ordered import ordered_rank
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("trainer"), "event_id", F.col("value").alias("loss"))
    s = ordered_rank(ev, ["trainer"], "event_id", out="it").withColumn("it", F.col("it") - 1)
    return rounded(EVL.loss_smooth(s, 100))


# ------------------------------------------------------------ preparation ---

from collidex.operators import models as MD  # noqa: E402
from collidex.operators import prep as PR  # noqa: E402
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402


@query("one_hot")
def q_one_hot(spark, sf_dir):
    """M1: one-hot labels with every class kept."""
    _, events = fixture(spark, sf_dir)
    oh = PR.one_hot(events.select("event_id", "label"))
    arr = vector_to_array("encoded_label")
    return oh.select("event_id", "label", *[arr[i].alias(f"oh_{i}") for i in range(3)])


@query("split_counts")
def q_split_counts(spark, sf_dir):
    """A3/M4: reproducible 80/20 split, rows per (split, label)."""
    _, events = fixture(spark, sf_dir)
    s = PR.key_split(events, "event_id")
    return s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("count"))


@query("undersample")
def q_undersample(spark, sf_dir):
    """M5: class-balanced subset (smallest class size per class)."""
    _, events = fixture(spark, sf_dir)
    return PR.undersample(events.select("event_id", "label"))


@query("min_max")
def q_min_max(spark, sf_dir):
    """M2/M3: event features min-max scaled with limits fitted on the train split."""
    ef = PR.key_split(_event_features(spark, sf_dir), "event_id")
    train = ef.where(F.col("split") == "train")
    model = PR.prep_pipeline(train)
    out = model.transform(ef).select("event_id", "split", "features")
    return rounded(PR.vector_columns(out, "features", 14))


@query("vector_columns")
def q_vector_columns(spark, sf_dir):
    """Event features as a dense vector and back to one column per element."""
    v = PR.assemble(_event_features(spark, sf_dir)).select("event_id", "label", "dense_features")
    return rounded(PR.vector_columns(v, "dense_features", 14))


@query("shuffle")
def q_shuffle(spark, sf_dir):
    """Seeded global shuffle of the events."""
    _, events = fixture(spark, sf_dir)
    return PR.shuffle(events.select("event_id", "label"), seed=7)


def _emb_ml(spark, sf_dir):
    e = _embeddings(spark, sf_dir)
    feats = array_to_vector(F.transform("embedding", lambda v: v.cast("double")))
    return PR.key_split(e.select("vec_id", "label", feats.alias("features")), "vec_id")


@query("rf_predict")
def q_rf_predict(spark, sf_dir):
    """M6/M9: random forest (50 trees, depth 10) trained on the train split, scored on test."""
    d = _emb_ml(spark, sf_dir)
    model = MD.train_forest(d.where(F.col("split") == "train"))
    return MD.score(model, d.where(F.col("split") == "test"), keep=["vec_id", "label"])


@query("mlp_predict")
def q_mlp_predict(spark, sf_dir):
    """M7/M8/M9: 14-50-20-10-3 network on scaled event features."""
    ef = written(PR.key_split(_event_features(spark, sf_dir), "event_id"), "event-features")   # read by each fit and the score
    train = ef.where(F.col("split") == "train")
    prep = PR.prep_pipeline(train)
    model = MD.train_network(prep.transform(train), max_iter=50)
    return MD.score(model, prep.transform(ef.where(F.col("split") == "test")),
                    keep=["event_id", "label"])


# ----------------------------------------------------------------- images ---

from collidex.operators import images as IM  # noqa: E402



def _image_inputs(spark, sf_dir):
    parts, events = fixture(spark, sf_dir)
    return FE.features(parts, events, materialize=True)


@query("image_points")
def q_image_points(spark, sf_dir):
    """Drawable points of every selected event."""
    pf, ef = _image_inputs(spark, sf_dir)
    return rounded(IM.image_points(pf, ef))


@query("image_pixels")
def q_image_pixels(spark, sf_dir):
    """Covered (point, pixel) pairs per event and point type, on the whole 500 x 314 raster."""
    pf, ef = _image_inputs(spark, sf_dir)
    return IM.cover_counts(IM.scanlines(IM.image_points(pf, ef)))


@query("image_blend")
def q_image_blend(spark, sf_dir):
    """Blended 500 x 314 image per event, summarised (touched pixels, channel sums)."""
    pf, ef = _image_inputs(spark, sf_dir)
    runs = IM.event_runs(pf, ef).withColumn("n", F.col("y1") - F.col("y0") + 1)
    return runs.groupBy("event_id").agg(
        F.sum("n").cast("long").alias("n_pixels"), *[K.r3(F.sum(F.col(c) * F.col("n"))).alias(f"sum_{c}") for c in "rgb"],
        K.r6(F.min("r")).alias("min_r"))


@query("image_dense")
def q_image_dense(spark, sf_dir):
    """Dense 500 x 314 x 3 image arrays of all events with their labels, summarised by size and mean value."""
    pf, ef = _image_inputs(spark, sf_dir)
    img = IM.dense_images(IM.event_runs(pf, ef), labels=ef.select("event_id", "label"))
    sized = img.select("event_id", "label", F.size("image").alias("n_eta"), F.size(F.get(F.col("image"), 0)).alias("n_phi"), F.explode_outer("image").alias("row"))
    # Every pixel of the arrays is read, by compiled code: first the rows, then their pixels. (For a plain explode
    # a filter on the size of the image is inferred and pushed down, where the image would be made a second time.)
    pixels = sized.select("event_id", "label", "n_eta", "n_phi", F.explode_outer("row").alias("p"))
    total = F.sum(F.col("p")[0] + F.col("p")[1] + F.col("p")[2])
    return pixels.groupBy("event_id", "label", "n_eta", "n_phi").agg(total.alias("s")).select(
        "event_id", "label", "n_eta", "n_phi", K.r6(F.col("s") / (F.col("n_eta") * F.col("n_phi") * 3)).alias("mean_value"))


@query("image_struct")
def q_image_struct(spark, sf_dir):
    """I8: images of all events as Spark image structs (8-bit BGR), with the digest of their bytes."""
    pf, ef = _image_inputs(spark, sf_dir)
    enc = IM.image_structs(IM.event_runs(pf, ef), labels=ef.select("event_id", "label"))
    s = F.col("image_struct")
    return enc.select("event_id", s["height"].alias("height"), s["width"].alias("width"), s["nChannels"].alias("n_channels"),
                      F.length(s["data"]).alias("n_bytes"), F.sha2(s["data"], 256).alias("data_sha256"))


@query("inclusive_predict")
def q_inclusive_predict(spark, sf_dir):
    """M14 + M7/M9: pooled sequence and event features fanned into one vector,
    a network trained on the train split and scored on test."""
    parts, events = fixture(spark, sf_dir)
    pf, ef = FE.features(parts, events)        # not written: particle rows stay dealt by event up to their pooling
    inc = SQ.inclusive_features(SQ.sequence_features(pf), written(ef, "event-features"))
    inc = written(inc, "inclusive-features")   # read by the fit and the score
    inc = PR.key_split(SQ.inclusive_input(inc), "event_id")
    model = MD.train_network(inc.where(F.col("split") == "train"), layers=(52, 50, 20, 10, 3),
                             max_iter=50)
    return MD.score(model, inc.where(F.col("split") == "test"), keep=["event_id", "label"])


# ------------------------------------------------- skew-safe formulations ---

@query("particle_features_skew_safe")
def q_particle_features_skew_safe(spark, sf_dir):
    """F1 via aggregations, AQE-splittable joins and blocked exact ranks
    (no window partitioned by event alone)."""
    parts, events = fixture(spark, sf_dir)
    return rounded(FE.particle_features_skew_safe(parts, events))


@query("sequence_scaled_skew_safe")
def q_sequence_scaled_skew_safe(spark, sf_dir):
    """F3 via per-event aggregates joined back and a blocked exact rank."""
    return rounded(SQ.sequence_features_skew_safe(_particle_features(spark, sf_dir)))


@query("fixed_subset")
def q_fixed_subset(spark, sf_dir):
    """M5: reproducible fixed-size sample of 500 events (sampling is the feature)."""
    _, events = fixture(spark, sf_dir)
    return PR.fixed_subset(events.select("event_id", "label"), 500)


from collidex.plans import job_queries, model_queries  # noqa: E402,F401  (register their queries)
