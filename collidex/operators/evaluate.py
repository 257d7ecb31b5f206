"""Distributed evaluation: class counts (A2, A4), split counts (A3), worker
iterations (A5), loss curves (A6, A7), confusion matrix (A8), accuracy (A9),
one-vs-rest ROC (W7), AUC (W8) and model comparison (M13).

Nothing is collected to the driver: every metric is an aggregation, and
cumulative sums use the prefix scan of ``ordered.py``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collidex.operators.ordered import ordered_cumsum, ordered_rank


def argmax(arr) -> Column:
    """0-based index of the first maximum of an array column."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def label_counts(df: DataFrame, col: str = "label") -> DataFrame:
    """A2/A4: rows per class, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def class_counts(pred: DataFrame, col: str = "y_true") -> DataFrame:
    """A4: counts of a class column (e.g. after argmax), most frequent first."""
    return label_counts(pred, col)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A3: rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("count"))


def history_from_events(events: DataFrame, n_workers: int = 5) -> DataFrame:
    """Loss history (trainer, worker_id, iteration, loss) from an event log:
    trainer = event_type, worker = user_id % n_workers, iteration = 1-based
    position by event_id within (trainer, worker), loss = value."""
    h = events.select(F.col("event_type").alias("trainer"),
                      (F.col("user_id") % n_workers).cast("int").alias("worker_id"),
                      "event_id", F.col("value").alias("loss"))
    return (ordered_rank(h, ["trainer", "worker_id"], "event_id", out="iteration")
            .select("trainer", "worker_id", "iteration", "loss"))


def worker_iterations(history: DataFrame) -> DataFrame:
    """A5: iterations per (trainer, worker)."""
    return history.groupBy("trainer", "worker_id").agg(
        F.count(F.lit(1)).alias("iterations"))


def loss_curve(history: DataFrame, bucket: int = 100) -> DataFrame:
    """Per list position i, mean and population std of the loss across the
    workers that reached i; then averaged over buckets {0}, {1..B}, {B+1..2B}, ...
    labelled by their closing position (the last bucket closes at the last i)."""
    per_i = (history.withColumn("i", F.col("iteration") - 1)
             .groupBy("trainer", "i")
             .agg(F.avg("loss").alias("m"), F.stddev_pop("loss").alias("s")))
    b = F.ceil(F.col("i") / F.lit(float(bucket)))
    return (per_i.groupBy("trainer", b.alias("bucket"))
            .agg(F.max("i").alias("iteration"), F.avg("m").alias("loss"), F.avg("s").alias("error"))
            .select("trainer", F.col("iteration").cast("long"), "loss", "error"))


def loss_smooth(series: DataFrame, batch: int, group_cols=("trainer",)) -> DataFrame:
    """Running loss sum flushed at it % batch == 0 (it > 0), divided by
    batch; the first bucket holds it = 0..batch; an incomplete tail is dropped.
    ``series`` has ``it`` (0-based position) and ``loss``."""
    g = F.greatest(F.ceil(F.col("it") / F.lit(float(batch))), F.lit(1))
    agg = (series.groupBy(*group_cols, g.alias("_g"))
           .agg(F.max("it").alias("iteration"), F.sum("loss").alias("_s")))
    return (agg.where(F.col("iteration") == F.col("_g") * batch)
            .select(*group_cols, F.col("iteration").cast("long"),
                    (F.col("_s") / F.lit(float(batch))).alias("avg_loss")))


def confusion_matrix(pred: DataFrame, labels: list[int], y_true: str = "y_true",
                     y_pred: str = "y_pred") -> DataFrame:
    """Counts with rows = true label and one column per predicted label, zero-filled.

    No row is lost: predictions outside ``labels`` (null too) count in ``pred_other``, and
    true labels outside ``labels`` (null too) in the row whose label is null.
    """
    lab = [int(x) for x in labels]
    t, p = F.col(y_true).cast("int"), F.col(y_pred)
    counts = pred.select(F.when(t.isin(lab), t).alias(y_true), p.alias("_p")).groupBy(y_true).agg(
        *[F.count_if(F.col("_p") == x).alias(f"pred_{x}") for x in lab],
        F.count_if(F.coalesce(~F.col("_p").isin(lab), F.lit(True))).alias("pred_other"))
    all_rows = pred.sparkSession.createDataFrame([(x,) for x in [*lab, None]], f"{y_true} int")
    return all_rows.alias("a").join(F.broadcast(counts.alias("c")), F.col(f"a.{y_true}").eqNullSafe(F.col(f"c.{y_true}")), "left").select(
        f"a.{y_true}", *[F.coalesce(f"c.{c}", F.lit(0)).cast("long").alias(c) for c in counts.columns[1:]])


def accuracy(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Share of rows with y_true == y_pred."""
    return pred.agg(F.avg((F.col(y_true) == F.col(y_pred)).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).alias("n"))


def one_vs_rest(pred: DataFrame, scores: str, truth: str, classes: list[int],
                model_col: str | None = None) -> DataFrame:
    """Long form (model?, class, score, is_pos) from per-class score arrays and a label."""
    rows = F.explode(F.array(*[F.struct(F.lit(int(c)).alias("class"),
                                        F.col(scores)[i].cast("double").alias("score"),
                                        (F.col(truth) == c).cast("long").alias("is_pos"))
                               for i, c in enumerate(classes)]))
    cols = [model_col] if model_col else []
    return pred.select(*cols, rows.alias("r")).select(*cols, "r.*")


def roc_points(long: DataFrame, group_cols=("class",)) -> DataFrame:
    """Distinct thresholds with positives/negatives at each (partial aggregation)."""
    return long.groupBy(*group_cols, "score").agg(
        F.sum("is_pos").alias("pos"), F.sum(F.lit(1) - F.col("is_pos")).alias("neg"))


def sketch_size(bins: int) -> int:
    """Size of a quantile sketch whose rank error is at most a quarter of a bin (2.296 / size^0.9021 at 99 % confidence)."""
    return min(65535, max(8, math.ceil((2.296 * 4 * bins) ** (1 / 0.9021))))


def roc_curve_binned(long: DataFrame, group_cols=("class",), bins: int = 100) -> DataFrame:
    """W7 of bounded size: ``group, threshold, tpr, fpr, P, N``, at most ``2 * bins + 2`` points a group.

    One aggregation keeps two mergeable quantile sketches a group, of the scores of the
    positives and of the negatives; no row is ordered. Thresholds are the scores at each
    1/bins of either, and a point gives the shares of rows scored above its threshold, read
    from a grid of quantiles four times as fine. With the sketch's error (1/(4 bins) at 99 %
    confidence) each share is within 1/bins of the exact one, and so is the curve between
    two points, ties of one score apart. Null and NaN scores count in P and N as below all
    thresholds.
    """
    g, k, fine = list(group_cols), F.lit(sketch_size(bins)), 4 * bins
    score = F.when(~F.isnan("score"), F.col("score").cast("double"))
    sides = (("pos", 1, "P"), ("neg", 0, "N"))
    s = long.groupBy(*g).agg(
        *[F.kll_sketch_agg_double(F.when(F.col("is_pos") == v, score), k).alias(c) for c, v, _ in sides],
        *[F.count(F.when(F.col("is_pos") == v, score)).alias(f"{c}_scored") for c, v, _ in sides],
        *[F.count(F.when(F.col("is_pos") == v, 1)).alias(total) for _, v, total in sides])
    ranks = F.array(*[F.lit(i / fine) for i in range(fine + 1)])
    s = s.select(*g, "P", "N", "pos_scored", "neg_scored", *[
        F.when(F.col(f"{c}_scored") > 0, F.kll_sketch_get_quantile_double(c, ranks)).otherwise(F.array().cast("array<double>")).alias(c) for c, *_ in sides])

    def above(c: str, total: str) -> Column:
        held = F.size(F.filter(c, lambda q: q <= F.col("threshold")))
        rank = F.when(held > fine, 1.0).when(held == 0, 0.0).otherwise((held - 0.5) / fine)
        return F.when(F.col(total) > 0, (1 - rank) * F.col(f"{c}_scored") / F.col(total))

    cuts = F.concat(*[F.filter(c, lambda _, i: i % 4 == 0) for c, *_ in sides])
    points = s.select("*", F.explode(F.array_distinct(cuts)).alias("threshold"))
    return points.select(*g, "threshold", above("pos", "P").alias("tpr"), above("neg", "N").alias("fpr"), "P", "N")


def roc_curve(long: DataFrame, group_cols=("class",), n_blocks: int | None = None, bins: int | None = None) -> DataFrame:
    """Cumulative tp/fp at each distinct score, descending; the (0, 0) point
    is prepended with threshold +inf. Every distinct threshold is kept, unless
    ``bins`` asks for the bounded curve of :func:`roc_curve_binned`."""
    if bins:
        return roc_curve_binned(long, group_cols, bins)
    g = list(group_cols)
    pts = roc_points(long, g)
    cum = ordered_cumsum(pts, g, "score", ["pos", "neg"], descending=True, n_blocks=n_blocks)
    tot = pts.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    c = cum.join(tot, g)
    first = tot.select(*g, F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"),
                       F.lit(0).cast("long").alias("fp"), "P", "N")
    curve = c.select(*g, F.col("score").alias("threshold"), F.col("cum_pos").cast("long").alias("tp"),
                     F.col("cum_neg").cast("long").alias("fp"), "P", "N").unionByName(first)
    return curve.select(
        *g, "threshold", "tp", "fp",
        F.when(F.col("P") > 0, F.col("tp") / F.col("P")).alias("tpr"),
        F.when(F.col("N") > 0, F.col("fp") / F.col("N")).alias("fpr"))


def auc(long: DataFrame, group_cols=("class",), n_blocks: int | None = None) -> DataFrame:
    """Trapezoidal area under the ROC curve, exact and tie-safe.

    Each distinct score adds neg * (tp_before + pos/2) / (P*N), which is the
    trapezoid between consecutive curve points; no lag window is needed.
    """
    g = list(group_cols)
    pts = roc_points(long, g)
    cum = ordered_cumsum(pts, g, "score", ["pos"], descending=True, n_blocks=n_blocks,
                         inclusive=False)
    area = cum.groupBy(*g).agg(
        F.sum(F.col("neg") * (F.col("cum_pos") + F.col("pos") / F.lit(2.0))).alias("_a"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return area.select(*g, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                  F.col("_a") / (F.col("P").cast("double") * F.col("N"))).alias("auc"))


def compare_models(long: DataFrame, model_col: str = "model") -> DataFrame:
    """AUC per (model, class) and the best model per class."""
    a = auc(long, (model_col, "class"))
    w = Window.partitionBy("class").orderBy(F.desc("auc"), model_col)
    return a.withColumn("is_best", F.row_number().over(w) == 1)
