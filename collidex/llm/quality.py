"""Operator 5: quality classifier, a factorisation machine.

A document's features are hashed words, bins of structure statistics (shares of
letters, digits, signs and repeated lines, word lengths and the like) and bins of
its size. The machine adds a linear part and all pairwise interactions, with each
feature's interaction weights a short vector; the sum over pairs is computed in
linear time as half of (square of sums - sum of squares) per factor.

Training uses a bounded sample of labelled rows and runs in one task; scoring is one
pass over whole texts. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import table

WORD_BUCKETS, BINS, FACTORS = 1 << 14, 12, 6
#: Most labelled rows that training uses.
MAX_TRAIN_ROWS = 6_000
_KIND = np.zeros(256, np.intp)          # 0 other sign, 1 upper, 2 lower, 3 digit, 4 space, 5 line end, 6 common sign, 7 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 3
_KIND[[9, 11, 12, 13, 32]], _KIND[10], _KIND[128:] = 4, 5, 7
_KIND[[ord(c) for c in ".,;:'\"()?-"]] = 6


def statistics(text: str, words: list[str], distinct: Counter) -> list[float]:
    """Structure statistics and size of a whole text; zeros and ones for an empty one."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    other, upper, lower, digit, _, _, common, high = np.bincount(_KIND[raw], minlength=8) / max(1, len(raw))
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    top = max(distinct.values(), default=0)
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    signs = sum(c for w, c in distinct.items() if not (w[-1].isalnum() or w[-1] in ".,;:!?)\"'"))
    return [other, upper, digit, common, high, np.log1p(len(words)), np.log1p(len(raw)), len(text) / n, len(distinct) / n, top / n, pairs,
            np.log1p(len(lines)), len(words) / len(lines), 1 - len(set(lines)) / len(lines), signs / n,
            sum(c for w, c in distinct.items() if w.isupper() and len(w) > 1) / n, sum(c for w, c in distinct.items() if len(w) > 18) / n]


def features(text: str | None, cache: dict[str, int]) -> tuple[np.ndarray, list[float]]:
    """Buckets of the distinct words, and the statistics."""
    text = text if isinstance(text, str) else ""
    words = text.split()
    distinct = Counter(words)
    if len(cache) > 500_000:
        cache.clear()
    buckets = []
    for w in distinct:
        b = cache.get(w)
        if b is None:
            b = cache[w] = zlib.crc32(w.lower().encode("utf-8", "replace")) % WORD_BUCKETS
        buckets.append(b)
    return np.array(buckets, np.int64), statistics(text, words, distinct)


class Machine:
    def __init__(self, edges: np.ndarray, seed: int = 7):
        self.edges = edges                                            # bin borders, one row per statistic
        size = WORD_BUCKETS + edges.shape[0] * BINS
        self.w0, self.w = 0.0, np.zeros(size)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (size, FACTORS))

    def vector(self, buckets: np.ndarray, stats: list[float]) -> tuple[np.ndarray, np.ndarray]:
        bins = (self.edges <= np.array(stats)[:, None]).sum(1)
        at = np.concatenate([buckets, WORD_BUCKETS + np.arange(len(stats)) * BINS + bins])
        return at, np.concatenate([np.full(len(buckets), 1 / np.sqrt(max(1, len(buckets)))), np.ones(len(stats)) / np.sqrt(len(stats))])

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        vx = self.v[at] * x[:, None]
        s = vx.sum(0)
        return self.w0 + self.w[at] @ x + 0.5 * float(s @ s - (vx * vx).sum()), s

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 8, rate: float = 0.1, decay: float = 1e-4):
        gw, gv, g0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        rng = np.random.default_rng(11)
        for _ in range(epochs):
            for i in rng.permutation(len(y)):
                at, x = rows[i]
                z, s = self.raw(at, x)
                g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]
                dw = g * x + decay * self.w[at]
                dv = g * (x[:, None] * s - self.v[at] * (x * x)[:, None]) + decay * self.v[at]
                g0 += g * g
                self.w0 -= rate * g / np.sqrt(g0)
                np.add.at(gw, at, dw * dw)
                np.add.at(self.w, at, -rate * dw / np.sqrt(gw[at]))
                np.add.at(gv, at, dv * dv)
                np.add.at(self.v, at, -rate * dv / np.sqrt(gv[at]))

    def score(self, text: str | None, cache: dict[str, int]) -> float:
        z, _ = self.raw(*self.vector(*features(text, cache)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _train(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["h", "doc_id"])
    cache: dict[str, int] = {}
    found = [features(t, cache) for t in pdf["text"]]
    stats = np.array([s for _, s in found])
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    m = Machine(edges)
    m.fit([m.vector(*f) for f in found], pdf["y"].to_numpy(float))
    return pd.DataFrame({"model": [zlib.compress(pickle.dumps((m.edges, m.w0, m.w.astype(np.float32), m.v.astype(np.float32))), 1)]})


def sample_of(docs: DataFrame, labels: DataFrame, label: str, learn, limit: int) -> DataFrame:
    """At most about ``limit`` labelled rows that ``learn`` allows: ``doc_id, text, y, h``, chosen by a hash of the id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).filter(learn(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    share = min(1.0, limit / max(1, known.count()))
    h = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30))
    known = known.withColumn("h", h).filter(F.col("h") < int(share * (1 << 30)))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "y", "h")


def train(sample: DataFrame) -> Machine | None:
    """The machine fitted on the sample, in one task (``sample`` is bounded); None without both labels."""
    if sample.select("y").distinct().count() < 2:
        return None
    row = sample.groupBy(F.lit(1).alias("one")).applyInPandas(_train, "model binary").first()
    edges, w0, w, v = pickle.loads(zlib.decompress(bytes(row["model"])))
    m = Machine(edges)
    m.w0, m.w, m.v = w0, w.astype(float), v.astype(float)
    return m


def learnable(modulus: int, left_out: int):
    """Rows for learning: those whose crc32 of the id as text, modulo ``modulus``, is not ``left_out``."""
    return lambda doc_id: F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) != left_out


def quality_scores(docs: DataFrame, labels: DataFrame, learn=None, threshold: float = 0.7,
                   max_train_rows: int = MAX_TRAIN_ROWS, train_docs: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score, predicted``.

    It learns from the rows of ``train_docs`` (``docs`` if not given) that have a label.

    ``score`` is the probability of label 1. Null and empty texts are scored by their
    statistics; null ids and repeated rows each get a row; other columns are not read;
    an empty table gives an empty result. Without labels of both kinds every score is the
    share of label 1 (1 without any label). Labels given twice count as their larger one.
    """
    sample = sample_of(docs if train_docs is None else train_docs, labels, "quality", learn or (lambda _: F.lit(True)), max_train_rows)
    model = train(sample)
    if model is None:
        share = sample.agg(F.avg("y")).first()[0]
        scored = docs.select("doc_id", F.lit(1.0 if share is None else float(share)).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        cache: dict[str, int] = {}

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series([shared.value.score(t, cache) for t in texts], dtype=float)

        scored = docs.select("doc_id", score(F.col("text").cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = learnable(4, 2)
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn)
    return out.select("doc_id", F.coalesce(~learn(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
