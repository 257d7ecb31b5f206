"""Model-input preparation with MLlib: one-hot labels (M1), min-max scaling
fitted on the training split (M2), the pipeline (M3), splits (M4), class
balancing (M5), a global shuffle (W6) and vector helpers (R4-R6)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collidex.config import EVENT_FEATURES
from collidex.operators.ordered import ordered_rank

HASH_MOD = 4294967296
PRE_MOD = 2147483648
GOLDEN, MID, TOP = 2654435761, 2246822519, 668265263


def mix_key(key) -> Column:
    """Deterministic pseudo-random order key in [0, 2^32) from an integer key.

    Multiplicative (golden-ratio) hashing of all 64 bits in pieces of 31, 31 and
    2: injective on keys from 0 to 2^31 - 1, even over negative and hashed keys,
    the same on every re-run of a task, and no product reaches 2^63.
    """
    k = F.col(key) if isinstance(key, str) else key
    k = k.cast("long")
    low, mid, top = (F.pmod(F.shiftright(k, n), F.lit(m)) for n, m in ((0, PRE_MOD), (31, PRE_MOD), (62, 4)))
    return (low * GOLDEN % HASH_MOD + mid * MID % HASH_MOD + top * TOP) % HASH_MOD


def key_split(df: DataFrame, key: str, test_fraction: float = 0.2, col: str = "split") -> DataFrame:
    """M4 (reproducible form): 'test' where the mixed key falls in the lowest fraction."""
    t = F.when(mix_key(key) < int(test_fraction * HASH_MOD), "test").otherwise("train")
    return df.withColumn(col, t)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """M4: seeded random split (the original call was unseeded)."""
    return df.randomSplit(list(weights), seed)


def shuffle(df: DataFrame, seed: int = 42) -> DataFrame:
    """Global random order (a range-partitioned sort on a seeded key)."""
    return df.orderBy(F.rand(seed))


def assemble(df: DataFrame, cols=EVENT_FEATURES, out: str = "dense_features") -> DataFrame:
    """Feature columns as one dense vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def to_array(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """ML vector column -> array<double>."""
    return df.withColumn(out or col, vector_to_array(F.col(col)))


def vector_columns(df: DataFrame, col: str, n: int, prefix: str = "f") -> DataFrame:
    """Vector -> array -> one column per element."""
    arr = vector_to_array(F.col(col))
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, *[arr[i].alias(f"{prefix}{i}") for i in range(n)])


def one_hot(df: DataFrame, col: str = "label", out: str = "encoded_label") -> DataFrame:
    """M1: one-hot encoding with every class kept (dropLast=False)."""
    enc = OneHotEncoder(inputCols=[col], outputCols=[out], dropLast=False)
    return enc.fit(df).transform(df)


def prep_pipeline(train: DataFrame, features=EVENT_FEATURES, label: str = "label") -> PipelineModel:
    """M2/M3: assemble -> one-hot label -> min-max scale, fitted on ``train`` only."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="dense_features"),
        OneHotEncoder(inputCols=[label], outputCols=["encoded_label"], dropLast=False),
        MinMaxScaler(inputCol="dense_features", outputCol="features"),
    ]).fit(train)


def min_max(train: DataFrame, *others: DataFrame, features=EVENT_FEATURES) -> list[DataFrame]:
    """M2: scale features to [0, 1] with limits from ``train``; constant -> 0.5."""
    model = prep_pipeline(train, features)
    return [model.transform(d) for d in (train, *others)]


def undersample(df: DataFrame, label: str = "label", key: str = "event_id",
                n_blocks: int | None = None) -> DataFrame:
    """M5: keep, per class, the smallest class size of rows in mixed-key order.

    Exact counts; the rank comes from the blocked prefix sum, so no class
    becomes a single window partition.
    """
    m = df.groupBy(label).count().agg(F.min("count")).first()[0] or 0
    r = ordered_rank(df.withColumn("_mk", mix_key(key)), [label], "_mk", n_blocks=n_blocks, tiebreak=[key])
    return r.where(F.col("rank") <= m).drop("_mk", "rank")


def fixed_subset(df: DataFrame, n: int, key: str = "event_id", n_blocks: int | None = None) -> DataFrame:
    """M5: exactly ``n`` rows (or all, if fewer) in mixed-key order - a
    reproducible fixed-size sample. The rank is the blocked exact rank, so no
    single task orders the whole table."""
    r = ordered_rank(df.withColumn("_mk", mix_key(key)), [], "_mk", n_blocks=n_blocks, tiebreak=[key])
    return r.where(F.col("rank") <= int(n)).drop("_mk", "rank")
