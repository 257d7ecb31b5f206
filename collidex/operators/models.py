"""Models on MLlib: random forest (M6), feed-forward network (M7, also the
single "train on Spark" call that stands in for the five distributed
trainers, M8), scoring (M9) and persistence (M10). Mini-batch networks and
the searches (M11, M12) are in ``networks.py``."""

from __future__ import annotations

from pyspark.ml.classification import (MultilayerPerceptronClassificationModel,
                                       MultilayerPerceptronClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LAYERS = (14, 50, 20, 10, 3)


def train_forest(df: DataFrame, trees: int = 50, depth: int = 10, seed: int = 42,
                 features: str = "features", label: str = "label"):
    """M6: random forest, 50 trees of depth 10 by default."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees,
                                  maxDepth=depth, seed=seed).fit(df)


def network(layers=DEFAULT_LAYERS, max_iter: int = 50, block_size: int = 128, seed: int = 42,
            features: str = "features", label: str = "label") -> MultilayerPerceptronClassifier:
    """M7 estimator: sigmoid hidden layers, softmax output, L-BFGS."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=list(layers),
                                          maxIter=max_iter, blockSize=block_size, seed=seed)


def train_network(df: DataFrame, layers=DEFAULT_LAYERS, max_iter: int = 50,
                  block_size: int = 128, seed: int = 42, **kw):
    """M7/M8: fit the network; gradients are computed per partition and
    tree-aggregated, which replaces the parameter-server trainers."""
    return network(layers, max_iter, block_size, seed, **kw).fit(df)


def score(model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M9 + R5: predictions with class probabilities as array<double>."""
    out = model.transform(df)
    cols = keep if keep is not None else [c for c in df.columns if c != model.getFeaturesCol()]
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("probability"))


def save_model(model, path: str) -> None:
    """M10."""
    model.write().overwrite().save(path)


def load_model(path: str, kind: str = "network"):
    """``kind`` is 'network' or 'forest'."""
    cls = {"network": MultilayerPerceptronClassificationModel,
           "forest": RandomForestClassificationModel}[kind]
    return cls.load(path)
