"""Session and checkpoint helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "collidex",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Create (or return) a session with the settings the pipeline relies on.

    AQE stays on so shuffle partitions are coalesced and skewed join
    partitions split at run time. The web UI is off.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is. Where it
    is unset, a local master gets a fresh scratch folder; any other master is an
    error, since its executors could not see each other's files.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {sc.master})")
        d = tempfile.mkdtemp(prefix="collidex-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location for an intermediate table under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: computed once, its lineage cut."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (driver-side metadata listing only)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for st in fs.globStatus(path) or []:
            total += fs.getContentSummary(st.getPath()).getLength()
    return total


def size_shuffles(spark: SparkSession, paths: list[str], expansion: float = 4.0,
                  target_mb: int = 256, min_partitions: int = 200) -> int:
    """Size the initial shuffle partition count from the input volume.

    AQE can only coalesce shuffle partitions, never split them, so the
    initial count must cover the largest shuffle: the isolation join moves
    about ``expansion`` x the input (each probe goes to four cells). Sets the
    initial count and the advisory size that AQE coalesces towards.
    """
    n = max(min_partitions, int(input_bytes(spark, paths) * expansion / (target_mb << 20)) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{target_mb}m")
    return n
