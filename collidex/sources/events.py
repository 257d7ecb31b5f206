"""Nested event scans (S1, S2), class tagging and union (P1-P3), flattening
to the particle relation (P8), and the table sinks/scans (S3-S9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex import schemas


def read_events(spark: SparkSession, path: str | list[str], schema=schemas.EVENT) -> DataFrame:
    """Scan nested events (path may be a glob) with the minimal schema.

    An explicit read schema holding only the used nested fields prunes the
    rest at the Parquet reader, independent of optimizer rules.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).parquet(*paths)


def with_event_id(df: DataFrame, sample: int = 0, own_ids: bool = True) -> DataFrame:
    """Give rows from Parquet files a stable key: hash of sample, file path and row index.

    ``own_ids`` keeps a file's own ``event_id`` where it has one, for inputs whose ids
    are unique over all files of all samples; otherwise own ids are not used.

    The key is recomputed identically when a lost task is re-run, unlike a
    generated sequence.
    """
    gen = F.xxhash64(F.lit(int(sample)), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    if own_ids and "event_id" in df.columns:   # a read schema may carry the column with no values
        return df.withColumn("event_id", F.coalesce(F.col("event_id"), gen))
    return df.withColumn("event_id", gen)


def select_required(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Keep the required columns; ``names`` renames them positionally."""
    cols = [c for c in ["event_id"] + schemas.REQUIRED_COLUMNS if c in df.columns]
    out = df.select(*cols)
    return out.toDF(*names) if names else out


def tag(df: DataFrame, label: int) -> DataFrame:
    """Stamp a sample with its class literal (replaces an existing label)."""
    return df.withColumn("label", F.lit(int(label)).cast("int"))


def union_samples(dfs: list[DataFrame]) -> DataFrame:
    """Bag union of tagged samples, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def explode_particles(events: DataFrame, species: tuple[str, ...] = tuple(schemas.SPECIES_SOURCE)) -> DataFrame:
    """Nested events -> flat particle relation keyed by (event_id, species, pos).

    ``pos`` is the array index, so array order (which is semantic) is kept. One
    generator runs over the concatenated arrays of all ``species``, cast to one element
    type, so events are scanned and parsed once; arrays of other species are not read.
    A null array counts as empty. No shuffle.
    """
    names = [f for f in schemas.PARTICLE.fieldNames() if f not in ("event_id", "species", "pos")]
    fields = {"eta": "Eta", "phi": "Phi", "x": "X", "y": "Y", "z": "Z", "pid": "PID", "charge": "Charge", "btag": "BTag"}

    def array(sp: str) -> Column:
        col, mom = schemas.SPECIES_SOURCE[sp]
        there = {f.name for f in events.schema[col].dataType.elementType.fields}
        source = {n: mom if n == "pt" else fields[n] for n in names}
        return F.transform(F.coalesce(col, F.array().cast(events.schema[col].dataType)), lambda p, pos: F.struct(
            F.lit(sp).alias("species"), pos.alias("pos"),
            *[(p[source[n]] if source[n] in there else F.lit(None)).cast(schemas.PARTICLE[n].dataType).alias(n) for n in names]))

    return events.select("event_id", F.explode(F.concat(*map(array, species))).alias("p")).select("event_id", "p.*")


def event_info(events: DataFrame) -> DataFrame:
    """Event relation: label, lepton counters and the first MissingET element.

    ``F.get`` yields NULL for an empty array (``element_at`` raises under ANSI).
    """
    met = F.get(F.col("MissingET"), 0)
    return events.select(
        "event_id", F.col("label").cast("int"),
        F.col("Electron_size").cast("int").alias("electron_size"),
        F.col("MuonTight_size").cast("int").alias("muon_size"),
        met["MET"].alias("met"), met["Phi"].alias("met_phi"))


def sample_stats(df: DataFrame, label_col: str = "label", labels=(0, 1, 2)) -> DataFrame:
    """One row of per-class counts in a single pass (order qcd, ttbar, wjets)."""
    names = {0: "qcd", 1: "ttbar", 2: "wjets"}
    return (df.groupBy().pivot(label_col, list(labels)).count()
            .select(*[F.coalesce(F.col(str(k)), F.lit(0)).cast("long").alias(names.get(k, f"class_{k}"))
                      for k in labels]))


def write_sample_stats(df: DataFrame, path: str) -> None:
    """S5 sink: the class counts as one CSV line."""
    sample_stats(df).coalesce(1).write.mode("overwrite").csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S3/S6/S7 sink: overwrite a Parquet table, optionally partitioned (e.g. by label)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


write_features = write_table
write_images = write_table
write_sequences = write_table


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "event_id") -> None:
    """S3/S7 sink that keeps its layout: a table in ``buckets`` files hashed and sorted by ``key``.

    Tables of equal ``buckets`` join and group on the key without an exchange. Rows are
    hashed as the buckets are before they are written, so there is one file a bucket.
    """
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))


def read_bucketed(spark: SparkSession, name: str, cols: list[str] | None = None) -> DataFrame:
    """The table of :func:`write_bucketed`, with column projection; its bucketing is known to the planner."""
    return spark.table(name).select(*cols) if cols else spark.table(name)


def read_table(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """Scan a written table with column projection."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def read_features(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    return read_table(spark, path, cols)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Prepared train/test table (HLF_input, label, encoded_label)."""
    return read_table(spark, path, ["HLF_input", "label", "encoded_label"])


def read_scaling_log(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header (nodes, elapsed_time)."""
    return spark.read.csv(path, header=True, schema=schemas.SCALING_LOG)


def scaling_curve(log: DataFrame) -> DataFrame:
    """Elapsed time by node count plus speed-up relative to the fewest nodes."""
    first = log.agg(F.min_by("elapsed_time", "nodes").alias("_t0"))                # one row
    return (log.join(F.broadcast(first)).select("nodes", "elapsed_time", (F.col("_t0") / F.col("elapsed_time")).alias("speedup"))
            .orderBy("nodes"))


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """Bounded, deterministic preview (limit is the feature here)."""
    return df.orderBy(*order_by).limit(n)
