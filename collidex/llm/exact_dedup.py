"""Operator 2: exact deduplication behind a two-pass Bloom filter, in DataFrame functions only.

Pass one puts every text's hash into a blocked Bloom filter that remembers the
bits set by two or more rows. Pass two tests each row: only rows all of whose
bits were set more than once can have a copy. These rows alone are grouped by
their SHA-256; all others go straight to the result.

A filter has a fixed largest size. More rows than it serves are written in ranges of
their hash, each with a filter of its own, one after the other: neither the filter nor
its load grows with the table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import Parts, saved, table

#: One block is one bitmap of Spark's bitmap functions.
BLOCK_BITS = 32768
#: Groups are heavy, and broadcast, from this size on, or from a 100,000th of all rows: at most 100,000 are.
HEAVY_GROUP = 1000
MAX_HEAVY = 100_000


def normalised(text) -> F.Column:
    """Null becomes empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _bit_set(bitmap: str, bit: str) -> F.Column:
    byte = f"cast(conv(hex(substring({bitmap}, cast({bit} div 8 + 1 as int), 1)), 16, 10) as int)"
    return F.expr(f"(shiftright({byte}, cast({bit} % 8 as int)) & 1) = 1")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits_per_row: int = 12, max_bits: int = 1 << 28) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if identical after white-space runs become one space; of equal
    texts the smallest id stays. A null text counts as empty. Null ids are larger
    than all others; rows that repeat an id and its text are one document and are
    kept or dropped together, each counting in ``group_size``. Other columns are
    not read, so their names cannot clash. An empty table gives an empty result.

    ``max_bits`` bounds one filter, and with it a broadcast, to 32 MB at any size; a
    table of more rows takes several filters, each for a range of hashes. Every task then
    writes a file a range: at 10^9 rows 45 a task; raise it for far larger tables.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))
    rows = saved(rows, "sha")
    n = rows.count()
    blocks = max(1, math.ceil(n * bits_per_row / BLOCK_BITS))
    ranges = math.ceil(blocks * BLOCK_BITS / max_bits)
    blocks = math.ceil(blocks / ranges)
    tested = Parts(docs.sparkSession, "maybe")
    for part in _ranges(rows, ranges):
        tested.add(_maybe(part, blocks))

    maybe = tested.all().filter("maybe").drop("maybe")
    groups = saved(maybe.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    heavy = F.col("group_size") >= max(HEAVY_GROUP, n // MAX_HEAVY)
    # The few heavy groups meet their rows by a broadcast, so that no task gets a whole one.
    large = F.broadcast(groups.filter(heavy))
    repeated = (maybe.join(large, "text_sha256")
                     .unionByName(maybe.join(large, "text_sha256", "left_anti").join(groups.filter(~heavy), "text_sha256")))
    repeated = repeated.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    single = tested.all().filter("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return single.unionByName(repeated)


def _ranges(rows: DataFrame, ranges: int) -> list[DataFrame]:
    """Rows of each range of hashes; several are written apart, without a shuffle, so that each is read alone."""
    if ranges == 1:
        return [rows]
    part = F.floor(F.conv(F.substring("text_sha256", 1, 8), 16, 10).cast("long") * ranges / 2 ** 32).cast("int")
    rows = saved(rows.withColumn("part", part), "sha-ranges", "part")
    return [rows.filter(F.col("part") == i).drop("part") for i in range(ranges)]


def _maybe(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with a column ``maybe``: whether the filter holds the text twice."""
    h2 = F.xxhash64("text_sha256", F.lit(1))
    rows = (rows.withColumn("block", F.pmod(F.xxhash64("text_sha256"), F.lit(blocks)).cast("int"))
                .withColumn("b1", F.pmod(h2, F.lit(BLOCK_BITS)).cast("int"))
                .withColumn("b2", F.pmod(F.shiftright(h2, 24), F.lit(BLOCK_BITS)).cast("int")))
    bits = rows.select("block", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("bit"))
    bloom = (bits.groupBy("block", "bit").agg(F.count("*").alias("c")).filter("c > 1")
                 .groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap")))
    bloom = saved(bloom, "bloom")
    return rows.join(F.broadcast(bloom), "block", "left").select(
        "doc_id", "text_sha256",
        F.coalesce(_bit_set("bitmap", "b1") & _bit_set("bitmap", "b2"), F.lit(False)).alias("maybe"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
