"""Operator 4: benchmark decontamination by size-partitioned MinHash containment search.

Short items are searched inside long documents. Containment, not similarity, is
asked for: the share of an item's five-word shingles that the document holds.

Items fall into size partitions (powers of two of their shingle count). Each
partition fixes the length of its items' MinHash sketch, the ``m`` smallest
shingle hashes, by its upper size ``u``: m = u - ceil(t u) + 1. An item contained
to at least ``t`` misses at most u - ceil(t u) shingles, so at least one sketch
value occurs in the document: the search loses nothing, where banded signatures
would find a 30-shingle item in a 20,000-shingle document only by luck. The
partition's lower size rules out documents too short to contain its items.
Candidates are verified by counting the exact text shingles they share.

An item of fewer words has one shingle, the run of all its words, and is contained
in every document that holds this run. Documents are cut into runs of a lower length
only where an item has that many words.

All steps are DataFrame functions; documents are never shuffled for the search.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import only_ids, saved, table

#: Most sketch rows that are broadcast (16 bytes each); a larger benchmark is joined by a shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def words(text) -> F.Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _starts(w: str, k: int) -> F.Column:
    return F.expr(f"CASE WHEN size({w}) < {k} THEN array() ELSE sequence(1, size({w}) - {k - 1}) END").cast("array<int>")


def hashed_runs(w: str, k: int) -> F.Column:
    """Hashes of all runs of ``k`` words."""
    return F.transform(_starts(w, k), lambda i: F.xxhash64(*[F.get(F.col(w), i + (j - 1)) for j in range(k)]))


def text_runs(w: str, k: int) -> F.Column:
    return F.transform(_starts(w, k), lambda i: F.array_join(F.slice(F.col(w), i, k), " "))


def item_shingles(w: str, k: int) -> F.Column:
    """All runs of ``k`` words, or the one run of all words where there are fewer."""
    return F.when(F.size(w).between(1, k - 1), F.array(F.array_join(w, " "))).otherwise(text_runs(w, k))


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared, containment`` with containment >= ``threshold``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read.
    Null or empty texts have no shingles and are in no pair. An item under ``k`` words is
    one shingle, found in every document that holds all its words in a row. Rows that repeat an id add
    their shingles together. Null ids match nothing. Empty tables give an empty result.
    """
    it = items.filter("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("w"))
    it = saved(it.select("item_id", F.explode(F.array_distinct(item_shingles("w", k))).alias("shingle")).distinct(),
               "items")
    sizes = it.groupBy("item_id").agg(F.count("*").cast("int").alias("n_item"))
    hashed = it.select("item_id", F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(j)) for j in range(k)]).alias("h"))
    part = F.floor(F.log2("n_item")).cast("int")
    upper = F.least(F.pow(F.lit(2), part + 1).cast("int") - 1, F.lit(2 ** 31 - 1))
    sketch = (hashed.groupBy("item_id").agg(F.array_sort(F.collect_set("h")).alias("hs")).join(sizes, "item_id")
                    .select("item_id", F.pow(F.lit(2), part).cast("int").alias("lower_size"),
                            F.explode(F.slice("hs", 1, (upper - F.ceil(upper * threshold - 1e-9) + 1).cast("int"))).alias("h")))
    sketch = saved(sketch, "sketch")

    def near(t: DataFrame, rows: int) -> DataFrame:
        """``t``, of at most ``rows`` rows, broadcast if these are few."""
        return F.broadcast(t) if rows <= MAX_BROADCAST_ROWS else t

    n_shingles = it.count()
    lengths = sorted(r[0] for r in it.select(F.size(F.split("shingle", " "))).distinct().collect())     # k numbers at most
    if not lengths:
        lengths = [k]

    def runs(make) -> F.Column:
        return F.explode(make("w", lengths[0]) if len(lengths) == 1 else F.concat(*[make("w", n) for n in lengths]))

    base = docs.filter("doc_id IS NOT NULL").select("doc_id", words(F.col("text")).alias("w"))
    probe = base.select("doc_id", F.size("w").alias("n"), runs(hashed_runs).alias("h"))
    cand = (probe.join(near(sketch, sketch.count()), "h")
                 .filter(F.greatest(F.col("n") - (k - 1), F.lit(1)) >= F.ceil(F.col("lower_size") * threshold - 1e-9))
                 .select("doc_id", "item_id").distinct())
    cand = saved(cand, "candidates")

    held = (only_ids(docs.select("doc_id", "text"), cand.select("doc_id"), "doc_id")
            .select("doc_id", words(F.col("text")).alias("w"))
            .select("doc_id", runs(lambda w, n: F.array_distinct(text_runs(w, n))).alias("shingle")))
    shared = (held.join(near(it, n_shingles), "shingle")
                  .join(cand, ["doc_id", "item_id"], "left_semi").distinct()
                  .groupBy("doc_id", "item_id").agg(F.count("*").cast("int").alias("n_shared")))
    return (shared.join(near(sizes, n_shingles), "item_id")
                  .filter(F.col("n_shared") >= F.ceil(F.col("n_item") * threshold - 1e-9))
                  .select("doc_id", "item_id", "n_item", "n_shared",
                          (F.col("n_shared") / F.col("n_item")).alias("containment")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_words(name: str, key: str) -> str:
    return f"""
{name}_w AS (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'),
                                      lambda x: x <> '') AS w FROM {name} WHERE {key} IS NOT NULL)"""


SQL = f"""
WITH {_sql_words('documents', 'doc_id')}, {_sql_words('benchmark', 'item_id')},
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM benchmark_w WHERE len(w) > 0),
documents_s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS shingle
                FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM documents_w JOIN lengths ON len(w) >= k)),
benchmark_s AS (SELECT DISTINCT item_id, array_to_string(w[i:i + k - 1], ' ') AS shingle
                FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                      FROM (SELECT *, least(len(w), 5) AS k FROM benchmark_w WHERE len(w) > 0))),
q AS (SELECT item_id, count(*)::INT AS n_item FROM benchmark_s GROUP BY 1)
SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*)::INT AS n_shared, count(*) / any_value(n_item) AS containment
FROM documents_s JOIN benchmark_s USING (shingle) JOIN q USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(any_value(n_item) * 0.8 - 1e-9)
"""
