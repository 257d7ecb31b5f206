"""Corpus pipeline: quality classifier, exact dedup, near-duplicate join, decontamination, packing.

Each stage works on all rows its predecessor kept, written as Parquet and read again
in between. All but the last return the columns of ``documents``, whatever they are.

A stage numbers the rows of its input and removes rows by that number. Rows that repeat
an id are thus judged one by one, also where their texts differ, and rows without an id
are judged like all others. Null and empty texts are equal to each other (one of them
stays) and are near nothing. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm import decontamination, exact_dedup, jaccard_join, packing, quality
from collidex.llm.common import only_ids, saved, table, without_ids

#: Low-quality documents go when the classifier gives label 1 less than this probability.
KEEP_SCORE = 0.5


class Rows:
    """The input of a stage with row numbers (fixed by the files it is read from)."""

    def __init__(self, docs: DataFrame):
        self.name = "_row"
        while self.name in docs.columns:
            self.name += "_"
        self.docs = docs.withColumn(self.name, F.monotonically_increasing_id())

    def texts(self) -> DataFrame:
        """``doc_id, text``, the number in place of the id."""
        return self.docs.select(F.col(self.name).alias("doc_id"), "text")

    def order(self) -> F.Column:
        """What decides which row of a group stays: the smallest id (null last), then the row number."""
        return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(self.name).alias("row"))

    def without(self, numbers: DataFrame) -> DataFrame:
        """The rows whose number is not in the first column of ``numbers``."""
        return without_ids(self.docs, numbers.toDF(self.name), self.name).drop(self.name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on all labels, does not reject."""
    rows = Rows(docs)
    scores = quality.quality_scores(rows.texts(), table(spark, sf_dir, "labels"), threshold=KEEP_SCORE, train_docs=docs)
    return rows.without(scores.filter("predicted = 0").select("doc_id"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the smallest doc_id, the first row where it repeats."""
    rows = Rows(docs)
    flags = exact_dedup.exact_dedup(rows.docs.select(rows.order().alias("key"), "text"), id_col="key")
    return rows.without(flags.filter("NOT kept").select("doc_id.row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that of the smallest doc_id."""
    rows = Rows(docs)
    groups = saved(jaccard_join.jaccard_join(rows.texts()).select("doc_id", "component_id"), "groups")
    members = only_ids(groups, groups.filter("doc_id <> component_id").select("component_id"), "component_id")
    keys = rows.docs.select(rows.order().alias("key"))
    first = members.join(keys, F.col("doc_id") == F.col("key.row")).groupBy("component_id").agg(F.min("key").alias("key"))
    return rows.without(without_ids(members.select("doc_id"), first.select(F.col("key.row").alias("doc_id")), "doc_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (0.8 of its five-word shingles)."""
    rows = Rows(docs)
    leaks = decontamination.contained_items(rows.texts(), table(spark, sf_dir, "benchmark"))
    return rows.without(leaks.select("doc_id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the remaining documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("quality classifier", keep_quality), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("benchmark decontamination", drop_leaks), ("best-fit packing", pack)]

#: A trained model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
