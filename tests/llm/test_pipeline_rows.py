"""Pipeline stages on rows that repeat ids, on nulls and on empty tables."""

import pytest

import corpus_pipeline as P

LONG = "the quick brown fox jumps over the lazy dog while seventeen small birds sing in the old garden behind our house every morning"
NEAR = " ".join(LONG.split()[:-1] + ["evening"])
OTHER = "a wholly different and clean text about rivers that run from the high mountains through green valleys down to the distant sea"
ITEM = "which of these rivers is the longest one in the whole world and through how many countries does it run"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, f"r{k}") for k, (i, t) in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def kept(stage, spark, texts, tables):
    out = stage(spark, docs_of(spark, texts), tables)
    assert out.columns == docs_of(spark, []).columns
    return sorted(r["_row"] for r in out.collect())


def test_exact_copies_of_repeated_ids(spark, tables):
    texts = [(1, LONG), (1, LONG), (3, LONG), (3, OTHER), (None, OTHER), (None, None), (7, ""), (7, None)]
    assert kept(P.drop_copies, spark, texts, tables) == ["r0", "r3", "r6"]


def test_near_copies_of_repeated_ids(spark, tables):
    texts = [(5, LONG), (2, NEAR), (2, OTHER), (5, ITEM), (None, LONG), (8, None), (8, ""), (8, "short")]
    assert kept(P.drop_near_copies, spark, texts, tables) == ["r1", "r2", "r3", "r5", "r6", "r7"]


def test_leaks_of_repeated_and_null_ids(spark, tables):
    texts = [(1, f"{OTHER} {ITEM} {LONG}"), (1, OTHER), (None, ITEM), (None, LONG), (4, None), (4, "")]
    assert kept(P.drop_leaks, spark, texts, tables) == ["r1", "r3", "r4", "r5"]


def test_quality_judges_rows_of_one_id_apart(spark, tables):
    good, bad = "a calm and well written sentence about the weather of today and its causes", "BUY!!! $$$ 111 CLICK >>> @@@ ### 999"
    texts = [(i, good if i % 2 else bad) for i in range(20)] + [(3, bad), (2, good), (None, good), (None, bad), (40, None)]
    got = kept(P.keep_quality, spark, texts, tables)
    assert {f"r{i}" for i in range(1, 20, 2)} | {"r21", "r22"} <= set(got)
    assert not {f"r{i}" for i in range(0, 20, 2)} & set(got) and "r20" not in got and "r23" not in got


def test_empty_table(spark, tables):
    for _, stage in P.STAGES[:-1]:
        assert kept(stage, spark, [], tables) == []
    assert P.pack(spark, docs_of(spark, []), tables).count() == 0
