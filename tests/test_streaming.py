"""The streaming feature job equals the batch job."""

import os

from pyspark.sql import functions as F

from collidex.operators import features as FE
from collidex.sources import events as EV
from collidex.sources.fixture import fixture_nested_events
from collidex.streaming.features_stream import start_feature_stream
from tests.conftest import SF0001


def test_stream_matches_batch(spark, scratch):
    nested = fixture_nested_events(spark, SF0001)
    src = os.path.join(scratch, "in")
    for k in range(3):   # three files arrive
        nested.where(F.col("event_id") % 3 == k).write.mode("append").parquet(src)
    out = os.path.join(scratch, "out")
    q = start_feature_stream(spark, src, out, checkpoint=os.path.join(scratch, "ckpt"), once=True,
                             max_files_per_trigger=1, own_ids=True)
    q.awaitTermination(600)
    got = spark.read.parquet(f"{out}/event_features").drop("batch")
    want = FE.event_features(EV.explode_particles(nested), EV.event_info(nested))
    assert got.count() == want.count() == 145
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_files_that_share_ids_or_have_none_stay_apart(spark, scratch):
    nested = fixture_nested_events(spark, SF0001)
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    nested.write.parquet(src)
    nested.write.mode("append").parquet(src)
    nested.drop("event_id").write.mode("append").parquet(src)
    q = start_feature_stream(spark, src, out, checkpoint=os.path.join(scratch, "ckpt"), once=True)
    q.awaitTermination(600)
    got = spark.read.parquet(f"{out}/event_features")
    assert got.count() == got.select("event_id").distinct().count() == 3 * 145
