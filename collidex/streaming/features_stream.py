"""Structured Streaming form of the events -> features job.

Event files arriving in a folder are processed micro-batch by micro-batch.
Features of one event depend only on that event's particles, so running the
batch operators on each micro-batch (``foreachBatch``) gives exactly the
batch result; the sink appends, and the checkpoint makes the stream
restartable after a failure (each batch is written under its batch id, so a
replayed batch overwrites its own output instead of duplicating it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from collidex import schemas
from collidex.config import DEFAULT_CUTS, Cuts
from collidex.operators import features as FE
from collidex.operators.selection import event_particles, preselect_nested
from collidex.session import scratch_path
from collidex.sources import events as EV


def feature_batch(batch: DataFrame, batch_id: int, out: str, cuts: Cuts) -> None:
    kept = preselect_nested(batch, cuts)
    parts, info = EV.explode_particles(kept), EV.event_info(kept)
    ep = event_particles(parts, info, cuts).persist()
    try:
        FE.event_features(parts, info, cuts, ep=ep).write.mode("overwrite").parquet(
            f"{out}/event_features/batch={batch_id}")
        FE.particle_features(parts, info, cuts, ep=ep).write.mode("overwrite").parquet(
            f"{out}/particle_features/batch={batch_id}")
    finally:
        ep.unpersist()


def start_feature_stream(spark: SparkSession, input_dir: str, out: str, cuts: Cuts = DEFAULT_CUTS,
                         checkpoint: str | None = None, once: bool = False,
                         max_files_per_trigger: int = 64, own_ids: bool = False) -> StreamingQuery:
    """Watch ``input_dir`` for nested event Parquet files and append features to ``out``.

    Event keys follow the batch job's rule (``sources.events.with_event_id``).
    """
    src = (spark.readStream.schema(schemas.EVENT).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(input_dir))
    src = EV.with_event_id(src, own_ids=own_ids)
    w = (src.writeStream.foreachBatch(lambda df, bid: feature_batch(df, bid, out, cuts))
         .option("checkpointLocation", checkpoint or scratch_path(spark, "feature-stream")))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
