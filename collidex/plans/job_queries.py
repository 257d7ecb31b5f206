"""Registered queries of the batch jobs and their sinks: event files are written from the
fixture, one folder per class, run through the jobs, and what these wrote is read again."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from collidex import schemas
from collidex.functions import kinematics as K
from collidex.operators import prep as PR
from collidex.operators.features import FEATURE_COLS, event_features, particle_features
from collidex.operators.selection import preselect_nested
from collidex.plans import jobs
from collidex.plans.queries import _event_features, query, rounded
from collidex.session import input_bytes, scratch_path
from collidex.sources import events as EV
from collidex.sources.fixture import fixture, fixture_nested_events

#: Files of each bucketed table of ``bucketed_join``.
BUCKETS = 8


def event_files(spark, sf_dir) -> dict[int, str]:
    """The fixture's nested events as files, one folder per class."""
    path = scratch_path(spark, f"samples-{uuid.uuid4().hex}")
    fixture_nested_events(spark, sf_dir).write.partitionBy("label").parquet(path)
    paths = {k: f"{path}/label={k}" for k in (0, 1, 2)}
    for k in paths:                            # a class may have no event
        if not input_bytes(spark, [paths[k]]):
            spark.createDataFrame([], schemas.EVENT).drop("label").write.mode("overwrite").parquet(paths[k])
    return paths


def _job(spark, sf_dir) -> dict[str, str]:
    return jobs.events_to_features(spark, event_files(spark, sf_dir), scratch_path(spark, f"features-{uuid.uuid4().hex}"),
                                   auto_size=False, own_ids=True)


@query("job_event_features")
def q_job_event_features(spark, sf_dir):
    """Event files scanned, tagged, unioned; the written event features read again."""
    df = EV.read_features(spark, _job(spark, sf_dir)["event_features"])
    return rounded(df.withColumn("label", F.col("label").cast("int")))


@query("job_particle_features")
def q_job_particle_features(spark, sf_dir):
    """The written particle features read again with column projection."""
    return rounded(EV.read_features(spark, _job(spark, sf_dir)["particle_features"], ["event_id", "seq", "species", *FEATURE_COLS]))


@query("job_sequences")
def q_job_sequences(spark, sf_dir):
    """Standardised sequences written as arrays, read again and laid flat."""
    out = scratch_path(spark, f"sequences-{uuid.uuid4().hex}")
    features = _job(spark, sf_dir)["particle_features"].removesuffix("/particle_features")
    seq = EV.read_table(spark, jobs.features_to_sequences(spark, features, out), ["event_id", "scaled_features"])
    rows = seq.select("event_id", F.posexplode("scaled_features").alias("idx", "f"))
    return rounded(rows.select("event_id", F.col("idx").cast("int").alias("idx"), *[F.col("f")[i].alias(c) for i, c in enumerate(FEATURE_COLS)]))


@query("events_preselected")
def q_events_preselected(spark, sf_dir):
    """P6, P7, W1 (momentum): events kept by the predicates on the nested row."""
    return preselect_nested(fixture_nested_events(spark, sf_dir)).select("event_id", "label")


@query("events_renamed")
def q_events_renamed(spark, sf_dir):
    """The required columns renamed by position."""
    nested = fixture_nested_events(spark, sf_dir)
    names = ["id", "track", "neutral", "photon", "ele", "mu", "n_ele", "n_mu", "met", "jet"]
    assert len(names) == 1 + len(schemas.REQUIRED_COLUMNS)
    return EV.select_required(nested, names).select("id", "n_ele", "n_mu", F.size("jet").cast("long").alias("n_jet"))


@query("prepared_round_trip")
def q_prepared_round_trip(spark, sf_dir):
    """The prepared table (feature vector, label, encoded label) written and read again."""
    ef = PR.assemble(PR.one_hot(_event_features(spark, sf_dir)), out="HLF_input")
    path = scratch_path(spark, f"prepared-{uuid.uuid4().hex}")
    EV.write_table(ef.select("event_id", "HLF_input", "label", "encoded_label"), path)
    df = EV.read_table(spark, path)
    hlf, one = vector_to_array("HLF_input"), vector_to_array("encoded_label")
    return df.select("event_id", "label", *[K.r6(hlf[i]).alias(f"f{i}") for i in range(14)], *[one[i].alias(f"oh_{i}") for i in range(3)])


@query("bucketed_join")
def q_bucketed_join(spark, sf_dir):
    """S3 with layout: both feature tables bucketed by event, joined and grouped without an exchange."""
    run = uuid.uuid4().hex
    parts, events = fixture(spark, sf_dir)                 # written once, read by both
    for name, df in (("particles", particle_features(parts, events)), ("events", event_features(parts, events))):
        EV.write_bucketed(df, f"features_{name}_{run}", scratch_path(spark, f"bucketed-{name}-{run}"), BUCKETS)
    pf = EV.read_bucketed(spark, f"features_particles_{run}", ["event_id", "Pt"])
    ef = EV.read_bucketed(spark, f"features_events_{run}", ["event_id", "label", "HT"])
    return rounded(ef.hint("merge").join(pf, "event_id").groupBy("event_id", "label", "HT").agg(
        F.count(F.lit(1)).alias("n_particles"), F.max("Pt").alias("max_pt")))
