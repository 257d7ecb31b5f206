"""The two batch jobs: events -> features (E1) and features -> images.

E1 writes the particle features (flat), made in the partitioning by event that
isolation leaves, and the event features from their lepton rows, partitioned by
label so class-wise reads prune files. Only for the padded matrix is the per-event
particle table of selected events written first, to the shared checkpoint folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.config import DEFAULT_CUTS, Cuts
from collidex.operators import features as FE
from collidex.operators import images as IM
from collidex.operators.selection import event_particles, preselect_nested
from collidex.session import build_session, size_shuffles, written
from collidex.sources import events as EV


def load_samples(spark: SparkSession, samples: dict[int, str], own_ids: bool = False) -> DataFrame:
    """Scan each class sample, keep required columns, tag, union.

    Files that each number their events from 1 stay apart: keys are made from sample,
    file and row unless ``own_ids`` says that the files' ids are unique over all of them.
    """
    tagged = []
    for label, path in samples.items():
        df = EV.with_event_id(EV.read_events(spark, path), label, own_ids)
        tagged.append(EV.tag(EV.select_required(df), label))
    return EV.union_samples(tagged)


def events_to_features(spark: SparkSession, samples: dict[int, str], out: str,
                       cuts: Cuts = DEFAULT_CUTS, matrix: bool = False,
                       stats_path: str | None = None, auto_size: bool = True,
                       own_ids: bool = False) -> dict[str, str]:
    """E1. Returns the written table paths. ``auto_size`` sizes the shuffle
    partition count from the input volume (see ``session.size_shuffles``)."""
    if auto_size:
        size_shuffles(spark, list(samples.values()))
    events = load_samples(spark, samples, own_ids)
    if stats_path:
        EV.write_sample_stats(events, stats_path)
    kept = preselect_nested(events, cuts)
    parts, info = EV.explode_particles(kept), EV.event_info(kept)
    ep = event_particles(parts, info, cuts)
    if matrix:                                 # read once more
        ep = written(ep, "event_particles")
    paths = {"particle_features": f"{out}/particle_features", "event_features": f"{out}/event_features"}
    pf = FE.particle_features(parts, info, cuts, ep=ep, extra=("label",))
    EV.write_features(pf, paths["particle_features"], partition_by=["label"])
    pf = spark.read.schema(pf.schema).parquet(paths["particle_features"])
    ef = FE.event_features(parts, info, cuts, ep=FE.lepton_rows(pf, info))
    EV.write_features(ef, paths["event_features"], partition_by=["label"])
    if matrix:
        paths["matrix"] = f"{out}/matrix"
        lf = FE.assemble_lfeatures(FE.particle_features(parts, info, cuts.with_matrix_caps(), ep=ep), cuts.n_rows)
        hf = FE.assemble_hfeatures(spark.read.parquet(paths["event_features"]), as_vector=True)
        EV.write_features(lf.join(hf, "event_id"), paths["matrix"])
    return paths


def features_to_images(spark: SparkSession, features_dir: str, out: str, res: int = 100,
                       max_eta: float = 5.0, dense: bool = False) -> str:
    """Sparse blended pixels (event_id, x, y, r, g, b, label); dense on request."""
    pf = spark.read.parquet(f"{features_dir}/particle_features")
    ef = spark.read.parquet(f"{features_dir}/event_features")
    px = IM.event_pixels(pf, ef, res, max_eta)
    labels = ef.select("event_id", "label")
    if dense:
        EV.write_images(IM.dense_images(px, res, max_eta, labels), out)
    else:
        EV.write_images(px.join(labels, "event_id"), out, partition_by=["label"])
    return out


def features_to_sequences(spark: SparkSession, features_dir: str, out: str) -> str:
    """Sequence job: ordered, standardised particle sequences (F3) per event,
    written as ``scaled_features`` arrays with the label (S7)."""
    from collidex.operators.sequences import sequence_arrays, sequence_features
    pf = spark.read.parquet(f"{features_dir}/particle_features")
    seq = sequence_arrays(sequence_features(pf.drop("label")))
    EV.write_sequences(seq.join(pf.where("seq = 0").select("event_id", "label"), "event_id"), out)
    return out


def main(argv=None):
    ap = argparse.ArgumentParser(description="collision events -> features -> images")
    ap.add_argument("qcd")
    ap.add_argument("ttbar")
    ap.add_argument("wjets")
    ap.add_argument("out")
    ap.add_argument("--images", action="store_true")
    ap.add_argument("--res", type=int, default=100)
    a = ap.parse_args(argv)
    spark = build_session(app="collidex-features")
    paths = events_to_features(spark, {0: a.qcd, 1: a.ttbar, 2: a.wjets}, a.out,
                               stats_path=f"{a.out}/sample_stats")
    if a.images:
        features_to_images(spark, a.out, f"{a.out}/images", res=a.res)
    print(paths)


if __name__ == "__main__":
    main()
