"""Deterministic collision-event fixture derived from the ``lineitem`` table.

The driver tables hold no collision events, so every event query starts
here. All values are plain arithmetic on lineitem columns, so the same
relation can be written in any SQL engine. The formulas are fixed values of
the fixture (see FIXTURES.md section 4).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collidex import schemas
from collidex.session import scratch_path

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat particle relation (schemas.PARTICLE) built from lineitem.

    One lineitem row is one particle; electrons and muons are also emitted
    as tracks. ``pos`` is the particle's order inside its event.
    """
    li = read_table(spark, sf_dir, "lineitem").select(*_LINEITEM_COLS)
    k, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    code = (p * 7 + s * 3 + n) % 20
    species = (F.when(code < 8, "track").when(code < 12, "photon").when(code < 16, "neutral")
               .when(code < 18, "electron").when(code == 18, "muon").otherwise("jet"))
    eta0 = ((p * 37 + k * 11 + n * 53) % 481 - 240) * F.lit(0.0101)
    phi = ((s * 41 + k * 29 + n * 97) % 629 - 314) * F.lit(0.0097)
    price = F.col("l_extendedprice")
    charge = F.when(F.col("l_linestatus") == "O", 1).otherwise(-1)
    event_id = F.floor(k / 10).cast("long")
    w = Window.partitionBy("event_id").orderBy(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    base = (li.withColumn("event_id", event_id)
            .withColumn("pos", F.row_number().over(w).cast("int"))
            .withColumn("species", species)         # made after the shuffle of the window
            .select(
                "event_id", "species", "pos",
                (F.when(F.col("species") == "track", price / F.lit(10000.0))
                 .when(F.col("species").isin("photon", "neutral"), price / F.lit(4000.0))
                 .when(F.col("species").isin("electron", "muon"), price / F.lit(2000.0))
                 .otherwise(price / F.lit(1000.0))).alias("pt"),
                F.when(F.col("species") == "jet", eta0 * F.lit(1.25)).otherwise(eta0).alias("eta"),
                phi.alias("phi"),
                (F.col("l_quantity") / F.lit(10.0)).alias("x"),
                (F.col("l_tax") * F.lit(100.0)).alias("y"),
                (F.col("l_discount") * F.lit(100.0)).alias("z"),
                F.when((F.col("l_returnflag") == "N") & (n == 7), F.lit(0))
                 .otherwise(charge * 211).cast("int").alias("pid"),
                charge.cast("int").alias("charge"),
                F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("btag"),
            ))
    # Track copies of leptons via explode (one scan, not a self-union).
    copies = F.when(F.col("species").isin("electron", "muon"),
                    F.array(F.col("species"), F.lit("track"))).otherwise(F.array(F.col("species")))
    return base.withColumn("species", F.explode(copies)).select(*base.columns)


def _counted() -> list[Column]:
    return [F.count(F.when(F.col("species") == sp, 1)).cast("int").alias(f"{sp}_size") for sp in ("electron", "muon")]


def _event_values() -> list[Column]:
    eid = F.col("event_id")
    return [(eid % 3).cast("int").alias("label"), ((eid * 7919 % 20000) / F.lit(100.0)).alias("met"),
            ((eid * 31 % 629 - 314) * F.lit(0.0097)).alias("met_phi")]


def fixture_events(particles: DataFrame) -> DataFrame:
    """Event relation (schemas.EVENT_INFO) for the fixture particles."""
    label, met, met_phi = _event_values()
    return particles.groupBy("event_id").agg(*_counted()).select("event_id", label, "electron_size", "muon_size", met, met_phi)


def fixture(spark: SparkSession, sf_dir: str, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(particles, events) of the fixture.

    Every query reads the particles in several branches with different
    column sets, so no exchange can be shared between them and the lineitem
    sort + window would re-run per branch. The particles are therefore written
    once, as a table under the shared checkpoint folder (this also cuts the
    lineage), and each branch scans it with its own pruned columns.
    """
    parts = fixture_particles(spark, sf_dir)
    if materialize:
        path = scratch_path(spark, f"fixture-particles-{uuid.uuid4().hex}")
        parts.write.parquet(path)
        parts = spark.read.parquet(path)
    return parts, fixture_events(parts)


def _ordered(particles: DataFrame, species: str, fields: list[tuple[str, str]]):
    """Array of one species per event, in ``pos`` order (array order is semantic)."""
    sel = F.col("species") == species
    st = F.struct(F.col("pos"), *[F.col(src).alias(dst) for src, dst in fields])
    arr = F.array_sort(F.collect_list(F.when(sel, st)))
    return F.transform(arr, lambda e: F.struct(*[e[dst].alias(dst) for _, dst in fields]))


def fixture_nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as nested raw events (schemas.EVENT): one row per event.

    Particles are used once, where they were numbered: they are neither written nor shuffled again.
    """
    parts = fixture_particles(spark, sf_dir)
    t = [("pt", "PT"), ("eta", "Eta"), ("phi", "Phi"), ("x", "X"), ("y", "Y"), ("z", "Z"), ("pid", "PID")]
    tw = [("pt", "ET"), ("eta", "Eta"), ("phi", "Phi")]
    lep = [("pt", "PT"), ("eta", "Eta"), ("phi", "Phi"), ("charge", "Charge")]
    jet = [("pt", "PT"), ("eta", "Eta"), ("btag", "BTag")]
    arrays = parts.groupBy("event_id").agg(
        _ordered(parts, "track", t).alias("EFlowTrack"),
        _ordered(parts, "neutral", tw).alias("EFlowNeutralHadron"),
        _ordered(parts, "photon", tw).alias("EFlowPhoton"),
        _ordered(parts, "electron", lep).alias("Electron"),
        _ordered(parts, "muon", lep).alias("MuonTight"),
        _ordered(parts, "jet", jet).alias("Jet"),
        *_counted(),
    )
    met = F.array(F.struct(F.col("met").alias("MET"), F.col("met_phi").alias("Phi")))
    out = arrays.select("*", *_event_values()).select(
        "event_id", "EFlowTrack", "EFlowNeutralHadron", "EFlowPhoton", "Electron", "MuonTight",
        F.col("electron_size").alias("Electron_size"), F.col("muon_size").alias("MuonTight_size"),
        met.alias("MissingET"), "Jet", "label")
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.EVENT.fields])
