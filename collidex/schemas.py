"""Explicit schemas of every relation the pipeline reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

D, I, L, S = T.DoubleType(), T.IntegerType(), T.LongType(), T.StringType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRACK = _struct(("PT", D), ("Eta", D), ("Phi", D), ("X", D), ("Y", D), ("Z", D), ("PID", I))
TOWER = _struct(("ET", D), ("Eta", D), ("Phi", D))
LEPTON = _struct(("PT", D), ("Eta", D), ("Phi", D), ("Charge", I))
MISSING_ET = _struct(("MET", D), ("Phi", D))
JET = _struct(("PT", D), ("Eta", D), ("BTag", I))

# Nested raw event: only the fields the pipeline uses, so a scan with this
# schema prunes every other nested column at the Parquet reader.
EVENT = _struct(
    ("event_id", L),
    ("EFlowTrack", T.ArrayType(TRACK)),
    ("EFlowNeutralHadron", T.ArrayType(TOWER)),
    ("EFlowPhoton", T.ArrayType(TOWER)),
    ("Electron", T.ArrayType(LEPTON)),
    ("MuonTight", T.ArrayType(LEPTON)),
    ("Electron_size", I),
    ("MuonTight_size", I),
    ("MissingET", T.ArrayType(MISSING_ET)),
    ("Jet", T.ArrayType(JET)),
    ("label", I),
)
REQUIRED_COLUMNS = [f.name for f in EVENT.fields if f.name not in ("event_id", "label")]

# Flat particle relation: one row per particle of any species.
PARTICLE = _struct(
    ("event_id", L), ("species", S), ("pos", I), ("pt", D), ("eta", D), ("phi", D),
    ("x", D), ("y", D), ("z", D), ("pid", I), ("charge", I), ("btag", I),
)
# Event-level relation: one row per event.
EVENT_INFO = _struct(
    ("event_id", L), ("label", I), ("electron_size", I), ("muon_size", I),
    ("met", D), ("met_phi", D),
)

SPECIES = ("track", "photon", "neutral", "electron", "muon", "jet")
# Nested array column and the name of its momentum field, per species.
SPECIES_SOURCE = {
    "track": ("EFlowTrack", "PT"),
    "photon": ("EFlowPhoton", "ET"),
    "neutral": ("EFlowNeutralHadron", "ET"),
    "electron": ("Electron", "PT"),
    "muon": ("MuonTight", "PT"),
    "jet": ("Jet", "PT"),
}

SCALING_LOG = _struct(("nodes", I), ("elapsed_time", D))
LOSS_HISTORY = _struct(("trainer", S), ("worker_id", I), ("iteration", L), ("loss", D))
