"""Operator 1: n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric, so pivots can part documents into regions, and the
triangle inequality tells which documents near a border must also enter the
neighbouring region. In a text corpus nearly all pairs are at distance exactly
one, though, where full documents as pivots tell nothing apart. The join therefore
starts with pivots that are single shingles and recurses with documents as pivots:

1. Voronoi regions of shingles. All shingles are ordered, those of many documents
   last, then by hash. Two sets within distance 1 - t share one of their first
   n - ceil(t n) + 1 shingles, so a document enters the regions of these (its
   nearest pivot and the window around it), and no linked pair is separated.
2. Windows of size. Linked sets differ in size by the factor t at most: a region is
   cut into size rings, and each document also visits the next ring. Documents with
   too many shingles of their own for any partner there are dropped.
3. Pairs of small regions (``small`` sets at most) are tested by the number of regions
   they share, and those that may be similar enough by their sets.
   Of larger regions, each takes one of its documents as pivot; regions with the same
   pivot become one, so that a group of near copies is handled once and not once per
   shared shingle.
4. Recursion. While a region is larger than ``leaf``, distances to a new pivot are
   computed. Documents within 1 - t of the pivot are linked to it. All others are
   cut into distance rings of width 1 - t, and by the triangle inequality need to
   meet only their own ring and the one before.
5. Leaves are joined exactly; one still too large is joined block by block.

Only hashes, sizes and signatures are shuffled up to step 3, and shingle sets of
those documents alone that have company in a leaf. Copies share one signature.
Results are exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collidex.llm.common import only_ids, saved, table
from collidex.llm.components import components
from collidex.llm.shingles import shingle_sets, signature

#: The frequency sketch has 2^20 counters in 64 slices; a task's counters saturate at 65,535.
SKETCH_BITS, SLICES = 20, 64


def _scan(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n, sig`` per document and, with a slice number, each task's shingle counters."""

    def run(batches):
        counts, seen = np.zeros(1 << SKETCH_BITS, np.int64), set()
        for b in batches:
            n, sig, fresh = [], [], []
            for s in shingle_sets(b.column(1), k):
                n.append(len(s))
                sig.append(signature(s))
                if sig[-1] not in seen:
                    seen.add(sig[-1])
                    fresh.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32))
            if fresh:
                counts += np.bincount(np.concatenate(fresh), minlength=1 << SKETCH_BITS)
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                names=["doc_id", "n", "sig", "slice", "counts"])
        parts = np.minimum(counts, 65535).astype("<u2").reshape(SLICES, -1)
        if counts.any():
            none = pa.nulls(SLICES).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.array(range(SLICES), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
                names=["doc_id", "n", "sig", "slice", "counts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, sig long, slice int, counts binary")


def _frequent(scan: DataFrame) -> np.ndarray:
    """Which counters stand out, as a bit string of 128 KB. Sums go by slice and share of tasks, then by slice."""

    def added(key, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // SLICES, np.int64)
        for c, wide in zip(pdf["counts"], pdf["wide"]):
            total += np.frombuffer(zlib.decompress(c), "<i8" if wide else "<u2")
        return pd.DataFrame({"slice": [key[0]], "counts": [zlib.compress(total.tobytes(), 1)], "wide": [True]})

    schema = "slice int, counts binary, wide boolean"
    parts = scan.filter("slice IS NOT NULL").select("slice", "counts", F.lit(False).alias("wide"),
                                                    F.pmod(F.xxhash64("counts"), F.lit(64)).alias("share"))
    sums = (parts.groupBy("slice", "share").applyInPandas(added, schema).groupBy("slice").applyInPandas(added, schema))
    total = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.int64)
    for r in sums.collect():                # 64 rows, 8 MB at most, at any size of the corpus
        total[r["slice"]] = np.frombuffer(zlib.decompress(bytes(r["counts"])), "<i8")
    total = total.ravel()
    return np.packbits(total > total.mean() + 8 * np.sqrt(total.mean()) + 8)


def _prefixes(docs: DataFrame, k: int, threshold: float, frequent: np.ndarray) -> DataFrame:
    """``g, sig, n, pos``: the regions of shingles that each different set enters, in their order."""

    def run(batches):
        often, seen = np.unpackbits(frequent).astype(bool), set()
        for b in batches:
            g, sig, n, pos = [], [], [], []
            for s in shingle_sets(b.column(0), k):
                if len(s) and (x := signature(s)) not in seen:
                    seen.add(x)
                    m = len(s) - math.ceil(threshold * len(s) - 1e-9) + 1
                    late = often[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    rare = s[~late][:m]
                    g.append(np.concatenate([rare, s[late][:m - len(rare)]]))
                    sig.append(np.full(m, x, np.int64))
                    n.append(np.full(m, len(s), np.int64))
                    pos.append(np.arange(m))
            if g:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(g).astype(np.int64)), pa.array(np.concatenate(sig)), pa.array(np.concatenate(n)),
                     pa.array(np.concatenate(pos).astype(np.int32))], names=["g", "sig", "n", "pos"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "g long, sig long, n long, pos int")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for b in batches:
            s = list(shingle_sets(b.column(1), k))
            yield pa.RecordBatch.from_arrays(
                [pa.array([signature(x) for x in s], pa.int64()), pa.array([x.tobytes() for x in s], pa.binary())], names=["sig", "set"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "sig long, set binary")


def overlaps(sets: list[bytes], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices of ``width`` shingles at a time."""
    arrays = [np.frombuffer(s, np.uint64) for s in sets]
    row = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
    _, col, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    shared = count[col] > 1
    row, col = row[shared], (np.cumsum(count > 1) - 1)[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(arrays), len(arrays)), np.float32)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        i, j = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(arrays), width), np.float32)
        m[row[i:j], col[i:j] - lo] = 1
        out += m @ m.T
    return out


def _leaf(threshold: float):
    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("sig")
        sig, n, home = pdf["sig"].to_numpy(), pdf["n"].to_numpy(), pdf["home"].to_numpy()
        both = overlaps(pdf["set"].tolist())
        near = both >= threshold * (n[:, None] + n[None] - both) - 1e-6
        near &= home[:, None] | home[None]          # two visitors meet in the ring before
        left = np.arange(len(sig))                  # links enough to hold each group together
        edges, todo = [], set(range(len(sig)))
        while todo:
            stack = [todo.pop()]
            while stack:
                i = stack.pop()
                for j in np.flatnonzero(near[i] | near[:, i]):
                    if j in todo:
                        todo.discard(j)
                        edges.append((sig[i], sig[j]))
                        stack.append(j)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
    return join


def _star(pdf: pd.DataFrame) -> pd.DataFrame:
    """Distance of each member of a block to the region's pivot, whose row comes along."""
    centre = pdf[pdf["pivot"]].iloc[0]
    c = np.frombuffer(centre["set"], np.uint64)
    rest = pdf[~pdf["pivot"]]
    common = np.array([len(np.intersect1d(c, np.frombuffer(s, np.uint64), assume_unique=True)) for s in rest["set"]])
    return pd.DataFrame({"key": rest["key"], "p": centre["sig"], "sig": rest["sig"], "n": rest["n"],
                         "d": 1 - common / (len(c) + rest["n"] - common)})


def _ringed(members: DataFrame, value, step: float) -> DataFrame:
    """Each member at home in its ring and a visitor in the next; ``key`` then names region and ring."""
    ring = F.floor(value / step)
    m = members.withColumn("r", F.explode(F.array(ring, ring + 1))).withColumn("home", F.col("r") == ring)
    return m.withColumn("key", F.xxhash64("key", "r")).drop("r")


def _with_company(m: DataFrame) -> DataFrame:
    """Members of regions that have a pair to test, with the region's size ``c``."""
    size = m.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.col("home").cast("int")).alias("homes"))
    return m.join(size.filter("c > 1 AND homes > 0").drop("homes"), "key")


def _regions(rows: DataFrame, threshold: float) -> DataFrame:
    """``key, sig, n, spare, home, c, low``: the regions of shingles, cut into size rings.

    In a shingle's region, all shingles ranked before it that no other set's window has
    are in one set alone. Two linked sets differ in (1 - t) / (1 + t) of their summed sizes
    at most, so a set whose lone shingles exceed what the best partner there leaves it goes.
    """
    several = rows.groupBy("g").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).filter("low <> high").select("g")
    shared = rows.join(several, "g").dropDuplicates(["g", "sig"])
    lone = F.col("pos") - F.row_number().over(Window.partitionBy("sig").orderBy("pos")) + 1      # one document's rows
    spare = lone - F.col("n") * ((1 - threshold) / (1 + threshold))
    shared = shared.select(F.col("g").alias("key"), "sig", "n", spare.alias("spare"))
    shared = saved(_ringed(shared, F.log(F.col("n")), -math.log(threshold) * (1 + 1e-9)), "shared")
    best = shared.groupBy("key").agg(F.min("spare").alias("best"), F.count("*").alias("c"), F.min("sig").alias("low"),
                                     F.max("home").alias("homes")).filter("c > 1 AND homes")
    return saved(shared.join(best.drop("homes"), "key").filter("spare + best <= 1e-9").drop("best"), "rings")


def _pairs(rows: DataFrame, threshold: float, small: int) -> DataFrame:
    """``a, b``: pairs of the regions of at most ``small`` sets that may be similar enough.

    Beyond the common shingles counted here and those in larger regions, two sets can only
    share what lies outside both windows.
    """
    window = lambda n: F.col(n) - F.ceil(F.col(n) * threshold - 1e-9) + 1      # noqa: E731
    r = rows.filter(F.col("c") <= small).select("key", "sig", "n", "spare", "home")
    two = r.select("key", *[F.col(c).alias(c + "2") for c in ("sig", "n", "spare", "home")])
    pairs = (r.join(two, "key").filter("sig < sig2 AND (home OR home2) AND spare + spare2 <= 1e-9")
              .filter(F.least("n", "n2") >= F.greatest("n", "n2") * threshold - 1e-9)
              .groupBy("sig", "sig2").agg(F.count("*").alias("shared"), F.min("n").alias("n"), F.min("n2").alias("n2")))
    hidden = rows.filter(F.col("c") > small).groupBy("sig").agg(F.count("*").alias("hidden"))
    pairs = (pairs.join(hidden, "sig", "left").join(hidden.select(F.col("sig").alias("sig2"), F.col("hidden").alias("hidden2")), "sig2", "left"))
    most = (F.col("shared") + F.least(F.coalesce("hidden", F.lit(0)), F.coalesce("hidden2", F.lit(0)))
            + F.greatest(F.col("n") - window("n"), F.col("n2") - window("n2")))
    return pairs.filter(most >= (F.col("n") + F.col("n2")) * (threshold / (1 + threshold)) - 1e-6).select(
        F.col("sig").alias("a"), F.col("sig2").alias("b"))


def _members(rows: DataFrame, threshold: float, small: int) -> DataFrame:
    """``key, sig, n, home, c``: the larger regions, those of one pivot as one."""
    ring = F.floor(F.log(F.col("n")) / (-math.log(threshold) * (1 + 1e-9))) + F.when(F.col("home"), 0).otherwise(1)
    return _with_company(rows.filter(F.col("c") > small).select(F.xxhash64("low", ring).alias("key"), "sig", "n", "home").distinct())


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(both >= threshold * (len(a) + len(b) - both) - 1e-6)
        return pd.Series(out, dtype=bool)

    one, two = sets.select(F.col("sig").alias("a"), F.col("set").alias("x")), sets.select(F.col("sig").alias("b"), F.col("set").alias("y"))
    return pairs.join(one, "a").join(two, "b").filter(similar("x", "y")).select("a", "b")


def links(docs: DataFrame, k: int, threshold: float, small: int = 64, leaf: int = 256, depth: int = 2) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, n, sig`` of every row, ``a, b``: links between signatures that connect all linked sets)."""
    step = 1 - threshold
    scan = saved(_scan(docs, k), "shingle-scan")
    ids = scan.filter("slice IS NULL").select("doc_id", "n", "sig")
    rows = saved(_prefixes(docs, k, threshold, _frequent(scan)), "prefixes")
    rows = _regions(rows, threshold)
    pairs = saved(_pairs(rows, threshold, small), "pairs")
    members = saved(_members(rows, threshold, small), "regions")

    needed = members.select("sig").union(pairs.select("a")).union(pairs.select("b")).distinct()
    first = ids.filter("doc_id IS NOT NULL").join(needed, "sig", "left_semi").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    sets = saved(_sets(only_ids(docs.select("doc_id", "text"), first.select("doc_id"), "doc_id"), k).distinct(), "sets")
    found = [_verified(pairs, sets, threshold)]
    for level in range(depth + 1):
        large = members.filter(F.col("c") > leaf)
        if level == depth or large.isEmpty():
            break
        blocks = F.ceil(F.col("c") / leaf)
        centre = large.groupBy("key").agg(F.min(F.struct(~F.col("home"), F.xxhash64("sig"), "sig"))["sig"].alias("sig"), F.max("c").alias("c"))
        centre = centre.select("key", "sig", F.lit(0).cast("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.lit(True).alias("pivot"))
        tiles = large.select("key", "sig", "n", F.pmod(F.xxhash64("sig"), blocks).alias("block"), F.lit(False).alias("pivot"))
        star = (tiles.union(centre).join(sets, "sig").select("key", "block", "pivot", "sig", "n", "set")
                     .groupBy("key", "block").applyInPandas(_star, "key long, p long, sig long, n long, d double"))
        star = saved(star, "star")
        found.append(star.filter((F.col("d") <= step + 1e-9) & (F.col("p") != F.col("sig"))).select(F.col("p").alias("a"), F.col("sig").alias("b")))
        # those within 1 - t of the pivot are linked through it: ring 0 has no home of its own
        ring = _with_company(_ringed(star.select("key", "sig", "n", "d"), F.col("d"), step * (1 + 1e-9))).withColumn("inner", F.col("home") & (F.col("d") <= step))
        alive = ring.groupBy("key").agg(F.max(~F.col("inner") & F.col("home")).alias("alive")).filter("alive").select("key")
        found.append(_leaves(members.filter(F.col("c") <= leaf), sets, leaf, threshold))
        members = saved(ring.join(alive, "key", "left_semi").select("key", "sig", "n", "home", "c"), "regions")
    found.append(_leaves(members, sets, leaf, threshold))
    edges = found[0]
    for f in found[1:]:
        edges = edges.union(f)
    return ids, saved(edges, "links")


def _leaves(members: DataFrame, sets: DataFrame, leaf: int, threshold: float) -> DataFrame:
    """Exact join of each region; of one with several blocks, of each pair of blocks."""
    blocks = F.ceil(F.col("c") / leaf)
    m = members.withColumn("block", F.pmod(F.xxhash64("sig"), blocks))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    m = m.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "sig", "n", "home")
    return m.join(sets, "sig").groupBy("key", "i", "j").applyInPandas(_leaf(threshold), "a long, b long")


def jaccard_join(docs: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Documents link when intersection >= ``threshold`` * union of their ``k``-word shingle
    sets; ``component_id`` is the smallest doc_id reachable by links. Null, empty and blank
    texts have the empty set and no link; texts under ``k`` words have one shingle. Null ids
    take part, but name no component (their own is null unless linked to an id). Rows that
    repeat an id each get a row. Other columns are not read; an empty table gives an empty result.
    """
    ids, edges = links(docs, k, threshold)
    classes = ids.filter("n > 0").groupBy("n", "sig").agg(F.min("doc_id").alias("first"))
    name = classes.filter("first IS NOT NULL").select("sig", "first")
    ends = (edges.join(name.select(F.col("sig").alias("a"), F.col("first").alias("x")), "a")
                 .join(name.select(F.col("sig").alias("b"), F.col("first").alias("y")), "b")
                 .select(F.col("x").alias("a"), F.col("y").alias("b")))
    label = components(ends)
    named = classes.join(label, classes["first"] == label["node"], "left").select("n", "sig", F.coalesce("label", "first").alias("component_id"))
    named = saved(named, "classes")
    linked = ids.filter("n > 0").join(named, ["n", "sig"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(ids.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), k=4, threshold=0.85)
