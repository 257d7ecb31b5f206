"""Operator 13: Merkle dataset manifest with incremental witnesses.

Leaves are appended in order. Each open subtree holds the nodes that wait for their
siblings, and with each the partial witnesses of the leaves below it; when a run of
siblings is complete, its members' witnesses grow by the siblings left and right of
them and pass on to the parent.

A source's tree is cut into aligned blocks of ``ARITY ** BLOCK_LEVELS`` leaves. Tasks
append the leaves of one block; the roots of all blocks are appended in the same way,
block upon block, until one node a source remains. The path above a block is then
handed down to its leaves. A source of any size is thus many small blocks.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collidex.llm.common import MAX_BROADCAST_IDS, saved, table

ARITY = 16
BLOCK_LEVELS = 2
BLOCK = ARITY ** BLOCK_LEVELS
DIGEST = 64
#: Largest number of groups whose paths (a few KB each) are broadcast; more are joined by a shuffle.
MAX_BROADCAST_GROUPS = 5_000
STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
WITNESS = "array<struct<left: string, right: string>>"


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Subtree:
    """Streaming append of up to ``ARITY ** levels`` nodes. A member is a list to which its witness's steps are added."""

    def __init__(self, levels: int):
        self.levels = levels
        self.open: list[list[tuple[str, list[list]]]] = [[] for _ in range(levels)]
        self.root = ""

    def append(self, digest: str, members: list[list], level: int = 0) -> None:
        if level == self.levels:
            self.root = digest
            return
        self.open[level].append((digest, members))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        text = "".join(digest for digest, _ in run)
        below = []
        for i, (_, members) in enumerate(run):
            step = {"left": text[:DIGEST * i], "right": text[DIGEST * (i + 1):]}
            for witness in members:
                witness.append(step)
            below += members
        self.append(H(text), below, level + 1)

    def finish(self) -> str:
        """Completes the last run of each level, however short, and returns the root."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return self.root


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos`` (from 0, by ``order`` within ``group``, nulls first) and ``n`` (rows of the group); no group is null.

    One range exchange over all groups; a group of any size is dealt over many
    partitions, and only its row counts per partition are summed up.
    """
    rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = saved(rows.withColumn("at", F.monotonically_increasing_id()), "ranked").withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy(group, "part").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    w = Window.partitionBy(group)
    before = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = saved(counts.select(group, "part", F.sum("c").over(w).alias("n"),
                                 (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift")), "counts")
    small = F.broadcast(counts) if counts.count() <= MAX_BROADCAST_IDS else counts
    return rows.join(small, [group, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def _block_roots(nodes: DataFrame) -> DataFrame:
    """Of ``g, n, pos, digest``: the root of each block, as nodes ``g, n, pos, digest`` of the level above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, size, out = None, None, 0, []
        for b in batches:
            g, n, block, digest = (b.column(c).to_pylist() for c in ("g", "n", "block", "digest"))
            for at in zip(g, block, n, digest):
                if at[:2] != key:
                    if tree:
                        out.append((*key, size, tree.finish()))
                    key, size = at[:2], at[2]
                    tree = Subtree(min(BLOCK_LEVELS, height(size)))
                tree.append(at[3].hex(), [])
            yield _roots(out)
            out = []
        if tree:
            yield _roots([(*key, size, tree.finish())])

    return saved(_blocked(nodes).select("g", "n", "block", "digest").mapInArrow(run, "g string, n long, pos long, digest binary"), "roots")


def _roots(rows: list[tuple]) -> pa.RecordBatch:
    g, pos, n, digest = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array([-(-x // BLOCK) for x in n], pa.int64()), pa.array(pos, pa.int64()),
                                       pa.array([bytes.fromhex(d) for d in digest], pa.binary())], names=["g", "n", "pos", "digest"])


def _climb(nodes: DataFrame, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Of nodes ``g, n, pos, digest``: tops ``g, digest``, and all nodes with their ``witness`` up to their top.

    Columns ``keep`` of the nodes are carried along.
    """
    roots = _block_roots(nodes)
    if roots.filter("n > 1").isEmpty():
        tops = roots.select("g", "digest")
        above = roots.select("g", F.col("pos").alias("block"), F.lit(None).cast(WITNESS).alias("above"))
    else:
        tops, up = _climb(roots)
        above = up.select("g", F.col("pos").alias("block"), F.col("witness").alias("above"))
    return tops, _witnesses(nodes, above, keep)


def _witnesses(nodes: DataFrame, above: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Nodes ``g, pos, digest, keep, witness``: the witness within the block, then that of the block (``g, block, above``).

    The path above a block travels once, as a row that sorts before the block's nodes.
    """
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    rows = nodes.select("g", "n", "pos", "digest", *keep, F.floor(F.col("pos") / BLOCK).alias("block"), F.lit(None).cast(WITNESS).alias("above"))
    heads = above.select("g", F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"),
                         *[F.lit(None).cast(kinds[c]).alias(c) for c in keep], "block", "above")
    both = rows.unionByName(heads).repartition("g", "block").sortWithinPartitions("g", "block", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, path, parts, made = None, None, [], [], []

        def block() -> pa.RecordBatch:
            tree.finish()
            t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            steps = pa.array([w + path for w in made], pa.list_(STEP))
            return pa.RecordBatch.from_arrays([*[t.column(c) for c in ("g", "pos", "digest", *keep)], steps],
                                              names=["g", "pos", "digest", *keep, "witness"])

        for b in batches:
            g, n, blocks, pos, digest = (b.column(c).to_pylist() for c in ("g", "n", "block", "pos", "digest"))
            start = 0
            for i, at in enumerate(zip(g, blocks)):
                if at != key:
                    if i > start:
                        parts.append(b.slice(start, i - start))
                    if made:
                        yield block()
                    key, tree, parts, made, start = at, None, [], [], i
                if pos[i] < 0:
                    path, start = b.column("above")[i].as_py() or [], i + 1
                    continue
                tree = tree or Subtree(min(BLOCK_LEVELS, height(n[i])))
                made.append([])
                tree.append(digest[i].hex(), [made[-1]])
            if start < b.num_rows:
                parts.append(b.slice(start))
        if made:
            yield block()

    return both.mapInArrow(run, f"g string, pos long, digest binary, {''.join(f'{c} {kinds[c]}, ' for c in keep)}witness {WITNESS}")


def leaf(columns: list[F.Column]) -> F.Column:
    """Digest (binary) of a row: of each column ``-`` if null, else its bytes in UTF-8, ``:`` and its value."""
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
                                     for c in columns]), 256))


def manifest(docs: DataFrame, digests: dict[str, F.Column], group: str = "source", key: str = "doc_id") -> DataFrame:
    """The manifest of ``docs``: ``key, group, leaf, subroot, root, witness`` and further digests, per row.

    ``digests`` maps ``leaf``, and any other digest to carry along, to binary columns over
    ``docs``. A row's ``witness`` lists, from its leaf to the root, the siblings left and
    right of its path, as joined hex digests; ``fold`` recomputes the root from it.

    Groups are ordered by their text (null first, then by UTF-8 bytes), rows of a group by
    ``key`` (null first), then by leaf; repeated rows are leaves of their own. Columns not
    named are not read. An empty table gives an empty result.
    """
    carried = [c for c in digests if c != "leaf"]
    # a group's mark: empty if null, else the text behind a sign, in the same order
    mark = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    rows = saved(docs.select(mark.alias("g"), F.col(key).alias("key"), *[c.alias(name) for name, c in digests.items()])
                     .withColumn("rid", F.monotonically_increasing_id()), "leaves")
    nodes = ranked(rows, "g", ["key", "leaf", "rid"]).drop("rid").withColumnRenamed("leaf", "digest")
    subroots, in_group = _climb(nodes, ["key", *carried])
    tops = ranked(subroots.select(F.lit("").alias("all"), F.col("g").alias("name"), "digest"), "all", ["name"])
    root, groups = _climb(tops.withColumnRenamed("all", "g"), ["name"])
    groups = saved(groups.join(F.broadcast(root.select("g", F.col("digest").alias("root"))), "g").select(     # one root
        F.col("name").alias("g"), F.col("digest").alias("subroot"), "root", F.col("witness").alias("top")), "group-paths")
    out = in_group.join(F.broadcast(groups) if groups.count() <= MAX_BROADCAST_GROUPS else groups, "g")
    return out.select(F.col("key").alias(key), F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias(group),
                      F.lower(F.hex("digest")).alias("leaf"), *carried, F.lower(F.hex("subroot")).alias("subroot"),
                      F.lower(F.hex("root")).alias("root"), F.concat("witness", "top").alias("witness"))


def fold(digest: F.Column, witness: str = "witness") -> F.Column:
    """The root that a hex digest and its witness give."""
    return F.aggregate(witness, digest, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(witness: str = "witness") -> F.Column:
    """Digest of all siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(witness, lambda s: F.array(s["left"], s["right"]))), ""), 256)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    m = manifest(docs, {"leaf": leaf([*first, F.col("text")]), "changed": F.when(tampered, leaf([*first, lowered]))})
    m = m.withColumn("folded_root", fold(F.coalesce(F.lower(F.hex("changed")), F.col("leaf"))))
    return m.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(levels: int = 5, top_levels: int = 3) -> str:
    """The trees by window functions, one level after the other; for at most 16^levels rows a source and 16^top_levels sources."""
    def enc(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    fields = [enc(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        # the checksum's table by its rule, one bit after the other
        "crc_table AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)), "
        "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(b)))",
        f"""d AS MATERIALIZED (SELECT doc_id, source, sha256({' || '.join([*fields, enc('text')])}) AS leaf, sha256({' || '.join([*fields, enc(lowered)])}) AS changed,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 5 = 0 AS tampered
    FROM documents, crc_table)""",
        "l0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d)",
        "n0 AS (SELECT source AS g, n, pos, leaf AS h FROM l0)",
    ]

    def tree(first: str, name: str, count: int) -> None:
        for i in range(count):
            below = first if i == 0 else f"{name}{i}"
            steps.append(f"""{name}r{i + 1} AS MATERIALIZED (SELECT g, n, pos // 16 AS pos, string_agg(h, '' ORDER BY pos) AS run FROM {below} GROUP BY ALL)""")
            steps.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT g, (n + 15) // 16 AS n, pos, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS h FROM {name}r{i + 1})""")

    tree("n0", "s", levels)
    steps.append(f"t0 AS MATERIALIZED (SELECT '' AS g, count(*) OVER () AS n, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, h, g AS source FROM s{levels})")
    steps.append("tn AS (SELECT g, n, pos, h FROM t0)")
    tree("tn", "t", top_levels)
    steps.append("""f0 AS MATERIALIZED (SELECT l0.doc_id, l0.source, l0.leaf, l0.pos, t0.pos AS tpos, t0.h AS subroot, '' AS proof,
    CASE WHEN tampered THEN changed ELSE leaf END AS fold FROM l0 JOIN t0 ON l0.source IS NOT DISTINCT FROM t0.source)""")
    at = 0
    for name, count, pos, on in (("s", levels, "pos", "r.g IS NOT DISTINCT FROM f.source"), ("t", top_levels, "tpos", "true")):
        for i in range(1, count + 1):
            own = f"CAST(f.{pos} % 16 AS INTEGER)"
            left, right = f"substr(r.run, 1, 64 * {own})", f"substr(r.run, 64 * {own} + 65)"
            other = "f.tpos" if pos == "pos" else "f.pos"
            steps.append(f"""f{at + 1} AS MATERIALIZED (SELECT doc_id, source, leaf, {other} AS {'tpos' if pos == 'pos' else 'pos'}, f.{pos} // 16 AS {pos}, subroot,
    CASE WHEN r.n > 1 THEN proof || {left} || {right} ELSE proof END AS proof,
    CASE WHEN r.n > 1 THEN sha256({left} || fold || {right}) ELSE fold END AS fold
    FROM f{at} f JOIN {name}r{i} r ON {on} AND r.pos = f.{pos} // 16)""")
            at += 1
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM f{at}, (SELECT h AS root FROM t{top_levels})
"""


SQL = _sql()
