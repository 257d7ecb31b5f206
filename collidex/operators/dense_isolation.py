"""J1 in dense jet cores: cone sums over adaptive cells.

A cell with more than ``limit`` candidates is a node with a box around its points and
their sums. A probe drops a node whose box lies outside its cone, takes the sums of one
that lies wholly inside, and follows the others into the node's four children, level by
level. Only the small cells that the rim of a cone cuts are compared pair by pair, so a
core of n particles costs each probe about its rim and not n, and no join key holds
more than ``limit`` candidates. Points at one place have a box without extent and are
never split. Each level is written; there are at most ``max_depth``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collidex.config import PI_APPROX
from collidex.operators.isolation import (CROWDED, MAP_SPECIES, _by_momentum, _cells, candidate_copies, cone_residual, crowded_events,
                                         probe_cells)
from collidex.session import written

#: Boxes nearer to the rim than this are compared point by point, so that rounding decides nothing.
RIM = 1e-9


def _reach(dr: float, wrap: str) -> tuple[F.Column, F.Column]:
    """Whether a node's box is wholly outside and wholly inside the cone of a probe."""
    e0, e1 = F.col("e0") - F.col("_pe"), F.col("e1") - F.col("_pe")
    p0, p1 = F.col("p0") - F.col("_pp"), F.col("p1") - F.col("_pp")

    def square(x):
        return x * x

    near = square(F.greatest(e0, -e1, F.lit(0.0))) + square(F.greatest(p0, -p1, F.lit(0.0)))
    far = square(F.greatest(F.abs(e0), F.abs(e1))) + square(F.greatest(F.abs(p0), F.abs(p1)))
    outside, inside = near >= dr * dr + RIM, far < dr * dr - RIM
    if wrap == "legacy":        # a shifted copy counts beyond the period only
        k = F.col("_k")
        inside &= (k == 0) | ((k == 1) & (p0 > RIM)) | ((k == -1) & (p1 < -RIM))
    return outside, inside


def isolation_dense(probes: DataFrame, cands: DataFrame, key_cols=("event_id", "species", "pos"),
                    dr: float = 0.3, wrap: str = "legacy", pi_approx: float = PI_APPROX,
                    eta: str = "p_eta", phi: str = "p_phi", pt: str = "p_pt",
                    limit: int = 256, max_depth: int = 12, crowded: int = CROWDED, derive=None) -> DataFrame:
    """Same arguments and result as ``isolation``, for events whose particles may crowd in a cell.

    Sums of nodes are added in another order, so results agree to rounding. Candidates
    with a null or NaN position lie in no cone. Events of at most ``crowded`` rows are dealt
    by event, where their probes meet the candidates of small cells without being copied
    to four cells; of these events, only probes with a node in their event are.
    """
    if wrap not in ("legacy", "periodic"):
        raise ValueError(f"wrap must be 'legacy' or 'periodic', got {wrap!r}")
    cell, keys = 2.0 * dr * (1.0 + 1e-9), list(key_cols)
    period = 2.0 * (pi_approx if wrap == "legacy" else math.pi)
    cands = cands.where("NOT isnan(eta) AND NOT isnan(phi)")
    many = crowded_events(probes, cands, crowded)
    node, names = ["event_id", "_k", "ce", "cp"], list(MAP_SPECIES.values())
    sums = [F.sum(F.when(F.col("_cs") == s, F.col("_cpt"))).alias(n) for s, n in MAP_SPECIES.items()]
    outside, inside = _reach(dr, wrap)
    in_cone = cone_residual(dr, wrap, period)

    def in_cells(p: DataFrame) -> DataFrame:
        return probe_cells(derive(p) if derive else p, keys, cell, eta, phi)

    live, found, small = candidate_copies(cands, cell, wrap, period), [], None
    front = in_cells(probes.join(many, "event_id", "left_semi"))
    for depth in range(max_depth + 1):
        on = node if depth else [c for c in node if c != "_k"]      # probes meet every copy at first
        dense = live.groupBy(*node).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*node)
        dense = written(dense if depth < max_depth else dense.limit(0), "dense-cells")
        split = not dense.isEmpty()
        leaves = live.join(dense, node, "left_anti") if split else live
        if depth:
            found.append(front.join(leaves, on).where(in_cone).groupBy(*keys).agg(*sums))
        else:
            small = dense if split else None
            if not many.isEmpty():
                found.append(front.join(leaves.join(many, "event_id", "left_semi"), on).where(in_cone).groupBy(*keys).agg(*sums))
            front = in_cells(probes.join(dense.select("event_id").distinct(), "event_id", "left_semi"))
        if not split:
            break
        live = written(live.join(dense, node, "left_semi"), "dense-cands")
        hot = written(live.groupBy(*node).agg(F.min("_ce").alias("e0"), F.max("_ce").alias("e1"), F.min("_kphi").alias("p0"),
                                              F.max("_kphi").alias("p1"), *sums), "dense-nodes")
        met = front.join(hot, on).where(~outside)
        found.append(met.where(inside).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names]))
        children = F.array(*[F.struct((F.col("ce") * 2 + a).alias("_e"), (F.col("cp") * 2 + b).alias("_p")) for a in (0, 1) for b in (0, 1)])
        rest = [*keys, "_pe", "_pp", "_k"]
        front = met.where(~inside).select(*rest, F.inline(children)).select(*rest, F.col("_e").alias("ce"), F.col("_p").alias("cp"))
        front = written(front, "dense-probes")
        ce, cp = _cells(F.col("_ce"), F.col("_kphi"), cell / 2 ** (depth + 1))
        live = live.withColumns({"ce": ce, "cp": cp})

    # Events of few rows: the payload goes through the join and the sums, which stay by event.
    p, c = (df.join(many, "event_id", "left_anti").repartition("event_id") for df in (probes, cands))
    p = (derive(p) if derive else p).select(*probes.columns, F.col(eta).alias("_pe"), F.col(phi).alias("_pp"))
    c = candidate_copies(c, cell, wrap, period)
    if small is not None:       # at most crowded / limit cells an event
        own = small.join(many, "event_id", "left_anti").groupBy("event_id").agg(F.collect_list(F.struct("_k", "ce", "cp")).alias("_dense"))
        c = c.join(written(own, "dense-events"), "event_id", "left").where(
            F.col("_dense").isNull() | ~F.array_contains("_dense", F.struct("_k", "ce", "cp")))
    c = c.drop("_kphi", "ce", "cp", "_dense").withColumnRenamed("event_id", "_ev")
    payload = [x for x in probes.columns if x not in keys]
    out = p.join(c, (F.col("event_id") == F.col("_ev")) & in_cone, "left").groupBy(*keys).agg(*[F.first(x).alias(x) for x in payload], *sums)
    out = out.select(*probes.columns, *names)
    if found:
        total = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(*[F.sum(n).alias(f"_{n}") for n in names])
        out = out.unionByName(probes.join(many, "event_id", "left_semi").select("*", *[F.lit(0.0).alias(n) for n in names]))
        out = out.join(written(total, "dense-sums"), keys, "left")
        out = out.select(*probes.columns, *[(F.coalesce(n, F.lit(0.0)) + F.coalesce(f"_{n}", F.lit(0.0))).alias(n) for n in names])
    return _by_momentum(out, keys, pt, derive)
