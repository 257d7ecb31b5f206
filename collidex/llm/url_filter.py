"""Operator 3: URL filter with fixed rules and a path-template tree.

Pages that a rule judges are the labelled rows. Per host, a tree over path segments
is built level by level, as deep as the paths: a numeric or hexadecimal segment becomes
a wildcard, and sibling branches whose share of blocked pages does not differ
significantly from that of all siblings are merged, however many they are. The resulting
templates are judged by their smoothed purity, the share of blocked among labelled
pages, drawn towards that of the same path shape at the parent domain and over all
pages. Templates above ``reject`` are blocked. Branches without a labelled page are
not merged with labelled ones: nothing is known about their likeness. More than
``max_children`` of them are one ``?``, which changes names of templates, no verdict.

The tree is a radix tree: a chain of segments without a branch is passed in one round,
so rounds follow branchings and not the depth of paths.

Pages are first counted by host and path shape, so a host with a third of all pages
is a handful of rows in every later step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import Parts, saved, table

#: (verdict, host/path)
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def split_url(url: str) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a column; both empty for a null url or one without ``://``."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _by_rules(rules) -> tuple[F.Column, F.Column]:
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):       # the longest is asked last and wins
        h, _, p = r.partition("/")
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) & F.startswith(F.col("path"), F.lit("/" + p))
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _shape(path) -> F.Column:
    """Segments of a path, with numbers and hexadecimal names replaced by their kind."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.regexp_replace(
        F.regexp_replace(s, r"^[0-9]+(?=\.|$)", "<n>"), r"^(?=[^.]*[0-9])[0-9a-f-]{8,}(?=\.|$)", "<x>"))


def _purity(blocked, labelled, prior, weight: float) -> F.Column:
    return (F.coalesce(blocked, F.lit(0)) + weight * prior) / (F.coalesce(labelled, F.lit(0)) + weight)


def _common(a, b) -> F.Column:
    """Number of segments that two arrays share at their start."""
    n = F.least(F.size(a), F.size(b))
    first = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False).cast("int")
    return F.when(first > 0, first - 1).otherwise(n)


def _templates(live: DataFrame, max_children: int, z: float) -> DataFrame:
    """``live`` with the template of each path; on the way, ``seg`` holds the segments still to be placed."""
    columns, rounds, more = live.columns, Parts(live.sparkSession, "url-tree"), True
    while more:
        # All paths of a branch follow its last one up to the first fork; those that end before it are done.
        spine = live.groupBy("host", "template").agg(F.max("seg").alias("spine"))
        near = live.join(spine, ["host", "template"]).withColumn("along", _common(F.col("seg"), F.col("spine")))
        near = saved(near.withColumn("forks", F.col("along") < F.size("seg")), "url-spine")
        fork = near.filter("forks").groupBy("host", "template").agg(F.min("along").alias("fork"))
        near = near.join(fork, ["host", "template"], "left")
        ended = F.col("fork").isNull() | (F.size("seg") <= F.col("fork"))
        done = near.filter(ended).withColumn("template", F.concat("template", F.lit("/"), F.array_join("seg", "/")))
        s = F.get("seg", F.col("fork"))
        rest = near.filter(~ended).withColumn("s", s)
        child = rest.groupBy("host", "template", "s").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.count("*").alias("leaves"))
        kin = child.groupBy("host", "template").agg(F.count("*").alias("children"), F.count_if(F.col("l") == 0).alias("unlabelled"),
                                                    F.sum("l").alias("kl"), F.sum("b").alias("kb"))
        share = F.col("kb") / F.greatest("kl", F.lit(1))
        spread = F.sqrt(share * (1 - share) / F.greatest("l", F.lit(1)))
        alike = F.abs(F.col("b") / F.greatest("l", F.lit(1)) - share) <= z * spread + 1e-9
        branch = (child.join(kin, ["host", "template"])
                       .select("host", "template", "s", F.when((F.col("l") > 0) & (F.col("children") > 1) & alike, "*")
                               .when((F.col("l") == 0) & (F.col("unlabelled") > max_children), "?").otherwise(F.col("s")).alias("branch")))
        passed = F.concat(F.slice("seg", F.lit(1), F.col("fork")), F.array("branch"))
        step = (rest.join(branch, ["host", "template", "s"])
                    .withColumn("template", F.concat("template", F.lit("/"), F.array_join(passed, "/")))
                    .withColumn("seg", F.slice("seg", F.col("fork") + 2, F.size("seg"))))
        step = done.withColumn("seg", F.slice("seg", 1, 0)).select(*columns).unionByName(step.select(*columns))
        live = rounds.add(step).filter("size(seg) > 0")
        more = not live.isEmpty()
    return rounds.all().filter("size(seg) = 0")


def url_filter(pages: DataFrame, rules=RULES, max_children: int = 20, z: float = 2.0,
               weight: float = 4.0, reject: float = 0.9) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict, template, purity``.

    The longest fitting rule decides; where none fits, ``rule`` is null and the template
    decides. Each branching of the tree is one round, over the paths that still share their
    template with others. Null urls have empty host and path, no template evidence, and are allowed.
    Null ids and repeated rows each give a row, other columns are not read, and without
    any page or any labelled page all is allowed that no rule blocks.
    """
    p = pages.select("page_id", F.col("url").cast("string").alias("_url"))
    host, path = split_url("_url")
    p = p.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = _by_rules(rules)
    p = saved(p.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("shape", F.array_join(_shape(F.col("path")), "/")), "urls")

    leaf = p.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("ruled").alias("labelled"),
                                          F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("blocked"))
    live = saved(leaf.withColumn("seg", F.split("shape", "/")).withColumn("template", F.lit("")), "url-leaves")
    tree = _templates(live, max_children, z)
    domain = F.substring_index("host", ".", -2)
    l0, b0 = tree.agg(F.sum("labelled"), F.sum("blocked")).first()       # two numbers
    tree = tree.withColumn("domain", domain)

    def stats(i, *keys):
        return tree.groupBy(*keys).agg(F.sum("labelled").alias(f"l{i}"), F.sum("blocked").alias(f"b{i}"))

    judged = (tree.select("host", "domain", "shape", "template")
                  .join(stats(1, "domain", "shape"), ["domain", "shape"])
                  .join(stats(2, "host", "template"), ["host", "template"]))
    prior = F.least(_purity(F.lit(b0), F.lit(l0), F.lit(0.0), weight), F.lit(0.5))      # alone, it rejects nothing
    for i in (1, 2):
        prior = _purity(F.col(f"b{i}"), F.col(f"l{i}"), prior, weight)
    judged = saved(judged.select("host", "shape", F.concat("host", "template").alias("template"), prior.alias("purity")), "url-templates")
    return (p.join(judged, ["host", "shape"], "left")
             .select("page_id", "host", "path", "rule",
                     F.coalesce("ruled", F.when(F.col("purity") > reject, "block").otherwise("allow")).alias("verdict"), "template", "purity"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))
