"""URL filter: rules first, then a tree of path templates for each host.

A host's tree grows level by level, as deep as its paths. A segment with a digit is variable from the start; of the others, those
that hold fewer than ``LITERAL_ROWS`` pages of their node are generalised to ``*``, whatever their share. A node of fewer pages, or
of a single shape, is settled at once, so there are as many levels as two frequent paths of a host have in common. Sibling branches in order of their share of bad labels join the branch before
unless they differ from all labels that it has so far (two-proportion z-test); siblings of equal counts go together, those without
labels are a branch of their own. A branch is rejected if its smoothed share of bad labels, drawn towards its host's, that towards all
pages', and that towards none, reaches ``REJECT``.

Pages are counted by host and shape (path with digits generalised) before the tree is built, so the levels work on that much
smaller table; every level sums children with partial aggregation and joins them to their parents, no host is gathered.

Defined cases. A null url, or one without ``://``: empty host and path, judged by the method like any host. Pages without a
label count for the shapes only; null labels are not used, of repeated labels the bad one counts. No labels at all: the method
allows everything. Rows may repeat, ids may be null. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm.store import settled

#: Verdict and rule, in the order given: a rule is a host and the beginning of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
LITERAL_ROWS = 3
DIFFERENT_Z, SMOOTHING, REJECT = 1.96, 10.0, 0.6


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for then, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, start = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, then).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """The segments of a path, those with a digit as ``*``."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))


def templates(shapes: DataFrame, rows: int) -> DataFrame:
    """``host, shape, parent, template`` and counts, from ``host, shape, n, bad, good``."""
    own = ["host", "shape", "n", "bad", "good", "template"]
    open_, grown, level = shapes.withColumn("template", F.lit("")).select(*own), None, 0
    while True:
        ended = open_.where(F.size("shape") <= level).select(*own)
        grown = ended if grown is None else grown.unionByName(ended)
        open_ = open_.where(F.size("shape") > level).withColumn("segment", F.get("shape", F.lit(level)))
        children = open_.groupBy("host", "template", "segment")
        children = children.agg(F.sum("n").alias("in_child"), (F.min("shape") == F.max("shape")).alias("single"))
        nodes = children.groupBy("host", "template").agg(F.sum("in_child").alias("in_node"))
        children = settled(children.join(nodes.hint("merge"), ["host", "template"]))
        if children.isEmpty():
            break
        found = open_.join(children.hint("merge"), ["host", "template", "segment"])
        few, literal = F.col("in_node") < rows, F.col("in_child") >= rows
        rest = F.when(few, F.repeat(F.lit("/*"), F.size("shape") - level))
        rest = rest.when(literal & F.col("single"), F.concat(F.lit("/"), F.array_join(F.slice("shape", level + 1, F.size("shape")), "/")))
        rest = rest.otherwise(F.concat(F.lit("/"), F.when(literal, F.col("segment")).otherwise("*")))
        found = found.withColumn("template", F.concat("template", rest)).withColumn("closed", few | (literal & F.col("single")))
        found = settled(found.select(*own, "closed"))
        grown = grown.unionByName(found.where("closed").select(*own))
        open_, level = found.where(~F.col("closed")).select(*own), level + 1
    # The parent of /a/b/*/* is /a: wildcards at the end are the inside of the branch.
    parent = F.regexp_replace(F.regexp_replace("template", r"(/\*)+$", ""), r"/[^/]*$", "")
    return grown.withColumn("parent", parent)


def branches(grown: DataFrame, different_z: float, smoothing: float) -> DataFrame:
    """``host, parent, template, branch, purity``: similar siblings share a branch; ``purity`` is its share of bad labels."""
    sums = [F.sum("bad").alias("bad"), F.sum("good").alias("good")]
    own = settled(grown.groupBy("host", "parent", "template").agg(*sums))
    total = own.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("b"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")).first()
    prior = total["b"] / (total["b"] + total["g"] + smoothing)
    hosts = own.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum(F.col("bad") + F.col("good")).alias("host_all"))
    host_share = (F.col("host_bad") + smoothing * prior) / (F.col("host_all") + smoothing)
    hosts = settled(hosts.select("host", host_share.alias("host_share")))
    # Siblings of equal counts are one step, so a node's steps are far fewer than its children.
    labelled = F.col("bad") + F.col("good") > 0
    steps = own.where(labelled).groupBy("host", "parent", "bad", "good").agg(F.count(F.lit(1)).alias("m"))
    steps = steps.groupBy("host", "parent").agg(F.array_sort(F.collect_list(F.struct(((F.col("bad") + 1) / (F.col("bad") + F.col("good") + 2)).alias("share"), "bad", "good", "m"))).alias("steps"))

    def add(state: Column, step: Column) -> Column:
        x, n = step["bad"] + 1, step["bad"] + step["good"] + 2
        x0, n0 = state["bad"] + 1, state["bad"] + state["good"] + 2
        pooled = (x + x0) / (n + n0)
        z = F.abs(x / n - x0 / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / n0))
        new = (state["bad"] + state["good"] > 0) & (z >= different_z)
        no = state["no"] + F.when(new, 1).otherwise(0)
        sums = [(F.when(new, F.lit(0).cast("long")).otherwise(state[c]) + step[c] * step["m"]).alias(c) for c in ("bad", "good")]
        placed = F.struct(step["bad"].alias("bad"), step["good"].alias("good"), step["m"].alias("m"), no.alias("no"))
        return F.struct(no.alias("no"), *sums, F.concat(state["placed"], F.array(placed)).alias("placed"))

    start = "named_struct('no', 0, 'bad', 0L, 'good', 0L, 'placed', cast(array() as array<struct<bad:bigint,good:bigint,m:bigint,no:int>>))"
    steps = steps.select("host", "parent", F.inline(F.aggregate("steps", F.expr(start), add)["placed"]))
    steps = settled(steps.withColumn("branch", F.concat("parent", F.lit("/~"), F.col("no").cast("string"))).drop("no"))
    merged = steps.groupBy("host", "parent", "branch").agg(F.sum(F.col("bad") * F.col("m")).alias("b"), F.sum(F.col("good") * F.col("m")).alias("g"))
    purity = (F.col("b") + smoothing * F.col("host_share")) / (F.col("b") + F.col("g") + smoothing)
    merged = merged.join(hosts, "host").select("host", "parent", "branch", purity.alias("purity"))
    decided = settled(steps.drop("m").join(merged, ["host", "parent", "branch"]))
    known = own.where(labelled).join(decided.hint("merge"), ["host", "parent", "bad", "good"])
    unknown = own.where(~labelled).join(hosts.hint("merge"), "host").withColumn("branch", F.concat("parent", F.lit("/~"))).withColumn("purity", F.col("host_share"))
    columns = ["host", "parent", "template", "branch", "purity"]
    return known.select(*columns).unionByName(unknown.select(*columns))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    literal_rows: int = LITERAL_ROWS,
    different_z: float = DIFFERENT_Z,
    smoothing: float = SMOOTHING,
    reject: float = REJECT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, branch, purity`` for every row of ``pages`` (page_id, url).

    ``labels`` has ``page_id, bad`` (boolean).
    """
    known = labels.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).join(known, "page_id", "left")
    rows = settled(judged.withColumn("shape", shape_of(F.col("path"))))
    counts = [F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")]
    grown = settled(templates(settled(rows.groupBy("host", "shape").agg(*counts)), literal_rows))
    decided = branches(grown, different_z, smoothing)
    by_shape = settled(grown.select("host", "shape", "parent", "template").join(decided, ["host", "parent", "template"]).drop("parent"))
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    found = rows.select("page_id", "host", "path", "shape").join(by_shape, ["host", "shape"])
    return found.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "branch", "purity"
    )
