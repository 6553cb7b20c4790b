"""Connected components of links in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.store import settled


def _star(links: DataFrame, u: str, v: str) -> DataFrame:
    """Every neighbour ``v`` of ``u`` and ``u`` itself linked to the smallest of them. Only the minimum is gathered."""
    least = links.groupBy(F.col(u).alias("at")).agg(F.min(v).alias("m")).select("at", F.least("at", "m").alias("m"))
    found = links.select(F.col(u).alias("at"), F.col(v).alias("other")).join(least, "at")
    own = least.select(F.col("at").alias("a"), F.col("m").alias("b"))
    return found.select(F.col("other").alias("a"), F.col("m").alias("b")).unionByName(own).where(F.col("a") != F.col("b")).distinct()


def _only_stars(links: DataFrame) -> bool:
    """Whether each ``a`` has one link, to a node that is no ``a``; links lead to the smaller node."""
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("at"), F.lit(True).alias("low")), F.struct(F.col("b").alias("at"), F.lit(False).alias("low")))))
    each = ends.groupBy("at").agg(F.count_if("low").alias("up"), F.count_if(~F.col("low")).alias("down"))
    return each.agg(F.count_if(F.expr("up > 1 or (up = 1 and down > 0)"))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b) but the roots; ``root`` is the smallest node of the component.

    Alternates two star steps: all larger neighbours of a node are linked to its smallest neighbour, then all smaller
    ones. The links stay as many as the nodes; the rounds grow with the logarithm of the longest chain and end as soon as every
    link leads from a node without another to a root.
    """
    links = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct())
    while not _only_stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["at"]).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settled(_star(large.where(F.col("a") != F.col("b")), "a", "b"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
