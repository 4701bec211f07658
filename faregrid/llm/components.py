"""Connected components of an edge table, each labelled with its smallest node.

Large and small stars in turn: every node hands its larger neighbours, then its
smaller ones, to the smallest it knows, until only stars are left. Stars are made with an
aggregation and a join, so a node of any degree is split by map-side sums and by the
skew handling of the join; nothing is gathered into lists. Each round is written to
the shared folder, which cuts the lineage with files that outlive executors.

The driver keeps a record of every task of a round, so rounds are few: edges that are stars
already need none, and ``grown`` adds edges to known components by their labels alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("low", "high")).toDF("node", "other")
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    return (
        both.filter(F.col("other") > F.col("node"))
        .join(least, "node")
        .select(F.col("other").alias("high"), F.col("least").alias("low"))
    )  # repeats go when the small stars are made distinct


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    passed = (
        edges.join(least, "high")
        .filter(F.col("low") != F.col("least"))
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
    )
    return passed.union(least.select("high", F.col("least").alias("low"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every ``high`` has one ``low``, and none of these is a ``high`` itself."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("low", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 OR (up = 1 AND down = 1)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` for every node of ``edges`` (two columns, any order).

    Self-links and null ends are ignored; nodes without a link do not appear.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = staged(
        edges.filter(a != b)
        .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .distinct(),
        "links",
    )
    while not _stars(now):
        now = staged(_small_star(_large_star(now)), "stars")
    leaves = now.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return leaves.union(roots)


def grown(found: DataFrame, edges: DataFrame) -> DataFrame:
    """``found``, the result of ``components`` for earlier edges, as it is with ``edges`` as well."""
    if edges.isEmpty():
        return found
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    rooted = edges.select(a.alias("_a"), b.alias("_b"))
    for end in ("_a", "_b"):
        rooted = rooted.join(found, F.col(end) == F.col("node"), "left").select(
            *[F.coalesce("component", c).alias(c) if c == end else c for c in ("_a", "_b")]
        )
    merged = staged(components(rooted), "merged")
    own = merged.select(F.col("node").alias("_root"), F.col("component").alias("_least"))
    known = found.join(own, F.col("component") == F.col("_root"), "left").select(
        "node", F.coalesce("_least", "component").alias("component")
    )
    return staged(known.union(merged.join(found.select("node"), "node", "left_anti")), "components")
