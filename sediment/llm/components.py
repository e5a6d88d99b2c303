"""Connected components of a link table, by shared joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import discard, written


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node``, ``root`` for every node of ``links``; the root is the least node reachable.

    Each round takes the least root among the neighbours and then follows roots of roots, so long
    chains halve. Minima are folded before the shuffle, and joins on a hub read two written
    tables, whose hot keys adaptive execution splits. Links to NULL are ignored; repeated links
    and self links change nothing. Each round ends in a written table."""
    one = links.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    both = written(
        one.select(F.col(left).alias("src"), F.col(right).alias("dst"))
        .unionByName(one.select(F.col(right).alias("src"), F.col(left).alias("dst")))
        .distinct(),
        "links",
    )
    roots = written(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("src"), F.min("dst")).alias("root")), "roots")
    while True:
        heard = (
            both.join(roots.withColumnRenamed("node", "src"), "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("root").alias("heard"))
        )
        lower = written(
            roots.join(heard, "node").select("node", F.least("root", "heard").alias("root"), F.col("root").alias("before")),
            "lower",
        )
        jumped = written(
            lower.join(lower.select(F.col("node").alias("root"), F.col("root").alias("far")), "root").select(
                "node", F.least("root", "far").alias("root"), "before"
            ),
            "roots",
        )
        moved = jumped.filter("root <> before").limit(1).count()
        discard(roots)
        discard(lower)
        roots = jumped
        if not moved:
            discard(both)
            return roots.select("node", "root")


def contracted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (``node``, ``root``) after further ``links`` (``a``, ``b``): the links are taken between roots, and only
    those are followed. Nodes that ``roots`` lacks stand for themselves."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = links.join(left, "a", "left").join(right, "b", "left")
    between = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b")
    moved = components(between)
    kept = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    new = moved.join(roots.select("node"), "node", "left_anti")
    return written(kept.select("node", F.coalesce("to", "root").alias("root")).unionByName(new.select("node", "root")), "roots")
