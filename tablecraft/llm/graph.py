"""Connected components of a link table, by rounds of hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.storage import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the least node of its component.

    A round lets every node point to its least neighbour, follows the pointers to
    their ends by doubling, and rewrites the links between the ends.  Every root
    that still has a link loses it to a smaller root or gains a child, so the links
    halve at least.  Each step is a grouping or an equi-join and its result is
    written to the shared folder; only counts come to the driver.
    """
    links = written(links.filter("a <> b").distinct(), "links")
    steps: list[DataFrame] = []
    while not links.isEmpty():
        pointers = written(
            _both_ways(links).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("root")),
            "pointers",
        )
        while True:
            jump = pointers.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            jumped = written(
                pointers.join(jump, "root")
                .select("node", F.col("_next").alias("root"), (F.col("_next") != F.col("root")).alias("_moved")),
                "jumped",
            )
            moved = not jumped.filter("_moved").isEmpty()
            pointers = jumped.drop("_moved")
            if not moved:
                break
        steps.append(pointers)
        at = lambda end: pointers.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        links = written(
            links.join(at("a"), "a").join(at("b"), "b")
            .select(F.col("_a").alias("a"), F.col("_b").alias("b")).filter("a <> b").distinct(),
            "links",
        )
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0]
    for step in steps[1:]:
        # Ends of later rounds are ends of the rounds before them.
        later = step.select(F.col("node").alias("root"), F.col("root").alias("_later"))
        out = out.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root"))
    return out
