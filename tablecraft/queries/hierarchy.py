"""Registered queries: trees, combinations, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import hierarchy as H
from tablecraft.plans.registry import query


def _staff(t):
    """Part keys as a staff tree: everyone leads up to three others."""
    return t.part.select(
        F.col("p_partkey").alias("name"), F.expr("CASE WHEN p_partkey > 0 THEN (p_partkey - 1) div 3 END").alias("manager"), "p_brand"
    )


# The keys run from 0 without a gap, so depth d of this tree starts at (3^d - 1) / 2 and a
# key's place in its depth, over powers of three, is the place of its ancestors in theirs.
@query(
    "rc1_descendants",
    """
    WITH deep AS (SELECT p_partkey AS name, max(d) AS d FROM part, range(0, 20) AS r(d)
                  WHERE (CAST(power(3, d) AS BIGINT) - 1) // 2 <= p_partkey GROUP BY p_partkey)
    SELECT name, CASE WHEN name > 0 THEN (name - 1) // 3 END AS manager, CAST(d + 1 AS INTEGER) AS generation,
           string_agg(CAST((CAST(power(3, j) AS BIGINT) - 1) // 2
             + (name - (CAST(power(3, d) AS BIGINT) - 1) // 2) // CAST(power(3, d - j) AS BIGINT) AS VARCHAR), '>' ORDER BY j) AS path
    FROM deep, range(0, 20) AS r(j) WHERE j <= d GROUP BY name, d
    """,
)
def descendants(t):
    return H.descendants(_staff(t), "name", "manager", 0)


@query(
    "rc2_hierarchy_levels",
    """
    WITH deep AS (SELECT p_partkey AS name, p_brand, max(k) AS k FROM part, range(1, 20) AS r(k)
                  WHERE (CAST(power(3, k) AS BIGINT) - 3) // 2 <= p_partkey GROUP BY ALL)
    SELECT name, CASE WHEN name >= 3 THEN name // 3 - 1 END AS manager, p_brand, CAST(k AS INTEGER) AS level FROM deep
    WHERE (name - (CAST(power(3, k) AS BIGINT) - 3) // 2) // CAST(power(3, k - 1) AS BIGINT) <> 1
    """,
)
def hierarchy_levels(t):
    """Three trees under the keys 0, 1 and 2, of which two are asked for."""
    forest = t.part.select(
        F.col("p_partkey").alias("name"), F.expr("CASE WHEN p_partkey >= 3 THEN p_partkey div 3 - 1 END").alias("manager"), "p_brand"
    )
    return H.hierarchy_levels(forest, "name", "manager", F.col("name") != 1)


@query(
    "rc3_combos",
    """
    WITH items AS (SELECT p_brand AS n, min(p_partkey) AS i FROM part GROUP BY p_brand)
    SELECT i AS item_id, n AS item_name, 1 AS depth, n AS combo FROM items
    UNION ALL SELECT a.i, b.n, 2, concat_ws(', ', a.n, b.n) FROM items a, items b
    UNION ALL SELECT a.i, c.n, 3, concat_ws(', ', a.n, b.n, c.n) FROM items a, items b, items c
    """,
)
def combos(t):
    items = t.part.groupBy(F.col("p_brand").alias("item_name")).agg(F.min("p_partkey").alias("item_id"))
    return H.combos(items, "item_id", "item_name", 3)


def _lanes(t):
    """Lanes between nations; a lane costs its line count."""
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nationkey")
    used = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).filter("c_nationkey <> s_nationkey")
    return used.groupBy(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b")).agg(F.count("*").alias("cost"))


# Best walks of each number of steps; there are 25 nations, so 24 steps reach all.
WALKS = """
    WITH RECURSIVE lanes AS (
      SELECT c_nationkey AS a, s_nationkey AS b, count(*) AS cost
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
      WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
    w AS (
      SELECT 0 AS hub, {'cost': CAST(0 AS BIGINT), 'way': [0]} AS best, 0 AS hops
      UNION ALL SELECT hub, best, hops FROM (
        SELECT b AS hub, min({'cost': best.cost + cost, 'way': list_append(best.way, b)}) AS best, max(hops) + 1 AS hops
        FROM w JOIN lanes ON hub = a WHERE hops < 24 GROUP BY b))
    SELECT CAST(hub AS INTEGER) AS hub, min(best).cost AS total_cost, array_to_string(min(best).way, '>') AS path FROM w GROUP BY hub
"""


def _shown(paths):
    return paths.withColumn("path", F.array_join(F.transform("path", lambda h: h.cast("string")), ">"))


@query("rc4_cheapest_paths", WALKS)
def cheapest_paths(t):
    return _shown(H.cheapest_paths(_lanes(t), "a", "b", "cost", 0))


@query("rc4_cheapest_path", f"SELECT * FROM ({WALKS}) WHERE hub = 24")
def cheapest_path(t):
    return _shown(H.cheapest_path(_lanes(t), "a", "b", "cost", 0, 24))
