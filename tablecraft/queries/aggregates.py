"""Registered queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import aggregates as A
from tablecraft.plans.registry import exact, mean_sql, query, rounded


@query(
    "ag1_group_agg",
    f"""
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total,
           round({mean_sql('o_totalprice')}, 4) AS average, min(o_totalprice) AS low, max(o_totalprice) AS high
    FROM orders GROUP BY o_orderstatus, o_orderpriority
    """,
)
def group_agg(t):
    p = F.col("o_totalprice")
    out = A.group_agg(
        t.orders, ["o_orderstatus", "o_orderpriority"],
        n=F.count("*"), total=F.sum(p), average=F.avg(p.cast("decimal(24,8)")), low=F.min(p), high=F.max(p),
    )
    return rounded(rounded(out, 2, "total"), 4, "average")


@query(
    "ag1_daily_average",
    f"SELECT CAST(ts AS DATE) AS date, round({mean_sql('value')}, 4) AS avg_value FROM events WHERE user_id = 1 GROUP BY 1",
    text=("date",),
)
def daily_average(t):
    days = exact(t.events, "value").filter("user_id = 1").withColumn("date", F.to_date("ts"))
    return rounded(A.group_agg(days, ["date"], avg_value=F.avg("value")), 4, "avg_value")


@query(
    "ag2_having",
    """
    SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders
    GROUP BY o_custkey HAVING sum(o_totalprice) > 3000000
    """,
)
def having(t):
    out = A.having(t.orders, ["o_custkey"], F.col("total") > 3000000, total=F.sum("o_totalprice"), n=F.count("*"))
    return rounded(out, 2, "total")


@query(
    "ag3_distinct_counts",
    """
    SELECT r_regionkey, r_name, count(DISTINCT n_nationkey) AS nations, count(DISTINCT c_custkey) AS customers,
           count(DISTINCT o_orderkey) AS orders, count(DISTINCT l_partkey) AS parts
    FROM region, nation, customer, orders, lineitem
    WHERE r_regionkey = n_regionkey AND n_nationkey = c_nationkey AND c_custkey = o_custkey AND o_orderkey = l_orderkey
    GROUP BY r_regionkey, r_name
    """,
)
def distinct_counts(t):
    chain = (
        t.lineitem.select("l_orderkey", "l_partkey")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return A.distinct_counts(
        chain, ["r_regionkey", "r_name"],
        {"nations": "n_nationkey", "customers": "c_custkey", "orders": "o_orderkey", "parts": "l_partkey"},
    )


@query("ag3_day_count", "SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS day_count FROM orders")
def day_count(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("day"))
    return A.distinct_counts(days, [], {"day_count": "day"})


@query(
    "ag4_group_by_ordinal",
    "SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2 ORDER BY 3 DESC",
)
def group_by_ordinal(t):
    return A.group_by_ordinal(t.customer, ["c_nationkey", "c_mktsegment"])


@query(
    "ag5_leaderboard",
    """
    SELECT o_custkey, c_name, round(sum(best), 2) AS total FROM customer JOIN (
      SELECT o_custkey, o_orderpriority, max(o_totalprice) AS best FROM orders GROUP BY 1, 2) ON o_custkey = c_custkey
    GROUP BY o_custkey, c_name HAVING sum(best) > 0
    """,
)
def leaderboard(t):
    out = A.leaderboard(t.orders, "o_custkey", "o_orderpriority", "o_totalprice", t.customer, "c_custkey", "c_name")
    return rounded(out, 2, "total")


PRIORITIES = {
    "urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "unspecified": "4-NOT SPECIFIED", "low": "5-LOW",
}


@query(
    "ag6_one_hot_counts",
    "SELECT o_custkey, "
    + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{v}') AS {n}" for n, v in PRIORITIES.items())
    + ", count(*) AS total FROM orders GROUP BY o_custkey",
)
def one_hot_counts(t):
    return A.one_hot_counts(t.orders, ["o_custkey"], "o_orderpriority", PRIORITIES)


@query(
    "ag6_pivot_fixed",
    """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
           count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
    FROM orders GROUP BY 1
    """,
)
def pivot_fixed(t):
    return A.pivot_fixed(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], F.count(F.lit(1)))


@query(
    "ag7_dynamic_pivot",
    """
    SELECT CAST(month(ts) AS INTEGER) AS month, count(*) FILTER (WHERE event_type = 'click') AS click,
           count(*) FILTER (WHERE event_type = 'error') AS error, count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
           count(*) FILTER (WHERE event_type = 'signup') AS signup, count(*) FILTER (WHERE event_type = 'view') AS view
    FROM events GROUP BY 1
    """,
)
def dynamic_pivot(t):
    return A.dynamic_pivot(t.events.withColumn("month", F.month("ts")), "month", "event_type", F.count(F.lit(1)))


PCT = "SELECT round(sum(CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS pct FROM lineitem"


@query("ag8_pct_where", PCT)
def pct_where(t):
    return rounded(A.pct_where(t.lineitem, F.col("l_extendedprice") > 50000), 6, "pct")


@query("ag8_pct_where_join", PCT)
def pct_where_join(t):
    return rounded(A.pct_where_join(t.lineitem, F.col("l_extendedprice") > 50000), 6, "pct")


@query(
    "ag9_ratio_of_totals",
    """
    SELECT c_nationkey, round(count(*) / CAST(count(DISTINCT c_custkey) AS DOUBLE), 6) AS avg_visits,
           round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT c_custkey), 4) AS avg_cost
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_nationkey
    """,
)
def ratio_of_totals(t):
    out = A.ratio_of_totals(t.customer, "c_nationkey", "c_custkey", exact(t.orders, "o_totalprice"), "o_custkey", "o_totalprice")
    return rounded(rounded(out, 6, "avg_visits"), 4, "avg_cost")


@query(
    "ag9_average_of_averages",
    """
    SELECT c_nationkey, round(avg(a), 4) AS avg_of_avg FROM customer JOIN (
      SELECT o_custkey, avg(o_totalprice) AS a FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1
    """,
)
def average_of_averages(t):
    out = A.average_of_averages(t.customer, "c_nationkey", "c_custkey", t.orders, "o_custkey", "o_totalprice")
    return rounded(out, 4, "avg_of_avg")


@query(
    "ag10_string_agg",
    """
    SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS listed FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 5000) GROUP BY r_name
    """,
)
def string_agg(t):
    rich = t.customer.filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("n_nationkey"))
    named = t.nation.join(rich, "n_nationkey", "left_semi").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return A.string_agg(named, ["r_name"], "n_name", ["n_name"])


@query(
    "ag10_string_agg_parts",
    """
    SELECT o_custkey, (rn - 1) // 4 AS part, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY rn) AS listed FROM (
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
    GROUP BY 1, 2
    """,
)
def string_agg_parts(t):
    return A.string_agg_parts(t.orders, ["o_custkey"], "o_orderkey", ["o_orderkey"], 4)


@query(
    "ag11_avg_null_aware",
    """
    SELECT round(avg(b), 4) AS avg_known, round(sum(b) / count(*), 4) AS avg_all FROM (
      SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS b FROM customer)
    """,
)
def avg_null_aware(t):
    holes = t.customer.select(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("b"))
    return rounded(A.avg_null_aware(holes, "b"), 4, "avg_known", "avg_all")


@query(
    "ag12_zero_key_error",
    """
    SELECT round(gap, 4) AS gap, CAST(ceil(gap) AS BIGINT) AS gap_up FROM (
      SELECT avg(b) - avg(TRY_CAST(nullif(replace(CAST(b AS VARCHAR), '0', ''), '') AS DOUBLE)) AS gap FROM (
        SELECT CAST(trunc(c_acctbal) AS INTEGER) AS b FROM customer))
    """,
)
def zero_key_error(t):
    return rounded(A.zero_key_error(t.customer.select(F.col("c_acctbal").cast("int").alias("b")), "b"), 4, "gap")


def _dated(t):
    return exact(t.orders, "o_totalprice").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderpriority", "o_totalprice"
    )


DATED = """
  (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority,
          o_totalprice FROM orders)
"""


@query(
    "ag13_rollup",
    f"""
    SELECT o_orderpriority, year, month, round({mean_sql('o_totalprice')}, 4) AS average, count(*) AS n,
           CAST(grouping_id(o_orderpriority, year, month) AS BIGINT) AS level
    FROM {DATED} GROUP BY ROLLUP(o_orderpriority, year, month)
    """,
)
def rollup(t):
    out = A.rollup_agg(_dated(t), ["o_orderpriority", "year", "month"], average=F.avg("o_totalprice"), n=F.count("*"))
    return rounded(out, 4, "average")


CUBE = f"""
  SELECT o_orderpriority, year, month, round({mean_sql('o_totalprice')}, 4) AS average, count(*) AS n,
         CAST(grouping_id(o_orderpriority, year, month) AS BIGINT) AS level
  FROM {DATED} GROUP BY CUBE(o_orderpriority, year, month)
"""


@query("ag14_cube", CUBE)
def cube(t):
    out = A.cube_agg(_dated(t), ["o_orderpriority", "year", "month"], average=F.avg("o_totalprice"), n=F.count("*"))
    return rounded(out, 4, "average")


@query("ag14_cube_by_rollups", CUBE)
def cube_by_rollups(t):
    out = A.cube_by_rollups(
        _dated(t), ["o_orderpriority", "year", "month"], "avg(o_totalprice) AS average, count(*) AS n"
    )
    return rounded(out, 4, "average")


PCTL = """
  SELECT event_type, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.99), 4) AS p99
  FROM events GROUP BY event_type
"""


@query("ag15_percentile_by", PCTL)
def percentile_by(t):
    return rounded(A.percentile_by(t.events, ["event_type"], "value", {"p50": 0.5, "p99": 0.99}), 4, "p50", "p99")


@query("ag15_percentile_cut", PCTL)
def percentile_cut(t):
    """The same numbers with every group treated as too large for one task."""
    out = A.percentile_by(t.events, ["event_type"], "value", {"p50": 0.5, "p99": 0.99}, max_rows=500)
    return rounded(out, 4, "p50", "p99")


@query(
    "ag16_spread_topk",
    """
    SELECT o_custkey, round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders
    GROUP BY o_custkey ORDER BY max(o_totalprice) - min(o_totalprice) DESC, o_custkey LIMIT 3
    """,
)
def spread_topk(t):
    return rounded(A.spread_topk(t.orders, ["o_custkey"], "o_totalprice", 3), 2, "spread")


@query(
    "ag17_dim_average",
    f"""
    SELECT c_mktsegment, round({mean_sql('o_totalprice')}, 4) AS average FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1
    """,
)
def dim_average(t):
    out = A.dim_average(exact(t.orders, "o_totalprice"), "o_custkey", "o_totalprice", t.customer, "c_custkey", "c_mktsegment")
    return rounded(out, 4, "average")


@query(
    "ag17_filtered_join_average",
    """
    SELECT round(avg(c_acctbal), 4) AS average FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE o_orderdate = TIMESTAMP '1998-10-03'
    """,
)
def filtered_join_average(t):
    out = A.filtered_join_average(
        t.customer, "c_custkey", "c_acctbal", t.orders, "o_custkey", F.to_date("o_orderdate") == F.lit("1998-10-03").cast("date")
    )
    return rounded(out, 4, "average")


@query(
    "ag18_revenue_by_item",
    """
    SELECT p_name, count(*) AS n_rows, round(sum(l_extendedprice), 2) AS revenue
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_name
    """,
)
def revenue_by_item(t):
    out = A.revenue_by_item(t.lineitem, "l_partkey", "l_extendedprice", t.part, "p_partkey", "p_name")
    return rounded(out, 2, "revenue")


@query(
    "ag18_count_by_customer",
    """
    SELECT c_name, c_mktsegment, count(o_orderkey) AS n_rows FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM') ON o_custkey = c_custkey
    GROUP BY c_name, c_mktsegment
    """,
)
def count_by_customer(t):
    some = t.orders.filter("o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM'")
    return A.count_by_customer(t.customer, "c_custkey", ["c_name", "c_mktsegment"], some, "o_custkey")


@query(
    "ag19_repeat_users",
    "SELECT count(*) AS users FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT CAST(ts AS DATE)) > 1)",
)
def repeat_users(t):
    return A.repeat_users(t.events, "user_id", "ts")


@query(
    "ag20_teaching_report",
    """
    SELECT p_type, l_partkey, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS enrollment
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey
    WHERE l_suppkey = 7 GROUP BY 1, 2, 3
    """,
)
def teaching_report(t):
    taught = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_suppkey", "l_partkey", "p_type", "l_orderkey", F.year("l_shipdate").alias("year")
    )
    taken = t.orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return A.teaching_report(F.col("l_suppkey") == 7, taught, taken, ["l_orderkey"], ["p_type", "l_partkey", "year"])


def _school(t):
    students = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("dept"))
    courses = t.supplier.select(
        F.col("s_suppkey").alias("course_id"), F.col("s_nationkey").alias("dept"),
        F.floor(F.abs("s_acctbal") / 1000).alias("credits"),
    )
    takes = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("id"), F.col("l_suppkey").alias("course_id")
    )
    return students, courses, takes


SCHOOL = """
  WITH student AS (SELECT c_custkey AS id, c_nationkey AS dept FROM customer),
  course AS (SELECT s_suppkey AS course_id, s_nationkey AS dept, CAST(floor(abs(s_acctbal) / 1000) AS BIGINT) AS credits FROM supplier),
  takes AS (SELECT o_custkey AS id, l_suppkey AS course_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


@query(
    "ag21_credits_of_department",
    SCHOOL + "SELECT id, CAST(sum(credits) AS BIGINT) AS credits FROM student JOIN course USING (dept) GROUP BY id ORDER BY id LIMIT 10",
)
def credits_of_department(t):
    return A.credit_totals(*_school(t), draft="department").orderBy("id").limit(10)


@query(
    "ag21_credits_rows",
    SCHOOL + """SELECT s.id, count(*) AS credits FROM student s, course c, takes k
    WHERE c.course_id = k.course_id AND k.id = s.id AND s.dept = c.dept GROUP BY s.id""",
)
def credits_rows(t):
    return A.credit_totals(*_school(t), draft="rows")


@query(
    "ag21_credits_taken",
    SCHOOL + """SELECT id, CAST((SELECT sum(credits) FROM course JOIN takes USING (course_id) WHERE takes.id = student.id) AS BIGINT)
    AS credits FROM student""",
)
def credits_taken(t):
    return A.credit_totals(*_school(t), draft="taken")
