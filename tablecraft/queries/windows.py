"""Registered queries: window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import windows as V
from tablecraft.plans.ordered import last_known, order_of
from tablecraft.plans.registry import exact, mean_sql, query, rounded


@query(
    "wn1_rank_all",
    """
    SELECT p_partkey, p_size, CAST(row_number() OVER (ORDER BY p_size, p_partkey) AS INTEGER) AS row_number,
           CAST(rank() OVER (ORDER BY p_size) AS INTEGER) AS rank,
           CAST(dense_rank() OVER (ORDER BY p_size) AS INTEGER) AS dense_rank FROM part
    """,
)
def rank_all(t):
    out = V.rank_all(t.part.select("p_partkey", "p_size"), ["p_size"], ["p_partkey"])
    return out.withColumns({c: F.col(c).cast("int") for c in ("row_number", "rank", "dense_rank")})


@query(
    "wn1_rank_text_cut",
    """
    SELECT p_partkey, p_name, CAST(row_number() OVER (ORDER BY p_name DESC, p_partkey) AS INTEGER) AS row_number,
           CAST(rank() OVER (ORDER BY p_name DESC) AS INTEGER) AS rank,
           CAST(dense_rank() OVER (ORDER BY p_name DESC) AS INTEGER) AS dense_rank FROM part
    """,
)
def rank_text_cut(t):
    """The whole table is one group, cut along names that share long beginnings."""
    out = V.rank_all(t.part.select("p_partkey", "p_name"), ["-p_name"], ["p_partkey"], max_rows=150)
    return out.withColumns({c: F.col(c).cast("int") for c in ("row_number", "rank", "dense_rank")})


@query(
    "wn2_dense_rank_by",
    """
    SELECT s_suppkey, s_nationkey, s_acctbal,
           CAST(dense_rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS INTEGER) AS dense_rank FROM supplier
    """,
)
def dense_rank_by(t):
    out = V.dense_rank_by(t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"), ["s_nationkey"], ["-s_acctbal"])
    return out.withColumn("dense_rank", F.col("dense_rank").cast("int"))


@query(
    "wn3_rank_of_agg",
    """
    SELECT o_custkey, CAST(rank() OVER (ORDER BY max(o_totalprice) DESC) AS BIGINT) AS ranking FROM orders GROUP BY o_custkey
    """,
)
def rank_of_agg(t):
    out = V.rank_of_agg(t.orders, ["o_custkey"], F.max("o_totalprice"))
    return out.withColumn("ranking", F.col("ranking").cast("long"))


@query(
    "wn4_top_n_rank",
    """
    SELECT * FROM (SELECT l_suppkey, l_orderkey, l_extendedprice,
      CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS INTEGER) AS rank FROM lineitem
      WHERE l_extendedprice IS NOT NULL) WHERE rank <= 5
    """,
)
def top_n_rank(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_extendedprice")
    return V.top_n_rank(lines, ["l_suppkey"], ["-l_extendedprice"], 5)


BRANDS = """
  SELECT p_type, p_brand, round(sum(p_retailprice) / 1000) * 1000 AS revenue,
         CAST(row_number() OVER (PARTITION BY p_type ORDER BY round(sum(p_retailprice), 2) DESC, p_brand) AS INTEGER) AS rn
  FROM part GROUP BY p_type, p_brand
"""


def _brands(t):
    return t.part.groupBy("p_type", "p_brand").agg(F.round(F.sum("p_retailprice"), 2).alias("total"))


@query("wn5_number_rows", BRANDS)
def number_rows(t):
    out = V.number_rows(_brands(t), ["p_type"], ["-total", "p_brand"])
    return out.select("p_type", "p_brand", F.round("total", -3).alias("revenue"), F.col("rn").cast("int").alias("rn"))


@query("wn5_top_n_rows", f"SELECT * FROM ({BRANDS}) WHERE rn <= 2")
def top_n_rows(t):
    out = V.top_n_rows(_brands(t), ["p_type"], ["-total", "p_brand"], 2)
    return out.select("p_type", "p_brand", F.round("total", -3).alias("revenue"), "rn")


@query(
    "wn6_decile",
    "SELECT c_custkey, c_acctbal, CAST(ntile(10) OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS decile FROM customer",
)
def decile(t):
    return V.decile(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"])


@query(
    "wn6_decile_cut",
    "SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS decile FROM orders",
)
def decile_cut(t):
    """The whole table as one group too large for one task."""
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return V.decile(orders, ["o_totalprice", "o_orderkey"], max_rows=2_000).select("o_orderkey", "decile")


@query("wn6_decile_approx", "SELECT CAST(d AS INTEGER) AS decile, TRUE AS size_in_tolerance, TRUE AS edge_in_tolerance FROM range(1, 11) AS r(d)")
def decile_approx(t):
    """Both the size of each decile and the rank of its upper edge are right within the stated error."""
    error = 0.001
    placed = V.decile_approx(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", error=error)
    ranked = V.rank_all(placed, ["c_acctbal"], ["c_custkey"])
    n = t.customer.agg(F.count("*").alias("n")).scalar()
    return ranked.groupBy("decile").agg(F.count("*").alias("n"), F.max("row_number").alias("edge")).select(
        "decile", (F.abs(F.col("n") - n / 10) <= 2 * error * n + 2).alias("size_in_tolerance"),
        (F.abs(F.col("edge") - F.col("decile") * n / 10) <= error * n + 2).alias("edge_in_tolerance"),
    )


@query(
    "wn7_lag_features",
    """
    SELECT event_id, user_id, event_type, lag(event_type, 1) OVER w AS prev_1, lag(event_type, 2) OVER w AS prev_2
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    """,
)
def lag_features(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    return V.lag_features(rows, ["user_id"], ["ts"], "event_type", [1, 2]).drop("ts")


@query(
    "wn7_lead_features",
    """
    SELECT event_id, lead(value, 1) OVER w AS next_1, lead(value, 2) OVER w AS next_2
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)
    """,
)
def lead_features(t):
    """Five groups, each cut into 500-row blocks."""
    rows = t.events.select("event_id", "event_type", "ts", "value")
    out = V.lead_features(rows, ["event_type"], ["ts"], "value", [1, 2], max_rows=500)
    return out.select("event_id", "next_1", "next_2")


MONTHLY = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1"


@query(
    "wn8_pct_change",
    f"""
    SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS previous, lead(revenue) OVER (ORDER BY month) AS following,
           round((revenue - lag(revenue) OVER (ORDER BY month)) / lag(revenue) OVER (ORDER BY month), 6) AS change_back,
           round((lead(revenue) OVER (ORDER BY month) - revenue) / revenue, 6) AS change_ahead
    FROM ({MONTHLY})
    """,
    text=("month",),
)
def pct_change(t):
    months = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )
    # one row per calendar month
    return rounded(V.pct_change(months, ["month"], "revenue", max_rows=None), 6, "change_back", "change_ahead")


@query(
    "wn9_days_between_rows",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, lag(o_orderdate) OVER w AS previous_o_orderdate,
           lag(o_totalprice) OVER w AS previous_o_totalprice,
           CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS INTEGER) AS days_between
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
)
def days_between_rows(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return V.days_between_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", ["o_totalprice"])


@query(
    "wn10_first_last_value",
    """
    SELECT year, revenue, first_value(revenue) OVER (ORDER BY year) AS first_revenue,
           last_value(revenue) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_revenue
    FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1)
    """,
)
def first_last_value(t):
    years = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    return V.first_last_value(years, "year", "revenue")


@query(
    "wn11_avg_over",
    f"""
    SELECT s_suppkey, s_nationkey, s_acctbal, round({mean_sql('s_acctbal', 'OVER (PARTITION BY s_nationkey)')}, 4) AS average FROM supplier
    """,
)
def avg_over(t):
    suppliers = exact(t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"), "s_acctbal")
    out = V.avg_over(suppliers, ["s_nationkey"], "s_acctbal").withColumn("s_acctbal", F.col("s_acctbal").cast("double"))
    return rounded(out, 4, "average").orderBy("s_nationkey", "s_acctbal")


@query(
    "wn11_avg_over_all",
    "SELECT o_orderkey, o_totalprice, round(avg(o_totalprice) OVER (), 4) AS average FROM orders WHERE o_orderstatus = 'F'",
)
def avg_over_all(t):
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    return rounded(V.avg_over(done, [], "o_totalprice"), 4, "average")


@query(
    "wn12_avg_of_sum",
    """
    SELECT c_custkey, c_nationkey, round(sum(o_totalprice), 2) AS total,
           round(CAST(sum(sum(CAST(round(o_totalprice * 100) AS BIGINT))) OVER (PARTITION BY c_nationkey) AS DOUBLE)
                 / (count(*) OVER (PARTITION BY c_nationkey) * 100), 4) AS average_total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey
    """,
)
def avg_of_sum(t):
    spent = exact(t.orders, "o_totalprice").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").cast("decimal(24,8)").alias("spent")
    )
    rows = spent.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    out = V.avg_of_sum(rows, ["c_custkey", "c_nationkey"], ["c_nationkey"], "spent")
    return rounded(rounded(out, 2, "total"), 4, "average_total")


@query(
    "wn13_pct_of_total",
    """
    SELECT month, o_orderpriority, n, CAST(sum(n) OVER (PARTITION BY month) AS BIGINT) AS part_total,
           round(n / sum(n) OVER (PARTITION BY month) * 100, 6) AS pct
    FROM (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
    """,
)
def pct_of_total(t):
    rows = t.orders.select(F.month("o_orderdate").alias("month"), "o_orderpriority")
    return rounded(V.pct_of_total(rows, ["month"], ["o_orderpriority"]), 6, "pct")


@query(
    "wn14_running_total_range",
    """
    SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), 2) AS running_total
    FROM orders
    """,
)
def running_total_range(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = V.running_total_range(rows, ["o_custkey"], ["o_orderdate"], "o_totalprice")
    return rounded(out, 2, "running_total").drop("o_orderdate", "o_totalprice")


@query(
    "wn15_running_total_rows",
    """
    SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM events
    """,
)
def running_total_rows(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = V.running_total_rows(rows, ["user_id"], ["ts"], "value")
    return rounded(out, 2, "running_total").drop("ts", "value")


@query(
    "wn15_running_total_context",
    """
    SELECT o_orderkey, custkey, priority, round(sum(o_totalprice) OVER (PARTITION BY custkey, priority
      ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total
    FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS custkey,
          coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, 'UNKNOWN') AS priority FROM orders)
    """,
)
def running_total_context(t):
    rows = t.orders.select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.col("o_custkey").alias("custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
    )
    out = V.running_total_rows(
        rows, ["custkey", "priority"], ["o_orderdate", "o_orderkey"], "o_totalprice", unknown="UNKNOWN"
    )
    return rounded(out, 2, "running_total").drop("o_orderdate", "o_totalprice")


@query(
    "wn15_running_total_cut",
    """
    SELECT event_id, event_type, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM events
    """,
)
def running_total_cut(t):
    """Five groups, each cut into pieces that are carried over."""
    rows = t.events.select("event_id", "event_type", "ts", "value")
    out = V.running_total_rows(rows, ["event_type"], ["ts"], "value", max_rows=500)
    return rounded(out, 2, "running_total").drop("ts", "value")


@query(
    "wn15_running_ties_cut",
    """
    SELECT event_id, round(sum(value) OVER (ORDER BY event_type <> 'error', event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM events
    """,
)
def running_ties_cut(t):
    """One value of the first order column holds most rows."""
    rows = t.events.select("event_id", (F.col("event_type") != "error").alias("calm"), "value")
    out = V.running_total_rows(rows, [], ["calm", "event_id"], "value", max_rows=500)
    return rounded(out, 2, "running_total").drop("calm", "value")


@query(
    "wn9_last_known_wide_cut",
    """
    WITH w AS (SELECT event_id, CASE WHEN event_id % 40 <> 0 THEN 1152921504606846976 + event_id * 7919 % 10007 END AS wide,
                      CASE WHEN event_id % 7 = 0 THEN value END AS seen FROM events)
    SELECT event_id, wide, last_value(seen IGNORE NULLS) OVER (ORDER BY wide DESC NULLS LAST, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_seen FROM w
    """,
)
def last_known_wide_cut(t):
    """Keys that differ only beyond the 53 bits of a double, some of them NULL."""
    rows = t.events.select(
        "event_id",
        F.expr("CASE WHEN event_id % 40 <> 0 THEN 1152921504606846976 + event_id * 7919 % 10007 END").alias("wide"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN value END").alias("seen"),
    )
    return last_known(rows, [], order_of("-wide", "event_id"), {"last_seen": "seen"}, max_rows=500).drop("seen")


@query(
    "wn16_daily_then_cumulative",
    """
    SELECT user_id, day, round(day_total, 2) AS day_total, round(sum(day_total) OVER (PARTITION BY user_id ORDER BY day
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative
    FROM (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS day_total FROM events GROUP BY 1, 2)
    """,
    text=("day",),
)
def daily_then_cumulative(t):
    return rounded(V.daily_then_cumulative(t.events, ["user_id"], "ts", "value"), 2, "day_total", "cumulative")


FRAMES = {"back_2": (2, 0), "ahead_2": (0, 2), "around_2": (2, 2), "back_6": (6, 0), "back_30": (30, 0)}


@query(
    "wn17_moving_avg",
    "SELECT event_id, "
    + ", ".join(
        f"round(avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN {b} PRECEDING AND {a} FOLLOWING), 6) AS {n}"
        for n, (b, a) in FRAMES.items()
    )
    + " FROM events",
)
def moving_avg(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = V.moving_avgs(rows, ["user_id"], ["ts"], "value", FRAMES)
    return rounded(out, 6, *FRAMES).drop("user_id", "ts", "value")


@query(
    "wn18_rolling_sums",
    """
    SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 100 PRECEDING AND CURRENT ROW), 2) AS rolling_rows,
           round(sum(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW), 2) AS rolling_time
    FROM events
    """,
)
def rolling_sums(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = V.rolling_sums(rows, ["user_id"], "ts", "value", 100, 86_400)
    return rounded(out, 2, "rolling_rows", "rolling_time").select("event_id", "rolling_rows", "rolling_time")


@query(
    "wn18_rolling_time_cut",
    """
    SELECT event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts
      RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW), 2) AS rolling_time FROM events
    """,
)
def rolling_time_cut(t):
    rows = t.events.select("event_id", "event_type", "ts", "value")
    out = V.rolling_sum_time(rows, ["event_type"], "ts", "value", 86_400, max_rows=500)
    return rounded(out, 2, "rolling_time").select("event_id", "rolling_time")


@query(
    "wn19_event_distance",
    """
    SELECT event_id, last_event_ts, next_event_ts, (epoch_us(ts) - epoch_us(last_event_ts)) / 1e6 AS seconds_since_last,
           (epoch_us(next_event_ts) - epoch_us(ts)) / 1e6 AS seconds_until_next FROM (
      SELECT event_id, ts, last_value(CASE WHEN event_type = 'error' THEN ts END IGNORE NULLS) OVER
               (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_event_ts,
             first_value(CASE WHEN event_type = 'error' THEN ts END IGNORE NULLS) OVER
               (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_event_ts
      FROM events)
    """,
)
def event_distance(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    out = V.event_distance(rows, ["user_id"], "ts", F.col("event_type") == "error")
    return out.drop("user_id", "ts", "event_type")


@query(
    "wn20_median_over",
    "SELECT event_id, value, round(quantile_cont(value, 0.5) OVER (PARTITION BY event_type), 4) AS median FROM events",
)
def median_over(t):
    out = V.median_over(t.events.select("event_id", "event_type", "value"), ["event_type"], "value")
    return rounded(out, 4, "median").drop("event_type")


@query("wn21_partition_skew", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id HAVING count(*) > 80")
def partition_skew(t):
    return V.partition_skew(t.events, ["user_id"], 80)


@query(
    "wn21_duplicate_order_keys",
    """
    SELECT o_orderdate, count(*) AS cnt FROM orders GROUP BY o_orderdate HAVING count(*) > 1
    ORDER BY cnt DESC, o_orderdate LIMIT 50
    """,
)
def duplicate_order_keys(t):
    return V.duplicate_order_keys(t.orders, ["o_orderdate"])
