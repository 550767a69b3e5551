"""Registered queries: statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import stats as S
from tablecraft.plans.registry import exact, mean_sql, query, rounded


@query(
    "ml1_ols_manual",
    """
    SELECT round(sum((x - xm) * (y - ym)) / sum((x - xm) * (x - xm)), 4) AS slope,
           round(max(ym) - max(xm) * sum((x - xm) * (y - ym)) / sum((x - xm) * (x - xm)), 4) AS intercept
    FROM (SELECT l_quantity AS x, l_extendedprice AS y, avg(l_quantity) OVER () AS xm, avg(l_extendedprice) OVER () AS ym FROM lineitem)
    """,
)
def ols_manual(t):
    return rounded(S.ols_manual(t.lineitem, "l_quantity", "l_extendedprice"), 4, "slope", "intercept")


@query(
    "ml2_ols_predict",
    """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS y FROM lineitem),
    f AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM d WHERE y IS NOT NULL)
    SELECT l_orderkey, l_linenumber, x, round(x * s + i, 4) AS prediction FROM d CROSS JOIN f WHERE y IS NULL
    """,
)
def ols_predict(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("y"),
    )
    return rounded(S.ols_predict(rows, "x", "y"), 4, "prediction").drop("y")


DAILY = """
  SELECT day, CAST(date_diff('day', min(day) OVER (), day) AS INTEGER) AS day_number, orders,
         CAST(sum(orders) OVER (ORDER BY day) AS BIGINT) AS cumulative_orders
  FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
"""


@query(
    "ml3_trend_line",
    f"""
    WITH d AS ({DAILY}), f AS (SELECT regr_slope(cumulative_orders, day_number) AS s, regr_intercept(cumulative_orders, day_number) AS i FROM d)
    SELECT day, cumulative_orders, round(day_number * s + i, 4) AS y_predicted, round((day_number + 1) * s + i, 4) AS next_y_predicted
    FROM d CROSS JOIN f
    """,
    text=("day",),
)
def trend_line(t):
    # one row per calendar day
    days = S.daily_cumulative(t.orders, "o_orderdate", max_rows=None)
    out = S.trend_line(days, "day_number", "cumulative_orders")
    return rounded(out, 4, "y_predicted", "next_y_predicted").select(
        "day", "cumulative_orders", "y_predicted", "next_y_predicted"
    )


@query("ml4_daily_cumulative", DAILY, text=("day",))
def daily_cumulative(t):
    return S.daily_cumulative(t.orders, "o_orderdate", max_rows=None)


@query(
    "ml5_zscore_flags",
    """
    SELECT event_id, CAST(CASE WHEN abs((value - avg(value) OVER k) / nullif(stddev_samp(value) OVER k, 0)) > 3 THEN 1 ELSE 0 END AS INTEGER) AS global_outlier,
           CAST(CASE WHEN abs((value - avg(value) OVER r) / nullif(stddev_samp(value) OVER r, 0)) > 3 THEN 1 ELSE 0 END AS INTEGER) AS rolling_outlier
    FROM events WINDOW k AS (PARTITION BY user_id), r AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 60 PRECEDING AND CURRENT ROW)
    """,
)
def zscore_flags(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return S.zscore_flags(rows, "user_id", "ts", "value").drop("user_id", "ts", "value")


MAD = """
  WITH m AS (SELECT quantile_cont({v}, 0.5) AS median FROM {t}),
  d AS (SELECT quantile_cont(abs({v} - median), 0.5) AS mad FROM {t}, m)
  SELECT {keys}, round(abs(({v} - median) / nullif(mad, 0)), 6) AS score FROM {t}, m, d
"""


@query("ml6_mad_score", MAD.format(v="l_extendedprice", t="lineitem", keys="l_orderkey, l_linenumber"))
def mad_score(t):
    out = S.mad_score(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice")
    return rounded(out, 6, "score").select("l_orderkey", "l_linenumber", "score")


@query("ml6_mad_score_cut", MAD.format(v="value", t="events", keys="event_id"))
def mad_score_cut(t):
    out = S.mad_score(t.events.select("event_id", "value"), "value", max_rows=1_000)
    return rounded(out, 6, "score").select("event_id", "score")


@query(
    "ml7_mean_ci",
    """
    WITH a AS (SELECT o_orderpriority, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s, count(o_totalprice) AS n FROM orders
               WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY GROUP BY 1 HAVING count(o_totalprice) > 1)
    SELECT o_orderpriority, round(m, 2) AS mean, round(1.96 * s / sqrt(n), 2) AS margin_of_error,
           round(m - 1.96 * s / sqrt(n), 2) AS ci_lower_bound, round(m + 1.96 * s / sqrt(n), 2) AS ci_upper_bound,
           CASE WHEN m - 1.96 * s / sqrt(n) > 245000 THEN 'Significant Success ✅' ELSE 'Noise / Inconclusive ⚠️' END AS statistical_verdict
    FROM a
    """,
)
def mean_ci(t):
    newest = t.orders.agg(F.max("o_orderdate").alias("newest")).scalar()
    since = F.col("o_orderdate") >= newest - F.expr("INTERVAL 365 DAYS")
    out = S.mean_ci(t.orders, ["o_orderpriority"], "o_totalprice", 245000, since)
    return rounded(out, 2, "mean", "margin_of_error", "ci_lower_bound", "ci_upper_bound")


@query(
    "ml8_rolling_ci",
    """
    WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE) AS rate FROM events GROUP BY 1),
    r AS (SELECT day, rate, avg(rate) OVER w AS m, stddev_samp(rate) OVER w AS s, count(rate) OVER w AS n FROM d
          WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT day, round(rate, 6) AS rate, round(m - 1.96 * s / sqrt(n), 6) AS ci_min, round(m + 1.96 * s / sqrt(n), 6) AS ci_max,
           round((m + 1.96 * s / sqrt(n)) - (m - 1.96 * s / sqrt(n)), 6) AS ci_width,
           CASE WHEN rate < m - 1.96 * s / sqrt(n) THEN 'Drop Alert 🔻'
                WHEN (m + 1.96 * s / sqrt(n)) - (m - 1.96 * s / sqrt(n)) > 0.035 THEN 'Volatility Spike (Bug?) 🐛' ELSE 'Stable ✅' END AS status
    FROM r WHERE n >= 7
    """,
    text=("day",),
)
def rolling_ci(t):
    error = F.count_if(F.col("event_type") == "error")
    days = t.events.groupBy(F.to_date("ts").alias("day")).agg((error / F.count("*")).alias("rate"))
    # one row per calendar day
    out = S.rolling_ci(days, "day", "rate", 7, 0.035, max_rows=None)
    return rounded(out, 6, "rate", "ci_min", "ci_max", "ci_width")


@query(
    "ml9_fpc_ci",
    f"""
    WITH a AS (SELECT user_id, {mean_sql('value')} AS m, stddev_samp(value) AS s, count(value) AS n FROM events GROUP BY 1 HAVING count(value) > 1)
    SELECT user_id, round(m, 4) AS avg_score, n AS sample_n, CAST(1500 AS DOUBLE) AS population_n, round(s / sqrt(n), 6) AS standard_se,
           round(sqrt((1500.0 - n) / 1499.0), 6) AS fpc_factor,
           round(1.96 * (s / sqrt(n)) * sqrt((1500.0 - n) / 1499.0), 6) AS adj_margin_of_error,
           CASE WHEN n / 1500.0 > 0.05 THEN 'FPC Applied ✅' ELSE 'Standard Approx OK ℹ️' END AS calculation_method FROM a
    """,
)
def fpc_ci(t):
    out = S.fpc_ci(exact(t.events, "value"), ["user_id"], "value", 1500)
    return rounded(rounded(out, 4, "avg_score"), 6, "standard_se", "fpc_factor", "adj_margin_of_error")


@query(
    "ml10_mean_ci_all",
    """
    SELECT round(avg(o_totalprice), 4) AS mean, round(avg(o_totalprice) - 1.96 * stddev_samp(o_totalprice) / sqrt(count(*)), 4) AS lower_bound,
           round(avg(o_totalprice) + 1.96 * stddev_samp(o_totalprice) / sqrt(count(*)), 4) AS upper_bound FROM orders
    """,
)
def mean_ci_all(t):
    return rounded(S.mean_ci_all(t.orders, "o_totalprice"), 4, "mean", "lower_bound", "upper_bound")


RETURNS = "SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS k, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1"


def _returns(t):
    return t.lineitem.select("l_linestatus", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("converted"))


@query(
    "ml11_wilson_ci",
    f"""
    SELECT l_linestatus, round(k / n, 8) AS conversion_rate,
           round((k + 1.9208) / (n + 3.8416) - 1.96 * sqrt(k * (n - k) / n + 0.9604) / (n + 3.8416), 8) AS lower_bound,
           round((k + 1.9208) / (n + 3.8416) + 1.96 * sqrt(k * (n - k) / n + 0.9604) / (n + 3.8416), 8) AS upper_bound FROM ({RETURNS})
    """,
)
def wilson_ci(t):
    out = S.wilson_ci(_returns(t), ["l_linestatus"], "converted")
    return rounded(out, 8, "conversion_rate", "lower_bound", "upper_bound")


@query(
    "ml11_wilson_ci_as_written",
    f"""
    SELECT l_linestatus, round(k / n, 8) AS conversion_rate,
           round((k + 1.92) / (n + 3.84) - 1.96 * sqrt((k * (n - k) / n + 0.96) / (n + 3.84)) / n, 8) AS lower_bound,
           round((k + 1.92) / (n + 3.84) + 1.96 * sqrt((k * (n - k) / n + 0.96) / (n + 3.84)) / n, 8) AS upper_bound FROM ({RETURNS})
    """,
)
def wilson_ci_as_written(t):
    out = S.wilson_ci(_returns(t), ["l_linestatus"], "converted", "as_written")
    return rounded(out, 8, "conversion_rate", "lower_bound", "upper_bound")
