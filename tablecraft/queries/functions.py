"""Registered queries: column expressions, each in one table query."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions import exprs as E
from tablecraft.plans.registry import query, rounded


@query(
    "fn1_string_exprs",
    """
    SELECT c_custkey, c_name || '(' || substr(c_mktsegment, 1, 1) || ')' AS tagged, lower(c_mktsegment) AS segment,
           replace(c_name, 'Customer#', 'C-') AS short_name,
           rpad(c_name, 20, ' ') || rpad(c_mktsegment, 12, ' ') || rpad(CAST(c_custkey AS VARCHAR), 8, ' ') AS line
    FROM customer
    """,
)
def string_exprs(t):
    return t.customer.select(
        "c_custkey",
        E.name_with_initial("c_name", "c_mktsegment").alias("tagged"),
        F.lower("c_mktsegment").alias("segment"),
        F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("C-")).alias("short_name"),
        E.report_line({"c_name": 20, "c_mktsegment": 12, "c_custkey": 8}).alias("line"),
    )


@query(
    "fn2_domain_part",
    """
    SELECT page_id, split_part(url, '/', 3) AS host,
           split_part('user' || page_id || '@' || split_part(url, '/', 3), '@', 2) AS domain FROM pages
    """,
)
def domain_part(t):
    pages = t.pages.select("page_id", E.host_of("url").alias("host"))
    mailed = pages.withColumn("email", F.concat(F.lit("user"), F.col("page_id"), F.lit("@"), F.col("host")))
    return mailed.select("page_id", "host", E.email_domain("email").alias("domain"))


@query("fn3_contains_token", "SELECT p_partkey, p_name FROM part WHERE position('ring' IN p_name) > 0")
def contains_token(t):
    return t.part.filter(E.contains_token("p_name", "ring")).select("p_partkey", "p_name")


@query(
    "fn4_typed_columns",
    """
    SELECT l_orderkey, l_linenumber, TRY_CAST(l_returnflag || CAST(l_quantity AS VARCHAR) AS DOUBLE) AS bad_number,
           TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price,
           TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS line_no,
           CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem
    """,
    text=("ship_date",),
)
def typed_columns(t):
    text = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_returnflag", F.col("l_quantity").cast("string")).alias("bad_number"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )
    return E.typed_columns(text, {"bad_number": "double", "price": "double", "line_no": "int", "ship_date": "date"})


@query(
    "fn5_display_columns",
    """
    SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS padded,
           strftime(o_orderdate, '%Y-%m-%d') AS day_text, strftime(o_orderdate, '%Y-%B') AS month_text,
           printf('%.2f', o_totalprice) AS price_text,
           CAST(o_orderkey AS BIGINT) AS key_back
    FROM orders
    """,
)
def display_columns(t):
    padded = E.zero_padded("o_orderkey", 8)
    out = t.orders.select(
        "o_orderkey",
        padded.alias("padded"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"),
        F.date_format("o_orderdate", "yyyy-MMMM").alias("month_text"),
        F.replace(E.money_text("o_totalprice"), F.lit(","), F.lit("")).alias("price_text"),
    )
    return out.withColumn("key_back", E.parse_number("padded", "9999999999").cast("long"))


@query(
    "fn6_month_number",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%b') AS mon, CAST(month(o_orderdate) AS INTEGER) AS num_month FROM orders
    """,
)
def month_number(t):
    named = t.orders.select("o_orderkey", F.date_format("o_orderdate", "MMM").alias("mon"))
    return named.withColumn("num_month", E.month_number("mon"))


@query(
    "fn7_date_parts",
    """
    SELECT event_id, CAST(ts AS DATE) AS date, CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
           CAST(month(ts) AS INTEGER) AS month, strftime(ts, '%b') AS month_name, CAST(dayofweek(ts) AS INTEGER) AS dow,
           CAST(hour(ts) AS INTEGER) AS hour, date_trunc('hour', ts) AS hour_start, epoch_us(ts) / 1e6 AS epoch
    FROM events
    """,
    text=("date",),
)
def date_parts(t):
    out = E.date_parts(t.events.select("event_id", "ts"), "ts").drop("ts")
    return out.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@query(
    "fn8_recency_days",
    """
    SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_date,
           CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-12-31') AS INTEGER) AS days_since_last,
           CAST(min(o_orderdate) AS DATE) AS first_date,
           CAST(date_diff('day', DATE '2001-12-31', CAST(min(o_orderdate) AS DATE)) AS INTEGER) AS days_until_first
    FROM orders GROUP BY o_custkey
    """,
    text=("last_date", "first_date",),
)
def recency_days(t):
    return E.recency_days(t.orders, "o_custkey", "o_orderdate", "2001-12-31")


@query(
    "fn8_date_shift",
    """
    SELECT o_orderkey, o_orderdate + INTERVAL 10 DAY AS due, o_orderdate - INTERVAL 1 YEAR AS year_before,
           o_orderdate + INTERVAL 1 MONTH AS month_after FROM orders
    """,
)
def date_shift(t):
    return t.orders.select(
        "o_orderkey",
        E.shift("o_orderdate", days=10).alias("due"),
        E.shift("o_orderdate", years=-1).alias("year_before"),
        E.shift("o_orderdate", months=1).alias("month_after"),
    )


@query(
    "fn9_math_exprs",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, round(ln(l_quantity + 1), 6) AS log_plus_one, round(sqrt(l_quantity), 6) AS root,
           power(l_quantity, 2.0) AS squared, abs(l_quantity - 25.0) AS distance,
           CAST(ceil(l_quantity / 7.0) AS BIGINT) AS up, CAST(floor(l_quantity / 7.0) AS BIGINT) AS down,
           round(l_quantity * 123.0 / 1000) * 1000 AS thousands,
           round(sin(l_quantity * pi() / 50.0), 6) AS sine, round(cos(l_quantity * pi() / 50.0), 6) AS cosine
    FROM lineitem
    """,
)
def math_exprs(t):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").withColumns(E.math_exprs("l_quantity"))
    return rounded(wide, 6, "log_plus_one", "root", "sine", "cosine")


@query(
    "fn10_width_bucket",
    """
    SELECT event_id, value, CAST(CASE WHEN value < 30 THEN 0 WHEN value >= 110 THEN 9
           ELSE floor((value - 30) / 10) + 1 END AS BIGINT) AS bin FROM events
    """,
)
def width_bucket(t):
    return t.events.select("event_id", "value", E.width_bucket_col("value", 30, 110, 8).alias("bin"))


@query(
    "fn11_json_each",
    "SELECT event_id, e.key AS key, json_extract_string(props, '$.' || e.key) AS value "
    "FROM events, unnest(json_keys(props)) AS e(key)",
)
def json_each(t):
    return E.json_each(t.events, "props", ["event_id"])


@query(
    "fn12_path_arrays",
    """
    SELECT event_id, [event_type, json_extract_string(props, '$.k')] AS path, event_type = 'error' AS has_error FROM events
    """,
)
def path_arrays(t):
    first = t.events.select(
        "event_id", E.path_start("event_type").alias("path"), F.get_json_object("props", "$.k").alias("k"),
        F.lit("error").alias("word"),
    )
    longer = first.withColumn("path", E.path_step("path", "k"))
    return longer.select("event_id", "path", E.on_path("path", "word").alias("has_error"))
