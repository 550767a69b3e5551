"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.ordered import order_of, ranked
from tablecraft.plans.quantiles import percentiles
from tablecraft.plans.skew import MAX_ROWS, Limit, with_scalars


def group_agg(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """GROUP BY with partial aggregation before the shuffle."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def having(df: DataFrame, keys: Sequence[str], cond: Column, **aggs: Column) -> DataFrame:
    return group_agg(df, keys, **aggs).filter(cond)


def distinct_counts(df: DataFrame, keys: Sequence[str], cols: dict[str, str], approx: bool = False) -> DataFrame:
    """Several distinct counts in one pass.

    Spark shuffles on key and value first, so a large group spreads over its
    values.  ``approx`` uses a mergeable sketch instead.
    """
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*keys).agg(*[count(F.col(c)).alias(n) for n, c in cols.items()])


def group_by_ordinal(df: DataFrame, cols: Sequence[str], count: str = "n") -> DataFrame:
    """GROUP BY and ORDER BY by position in the select list."""
    ordinals = ", ".join(str(i + 1) for i in range(len(cols)))
    text = f"SELECT {', '.join(cols)}, count(*) AS {count} FROM {{df}} GROUP BY {ordinals} ORDER BY {len(cols) + 1} DESC"
    return df.sparkSession.sql(text, df=df)


def leaderboard(
    scores: DataFrame, player: str, challenge: str, score: str, players: DataFrame, player_key: str, name: str
) -> DataFrame:
    """Best score per challenge, summed per player, positive totals, best first.

    Both aggregations come before the join, so the join sees one row per player.
    """
    best = scores.groupBy(player, challenge).agg(F.max(score).alias("_best"))
    total = best.groupBy(player).agg(F.sum("_best").alias("total")).filter("total > 0")
    named = total.join(players, F.col(player) == F.col(player_key))
    return named.select(player, name, "total").orderBy(F.desc("total"), player)


def one_hot_counts(df: DataFrame, keys: Sequence[str], col: str, values: dict[str, str], total: str = "total") -> DataFrame:
    """One counter per listed value; ``values`` maps output column to value."""
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(col) == v).alias(out) for out, v in values.items()],
        F.count(F.lit(1)).alias(total),
    )


def pivot_fixed(df: DataFrame, row: str, col: str, values: Sequence[str], agg: Column) -> DataFrame:
    return df.groupBy(row).pivot(col, list(values)).agg(agg)


def dynamic_pivot(df: DataFrame, row: str, col: str, agg: Column) -> DataFrame:
    """Pivot over the values found in the data.

    The list is bounded by ``spark.sql.pivotMaxValues``; more values are an
    error, never a silent cut.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = [r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} values, too many for columns")
    return df.groupBy(row).pivot(col, sorted(found)).agg(agg)


def pct_where(df: DataFrame, cond: Column, out: str = "pct") -> DataFrame:
    """Share of rows that meet a condition, as a percentage."""
    return df.agg((F.sum(F.when(cond, 1).otherwise(0)) * 100.0 / F.count(F.lit(1))).alias(out))


def pct_where_join(df: DataFrame, cond: Column, out: str = "pct") -> DataFrame:
    """The two-count form: matching rows against all rows."""
    both = with_scalars(df.agg(F.count(F.lit(1)).alias("_all")), df.filter(cond).agg(F.count(F.lit(1)).alias("_hit")))
    return both.select((F.col("_hit") * 100.0 / F.col("_all")).alias(out))


def ratio_of_totals(
    base: DataFrame, group: str, member: str, facts: DataFrame, fact_key: str, amount: str
) -> DataFrame:
    """Visits and cost per member of a group, from base rows.

    Facts are summed per member before the join.  An average of member averages
    would weigh members alike and give another number.
    """
    per_member = facts.groupBy(F.col(fact_key).alias(member)).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum")
    )
    joined = base.select(group, member).distinct().join(per_member, member)
    return joined.groupBy(group).agg(
        (F.sum("_n") / F.count_distinct(member)).alias("avg_visits"),
        (F.sum("_sum").cast("double") / F.count_distinct(member)).alias("avg_cost"),
    )


def average_of_averages(
    base: DataFrame, group: str, member: str, facts: DataFrame, fact_key: str, amount: str
) -> DataFrame:
    """The form to avoid, kept to show the difference."""
    per_member = facts.groupBy(F.col(fact_key).alias(member)).agg(F.avg(amount).alias("_avg"))
    return base.select(group, member).distinct().join(per_member, member).groupBy(group).agg(
        F.avg("_avg").alias("avg_of_avg")
    )


def string_agg(
    df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str], sep: str = ", ", out: str = "listed"
) -> DataFrame:
    """Values of each group in order as one text.

    The text itself is one cell and so has to fit in memory; groups without that
    bound go through :func:`string_agg_parts`.
    """
    item = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(col).cast("string").alias("v"))
    listed = F.array_sort(F.collect_list(F.when(F.col(col).isNotNull(), item)))
    return df.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["v"]), sep).alias(out))


def string_agg_parts(
    df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str], part_rows: int, sep: str = ", ",
    out: str = "listed", max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """The same text in numbered parts of at most ``part_rows`` values each."""
    rows = df.filter(F.col(col).isNotNull())
    numbered = ranked(rows, keys, order_of(*order), row_number="_rn", max_rows=max_rows)
    parts = numbered.withColumn("part", F.floor((F.col("_rn") - 1) / part_rows))
    return string_agg(parts, [*keys, "part"], col, ["_rn"], sep, out)


def avg_null_aware(df: DataFrame, col: str) -> DataFrame:
    """AVG over known values beside SUM over all rows."""
    return df.agg(F.avg(col).alias("avg_known"), (F.sum(col) / F.count(F.lit(1))).alias("avg_all"))


def zero_key_error(df: DataFrame, col: str) -> DataFrame:
    """Average minus the average with every digit 0 left out; blanks are NULL."""
    digits = F.replace(F.col(col).cast("string"), F.lit("0"), F.lit(""))
    gap = F.avg(col) - F.avg(F.nullif(digits, F.lit("")).try_cast("double"))
    return df.agg(gap.alias("gap"), F.ceil(gap).alias("gap_up"))


def rollup_agg(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Subtotals over the leading keys; ``level`` tells a total from a NULL key."""
    return df.rollup(*keys).agg(*[c.alias(n) for n, c in aggs.items()], F.grouping_id().cast("long").alias("level"))


def cube_agg(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    return df.cube(*keys).agg(*[c.alias(n) for n, c in aggs.items()], F.grouping_id().cast("long").alias("level"))


def cube_by_rollups(df: DataFrame, keys: Sequence[str], aggs: str) -> DataFrame:
    """The same grouping sets as a product of one-key rollups."""
    product = ", ".join(f"ROLLUP({k})" for k in keys)
    text = f"SELECT {', '.join(keys)}, {aggs}, CAST(grouping_id({', '.join(keys)}) AS BIGINT) AS level FROM {{df}} GROUP BY {product}"
    return df.sparkSession.sql(text, df=df)


def percentile_by(
    df: DataFrame, keys: Sequence[str], col: str, wanted: dict[str, float], approx: bool = False, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    return percentiles(df, keys, col, wanted, approx, max_rows)


def spread_topk(df: DataFrame, keys: Sequence[str], col: str, k: int, out: str = "spread") -> DataFrame:
    """Largest ranges (max minus min) by key."""
    spread = df.groupBy(*keys).agg((F.max(col) - F.min(col)).alias(out))
    return spread.orderBy(F.desc(out), *keys).limit(k)


def dim_average(
    facts: DataFrame, fact_key: str, value: str, dim: DataFrame, dim_key: str, by: str, out: str = "average"
) -> DataFrame:
    """Average of a fact by a dimension column; summed per key before the join."""
    per_key = facts.groupBy(F.col(fact_key).alias(dim_key)).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    return per_key.join(dim, dim_key).groupBy(by).agg((F.sum("_s").cast("double") / F.sum("_n")).alias(out))


def filtered_join_average(
    dim: DataFrame, dim_key: str, value: str, facts: DataFrame, fact_key: str, cond: Column, out: str = "average"
) -> DataFrame:
    """Average of a dimension value over the fact rows that meet a condition."""
    hits = facts.filter(cond).groupBy(F.col(fact_key).alias(dim_key)).agg(F.count(F.lit(1)).alias("_n"))
    joined = hits.join(dim, dim_key).filter(F.col(value).isNotNull())
    return joined.agg((F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias(out))


def revenue_by_item(
    facts: DataFrame, fact_key: str, amount: str, items: DataFrame, item_key: str, title: str
) -> DataFrame:
    """Rows and revenue per title; summed per item before the join."""
    per_item = facts.groupBy(F.col(fact_key).alias(item_key)).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s"))
    return per_item.join(items, item_key).groupBy(title).agg(F.sum("_n").alias("n_rows"), F.sum("_s").alias("revenue"))


def count_by_customer(
    customers: DataFrame, key: str, names: Sequence[str], facts: DataFrame, fact_key: str, out: str = "n_rows"
) -> DataFrame:
    """Fact rows per customer name, 0 for customers without any."""
    counts = facts.groupBy(F.col(fact_key).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    return customers.join(counts, key, "left").groupBy(*names).agg(F.sum(F.coalesce("_n", F.lit(0))).alias(out))


def repeat_users(df: DataFrame, user: str, ts: str) -> DataFrame:
    """How many users were active on more than one day."""
    days = df.groupBy(user).agg(F.count_distinct(F.to_date(ts)).alias("_days"))
    return days.filter("_days > 1").agg(F.count(F.lit(1)).alias("users"))


def teaching_report(
    teacher: Column, teaches: DataFrame, takes: DataFrame, on: Sequence[str], keys: Sequence[str], out: str = "enrollment"
) -> DataFrame:
    """Rows taken per section for one teacher."""
    mine = teaches.filter(teacher)
    taken = takes.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return mine.join(taken, list(on)).groupBy(*keys).agg(F.sum("_n").alias(out)).orderBy(*keys)


def credit_totals(students: DataFrame, courses: DataFrame, takes: DataFrame, draft: str = "taken") -> DataFrame:
    """Credits per student, in three readings that differ.

    ``department``: sum over all courses of the student's department;
    ``rows``: number of taken rows in the student's own department;
    ``taken``: sum over the courses the student took, NULL if none.
    Columns: students (id, dept), courses (course_id, dept, credits), takes (id, course_id).
    """
    if draft == "department":
        sums = courses.groupBy("dept").agg(F.sum("credits").alias("credits"))
        return students.join(sums, "dept").select("id", "credits")
    taken = takes.groupBy("id", "course_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = taken.join(courses.withColumnRenamed("dept", "_course_dept"), "course_id").join(
        students.select("id", "dept"), "id"
    )
    if draft == "rows":
        own = joined.filter(F.col("_course_dept") == F.col("dept"))
        return own.groupBy("id").agg(F.sum("_n").alias("credits"))
    sums = joined.groupBy("id").agg(F.sum(F.col("credits") * F.col("_n")).alias("credits"))
    return students.select("id").join(sums, "id", "left")
