"""Statistics: least squares, outlier scores, confidence intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.ordered import framed, order_of, running
from tablecraft.plans.quantiles import buffered, percentiles
from tablecraft.plans.skew import MAX_ROWS, Limit, attach, find_hot, with_scalars

# 95 % normal quantile and the constants of the Wilson interval as written.
Z95 = 1.96
HALF_Z2 = 1.92
Z2 = 3.84
QUARTER_Z2 = 0.96

# Verdict texts.
SUCCESS = "Significant Success ✅"
NOISE = "Noise / Inconclusive ⚠️"
DROP = "Drop Alert 🔻"
SPIKE = "Volatility Spike (Bug?) 🐛"
STABLE = "Stable ✅"
FPC_APPLIED = "FPC Applied ✅"
FPC_NOT_NEEDED = "Standard Approx OK ℹ️"


def ols_manual(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept from centred sums, in one mergeable pass.

    Only rows with both values count, as in the sums of products.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    sums = df.filter(both).agg(
        F.covar_pop(x, y).alias("_xy"), F.var_pop(x).alias("_xx"), F.avg(x).alias("_x"), F.avg(y).alias("_y")
    )
    slope = F.col("_xy") / F.nullif(F.col("_xx"), F.lit(0.0))
    return sums.select(slope.alias("slope"), (F.col("_y") - F.col("_x") * slope).alias("intercept"))


def ols_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def ols_predict(df: DataFrame, x: str, y: str, out: str = "prediction") -> DataFrame:
    """Fit on rows with a known ``y``, predict the rows where it is NULL."""
    fit = ols_fit(df.filter(F.col(y).isNotNull()), x, y)
    missing = with_scalars(df.filter(F.col(y).isNull()), fit)
    return missing.withColumn(out, F.col(x) * F.col("slope") + F.col("intercept")).drop("slope", "intercept")


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Each row with the fitted value at ``x`` and at ``x + 1``."""
    wide = with_scalars(df, ols_manual(df, x, y))
    return wide.withColumns(
        {
            "y_predicted": F.col(x) * F.col("slope") + F.col("intercept"),
            "next_y_predicted": (F.col(x) + 1) * F.col("slope") + F.col("intercept"),
        }
    )


def daily_cumulative(df: DataFrame, ts: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """Rows per day, the day's number since the first, and the running count."""
    days = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    numbered = with_scalars(days, df.agg(F.min(F.to_date(ts)).alias("_first")))
    counted = running(numbered, [], order_of("day"), {"cumulative_orders": ("sum", "orders")}, max_rows=max_rows)
    return counted.select("day", F.datediff("day", "_first").alias("day_number"), "orders", "cumulative_orders")


def zscore_flags(
    df: DataFrame, key: str, ts: str, value: str, before: int = 60, limit: float = 3.0, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """1 where a value lies beyond ``limit`` deviations of its key, and of its last rows."""
    hot = find_hot(df, [key], max_rows)
    per_key = df.groupBy(key).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))

    def columns(w):
        near = w.rowsBetween(-before, 0)
        return {"_near_mean": F.avg(value).over(near), "_near_std": F.stddev_samp(value).over(near)}

    local = framed(df, [key], order_of(ts), before, 0, columns, hot)
    wide = attach(local, per_key, [key], "left", hot)

    def flag(mean: str, std: str) -> Column:
        score = (F.col(value) - F.col(mean)) / F.nullif(F.col(std), F.lit(0.0))
        return F.when(F.abs(score) > limit, 1).otherwise(0)

    return wide.withColumns(
        {"global_outlier": flag("_mean", "_std"), "rolling_outlier": flag("_near_mean", "_near_std")}
    ).drop("_mean", "_std", "_near_mean", "_near_std")


def mad_score(df: DataFrame, value: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """Distance from the median in median absolute deviations; NULL if that is 0."""
    hot = find_hot(df, [], buffered(max_rows))
    if hot is None:
        # scalar subqueries: nothing runs before the rows are asked for
        middle = percentiles(df, [], value, {"median": 0.5}, max_rows=None).scalar()
        off = F.abs(F.col(value) - middle)
        spread = percentiles(df.select(off.alias("_d")), [], "_d", {"mad": 0.5}, max_rows=None).scalar()
        return df.withColumns(
            {"median": middle.cast("double"), "mad": spread.cast("double"), "score": off / F.nullif(spread.cast("double"), F.lit(0.0))}
        )
    # two single numbers
    median = percentiles(df, [], value, {"median": 0.5}, max_rows=hot).first()[0]
    away = F.abs(F.col(value) - F.lit(median))
    mad = percentiles(df.select(away.alias("_d")), [], "_d", {"mad": 0.5}, max_rows=hot).first()[0]
    return df.withColumns(
        {
            "median": F.lit(median).cast("double"),
            "mad": F.lit(mad).cast("double"),
            "score": away / F.nullif(F.lit(mad).cast("double"), F.lit(0.0)),
        }
    )


def _margin(std: str, n: str, z: float) -> Column:
    return F.lit(z) * F.col(std) / F.sqrt(F.col(n).cast("double"))


def mean_ci(
    df: DataFrame, by: Sequence[str], value: str, verdict_above: float, since: Column | None = None, z: float = Z95
) -> DataFrame:
    """Mean, margin of error, bounds and verdict per group with two or more values."""
    rows = df if since is None else df.filter(since)
    stats = rows.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("_s"), F.count(value).alias("_n"))
    wide = stats.filter("_n > 1").withColumn("margin_of_error", _margin("_s", "_n", z))
    low, high = F.col("mean") - F.col("margin_of_error"), F.col("mean") + F.col("margin_of_error")
    return wide.select(
        *by, "mean", "margin_of_error", low.alias("ci_lower_bound"), high.alias("ci_upper_bound"),
        F.when(low > verdict_above, SUCCESS).otherwise(NOISE).alias("statistical_verdict"),
    )


def rolling_ci(
    df: DataFrame, order: str, value: str, rows: int = 7, max_width: float = 0.15, by: Sequence[str] = (), z: float = Z95,
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Bounds over the last ``rows`` rows with an alert; rows without a full window are left out."""

    def columns(w):
        near = w.rowsBetween(-(rows - 1), 0)
        return {"_m": F.avg(value).over(near), "_s": F.stddev_samp(value).over(near), "_n": F.count(value).over(near)}

    full = framed(df, by, order_of(order), rows - 1, 0, columns, max_rows).filter(F.col("_n") >= rows)
    low, high = F.col("_m") - _margin("_s", "_n", z), F.col("_m") + _margin("_s", "_n", z)
    wide = full.withColumns({"ci_min": low, "ci_max": high, "ci_width": high - low})
    status = F.when(F.col(value) < low, DROP).when(high - low > max_width, SPIKE).otherwise(STABLE)
    return wide.withColumn("status", status).drop("_m", "_s", "_n")


def fpc_ci(df: DataFrame, by: Sequence[str], value: str, population: float, z: float = Z95) -> DataFrame:
    """Margin of error with the finite population correction."""
    size = F.lit(float(population))
    stats = df.groupBy(*by).agg(
        F.avg(value).alias("avg_score"), F.stddev_samp(value).alias("_s"), F.count(value).alias("sample_n")
    ).filter("sample_n > 1")
    n = F.col("sample_n").cast("double")
    error = F.col("_s") / F.sqrt(n)
    # a sample above the stated population has no correction factor
    factor = F.sqrt(F.when(n <= size, (size - n) / (size - 1)))
    return stats.select(
        *by, "avg_score", "sample_n", size.alias("population_n"), error.alias("standard_se"), factor.alias("fpc_factor"),
        (F.lit(z) * error * factor).alias("adj_margin_of_error"),
        F.when(n / size > 0.05, FPC_APPLIED).otherwise(FPC_NOT_NEEDED).alias("calculation_method"),
    )


def mean_ci_all(df: DataFrame, value: str, z: float = Z95) -> DataFrame:
    """Mean of the whole table with bounds; the count is of all rows, as written."""
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    margin = _margin("_s", "_n", z)
    return stats.select(
        "mean", (F.col("mean") - margin).alias("lower_bound"), (F.col("mean") + margin).alias("upper_bound")
    )


def wilson_ci(df: DataFrame, by: Sequence[str], hit: str, formula: str = "wilson", z: float = Z95) -> DataFrame:
    """Conversion rate with Wilson bounds; ``hit`` is 0 or 1.

    ``as_written`` keeps the form whose radius divides by ``n + z^2`` inside the
    root and by ``n`` again; it is narrower than the standard interval.
    """
    sums = df.groupBy(*by).agg(F.sum(hit).cast("double").alias("_k"), F.count(F.lit(1)).cast("double").alias("_n"))
    k, n = F.col("_k"), F.col("_n")
    if formula == "as_written":
        centre = (k + HALF_Z2) / (n + Z2)
        radius = F.lit(z) * F.sqrt((k * (n - k) / n + QUARTER_Z2) / (n + Z2)) / n
    elif formula == "wilson":
        centre = (k + z * z / 2) / (n + z * z)
        radius = F.lit(z) * F.sqrt(k * (n - k) / n + z * z / 4) / (n + z * z)
    else:
        raise ValueError(f"unknown formula {formula}")
    return sums.select(
        *by, (k / n).alias("conversion_rate"), (centre - radius).alias("lower_bound"), (centre + radius).alias("upper_bound")
    )
