"""Column expressions that have a name in everyday SQL but not in Spark."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "MONTH_NAMES", "name_with_initial", "report_line", "email_domain", "host_of", "contains_token",
    "safe_int", "typed_columns", "zero_padded", "money_text", "percent_text", "parse_number",
    "month_number", "date_parts", "dow0", "epoch_seconds", "seconds_between", "days_between",
    "recency_days", "shift", "log_feature", "math_exprs", "width_bucket_col", "json_each",
    "path_start", "path_step", "on_path", "cyclic",
]

# English month abbreviations in calendar order.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def name_with_initial(name: str, word: str) -> Column:
    """``Ann(D)`` from a name and a word."""
    return F.concat(F.col(name), F.lit("("), F.substring(word, 1, 1), F.lit(")"))


def report_line(widths: dict[str, int]) -> Column:
    """Columns padded to fixed widths in one line of text."""
    return F.concat(*[F.rpad(F.col(c).cast("string"), w, " ") for c, w in widths.items()])


def email_domain(col: str) -> Column:
    return F.split_part(F.col(col), F.lit("@"), F.lit(2))


def host_of(url: str) -> Column:
    """Host part of an address: the third piece between slashes."""
    return F.split_part(F.col(url), F.lit("/"), F.lit(3))


def contains_token(col: str, token: str) -> Column:
    """Substring test; as a filter the scan gets it as StringContains."""
    return F.col(col).contains(token)


def safe_int(col: str) -> Column:
    return F.col(col).try_cast("int")


def typed_columns(df: DataFrame, kinds: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast columns; text that does not fit becomes NULL unless ``strict``."""
    return df.withColumns(
        {c: F.col(c).cast(k) if strict else F.col(c).try_cast(k) for c, k in kinds.items()}
    )


def zero_padded(col: str, width: int) -> Column:
    """Fixed-width text with leading zeros; longer numbers keep all digits."""
    text = F.col(col).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def money_text(col: str | Column, digits: int = 2) -> Column:
    """Rounded number with thousands separators."""
    return F.format_number(F.col(col) if isinstance(col, str) else col, digits)


def percent_text(ratio: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(ratio * 100, digits), F.lit(" %"))


def parse_number(col: str, mask: str) -> Column:
    """Number from text by a digit mask; NULL when the text does not fit."""
    return F.try_to_number(F.col(col), F.lit(mask))


def month_number(col: str | Column) -> Column:
    """1 to 12 from a month abbreviation, NULL for anything else."""
    spot = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.col(col) if isinstance(col, str) else col)
    return F.nullif(spot, F.lit(0)).cast("int")


def dow0(ts: str | Column) -> Column:
    """Day of week, 0 for Sunday to 6 for Saturday."""
    return F.dayofweek(ts) - 1


def _stamp(ts: str | Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970 as a double; the session zone is UTC."""
    return F.unix_micros(_stamp(ts)) / F.lit(1e6)


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    return (F.unix_micros(_stamp(later)) - F.unix_micros(_stamp(earlier))) / F.lit(1e6)


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(later, earlier)


def date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(
        {
            "date": F.to_date(ts),
            "year": F.year(ts),
            "quarter": F.quarter(ts),
            "month": F.month(ts),
            "month_name": F.monthname(ts),
            "dow": dow0(ts),
            "hour": F.hour(ts),
            "hour_start": F.date_trunc("hour", ts),
            "epoch": F.unix_micros(_stamp(ts)).cast("double") / 1e6,
        }
    )


def recency_days(df: DataFrame, by: str, ts: str, as_of: str) -> DataFrame:
    """First and last date per key and their distance to a fixed day."""
    day = F.to_date(F.lit(as_of))
    return df.groupBy(by).agg(
        F.max(F.to_date(ts)).alias("last_date"),
        F.datediff(day, F.max(F.to_date(ts))).alias("days_since_last"),
        F.min(F.to_date(ts)).alias("first_date"),
        F.datediff(F.min(F.to_date(ts)), day).alias("days_until_first"),
    )


def shift(ts: str, days: int = 0, months: int = 0, years: int = 0) -> Column:
    """A timestamp moved by calendar units."""
    return F.col(ts) + F.make_interval(F.lit(years), F.lit(months), F.lit(0), F.lit(days))


def log_feature(col: str) -> Column:
    """Natural log of value plus one."""
    return F.log1p(col)


def math_exprs(col: str) -> dict[str, Column]:
    c = F.col(col)
    return {
        "log_plus_one": F.log1p(c),
        "root": F.sqrt(c),
        "squared": F.pow(c, F.lit(2.0)),
        "distance": F.abs(c - F.lit(25.0)),
        "up": F.ceil(c / F.lit(7.0)),
        "down": F.floor(c / F.lit(7.0)),
        "thousands": F.round(c * F.lit(123.0), -3),
        "sine": F.sin(c * F.lit(math.pi) / F.lit(50.0)),
        "cosine": F.cos(c * F.lit(math.pi) / F.lit(50.0)),
    }


def cyclic(part: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position inside a period."""
    angle = F.lit(2 * math.pi) * part / F.lit(period)
    return F.sin(angle), F.cos(angle)


def width_bucket_col(col: str | Column, low: float, high: float, n: int) -> Column:
    """Equal-width bin 1 to n; 0 below the range, n + 1 at or above its end."""
    value = F.col(col) if isinstance(col, str) else col
    return F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n))


def json_each(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """One row per top-level key of a JSON object column."""
    parsed = F.from_json(F.col(col), "map<string,string>")
    return df.select(*keep, F.explode(parsed).alias("key", "value"))


def path_start(col: str) -> Column:
    return F.array(F.col(col))


def path_step(path: str, col: str) -> Column:
    return F.array_append(F.col(path), F.col(col))


def on_path(path: str, col: str) -> Column:
    return F.array_contains(F.col(path), F.col(col))
