"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType


def micros(name: str) -> Column:
    """Microseconds since the epoch of a timestamp column, zoned or not."""
    return F.unix_micros(F.col(name).cast("timestamp"))


def by_day(df: DataFrame, name: str = "timestamp") -> bool:
    """Whether the table is laid out by the day of its time column (see ``tables.append_logs``)."""
    return name == "timestamp" and "date" in df.columns and isinstance(df.schema["date"].dataType, DateType)


def latest(df: DataFrame, name: str = "timestamp") -> Column:
    """The newest value of a time column as a scalar subquery; of a table by days only the newest day is read."""
    if by_day(df, name):
        df = df.filter(F.col("date") == df.agg(F.max("date")).scalar())
    return df.agg(F.max(name)).scalar()


def recent(df: DataFrame, window: str, as_of: Column | None = None, name: str = "timestamp") -> DataFrame:
    """Rows strictly younger than ``window`` before ``as_of`` (default: the newest row).

    A literal ``as_of`` is folded into a bound that reaches the parquet scan; of a table by days,
    older day folders are not read either way.
    """
    bound = (latest(df, name) if as_of is None else as_of) - F.expr(f"INTERVAL '{window}'")
    rows = df.filter(F.col(name) > bound)
    return rows.filter(F.col("date") >= F.to_date(bound)) if by_day(df, name) else rows


def any_ilike(column: Column, patterns: list[str]) -> Column:
    """True when the column matches one of the case-blind patterns."""
    test = column.ilike(patterns[0])
    for pattern in patterns[1:]:
        test = test | column.ilike(pattern)
    return test


def contains_text(column: Column, text: str) -> Column:
    """Case-blind search for a text; wildcards in it keep their LIKE meaning."""
    return column.ilike(f"%{text}%")


def off_hours(hour: Column) -> Column:
    """22:00 up to 06:00."""
    return (hour >= 22) | (hour < 6)


def clip(column: Column, low: float, high: float) -> Column:
    """The value within the limits; null stays null."""
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(float(low))), F.lit(float(high))))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def floor_to(column: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above a whole-number column (also below zero)."""
    return column - F.pmod(column, F.lit(width).cast("bigint"))
