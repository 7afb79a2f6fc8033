"""Running sums and previous rows in the order of time, without a window over the whole table.

Rows are looked at day by day. What a day hands on, its total or its last row, is carried over blocks of 4,096 days, and what a block hands on over
all blocks (894 from year 1 to 9999). So no window holds more than a day's rows, or some thousand days of one group; days without
rows cost nothing. ``at`` is a column of epoch seconds, with one row per group and second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_DAY_SECONDS = 86400
#: Days from the start of year 1 to 1970, so that block numbers are not negative.
_FIRST_DAY = 719_162
_BLOCK = 12


def _placed(df: DataFrame, at: str) -> DataFrame:
    return df.withColumn("_day", F.floor(F.col(at) / _DAY_SECONDS).cast("long") + _FIRST_DAY)


def _same(left: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Equality of keys, null being equal to null."""
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def _carried(days: DataFrame, by: Sequence[str], over_days: Column, over_blocks: Column, combine) -> DataFrame:
    """(by, _day, carry) from days (by, _day, held): what the days before hand on."""
    days = days.withColumn("_block", F.shiftright("_day", _BLOCK))
    ordered = W.partitionBy(*by, "_block").orderBy("_day")
    within = days.withColumn("_within", over_days.over(ordered.rowsBetween(W.unboundedPreceding, -1)))
    last = F.max_by(combine("_within", "held"), "_day").alias("held")
    blocks = within.groupBy(*by, "_block").agg(last).withColumn("_all", F.shiftright("_block", _BLOCK))
    before = over_blocks.over(W.partitionBy(*by, "_all").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select(*[F.col(k).alias(f"_b_{k}") for k in [*by, "_block"]], before.alias("_before"))
    joined = within.join(blocks, _same(within, [*by, "_block"], "_b_"))
    return joined.select(*[F.col(k).alias(f"_c_{k}") for k in [*by, "_day"]], combine("_before", "_within").alias("_carry"))


def running_sum(df: DataFrame, at: str, column: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``name``: the sum of ``column`` over the group's rows up to and with this one."""
    rows = _placed(df, at)
    add = lambda a, b: F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
    days = rows.groupBy(*by, "_day").agg(F.sum(column).alias("held"))
    carried = _carried(days, by, F.sum("held"), F.sum("held"), add)
    within = F.sum(column).over(W.partitionBy(*by, "_day").orderBy(at).rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_sum", within)
    return rows.join(carried, _same(rows, [*by, "_day"], "_c_")).withColumn(name, F.col("_sum") + F.col("_carry")).select(*df.columns, name)


def previous(df: DataFrame, at: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``before``: the values of ``columns`` in the group's row before this one, as a struct; null in the first row."""
    rows = _placed(df, at).withColumn("_held", F.struct(*columns))
    latest = lambda a, b: F.coalesce(F.col(b), F.col(a))
    days = rows.groupBy(*by, "_day").agg(F.max_by("_held", at).alias("held"))
    last = F.last("held", ignorenulls=True)
    carried = _carried(days, by, last, last, latest)
    rows = rows.withColumn("_lag", F.lag("_held").over(W.partitionBy(*by, "_day").orderBy(at)))
    return rows.join(carried, _same(rows, [*by, "_day"], "_c_")).withColumn("before", F.coalesce("_lag", "_carry")).select(*df.columns, "before")
