"""Exact order statistics without a global sort or a one-task list.

Values are first counted, so equal values shrink to one row before the shuffle. A monotone ``cell``
of the value splits the counts into many small ranges; only the cell totals (a bounded table) are
accumulated in order, and only the cells that hold a wanted rank are looked into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def magnitude_cell(value: Column) -> Column:
    """Monotone cell of any number, 0.05 % wide; at most a few hundred thousand cells in practice."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * 2000)).cast("bigint")


def fraction_cell(value: Column) -> Column:
    """Monotone cell for scores of unit scale."""
    return F.floor(value * 20000).cast("bigint")


def minute_cell(value: Column) -> Column:
    """Monotone cell for microseconds: the minute, at most 60 million distinct values."""
    return F.floor(value / 60_000_000).cast("bigint")


def id_cell(value: Column) -> Column:
    return F.floor(value / 1_000_000).cast("bigint")


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(by..., value, n): one row per distinct non-null value."""
    counted = F.sum(weight) if weight else F.count(F.lit(1))
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(counted.alias("n"))


def ranked_counts(counts: DataFrame, cell: Column, by: Sequence[str] = (), wanted: Column | None = None) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to value counts.

    ``wanted`` is a predicate over the cell row (``cell_before``, ``cell_n``, ``total``) that keeps
    only the cells that hold a wanted rank.
    """
    # A cell known to be non-null adds no filter, so both uses of the counts share one shuffle.
    counts = counts.withColumn("cell", F.coalesce(cell, F.lit(0)))
    in_order = W.partitionBy(*by).orderBy("cell")
    cells = (
        counts.groupBy(*by, "cell")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("cell_before", F.coalesce(F.sum("cell_n").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", F.sum("cell_n").over(W.partitionBy(*by)))
    )
    if wanted is not None:
        cells = cells.filter(wanted)
        if not by:
            cells = F.broadcast(cells)  # at most one cell per wanted rank
    inside = W.partitionBy(*by, "cell").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    return (
        counts.join(cells, [*by, "cell"])
        .withColumn("before", F.col("cell_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .drop("cell", "cell_n", "cell_before")
    )


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
    cell=magnitude_cell,
) -> DataFrame:
    """(by..., prob, quantile) with linear interpolation between neighbours."""
    def ranks(total: Column, prob: float) -> tuple[Column, Column, Column]:
        position = F.lit(float(prob)) * (total - 1).cast("double")
        return position, F.floor(position).cast("bigint"), F.ceil(position).cast("bigint")

    def holds(first: Column, size: Column, rank: Column) -> Column:
        return (rank >= first) & (rank < first + size)

    wanted = F.lit(False)
    for prob in probs:
        _, low, high = ranks(F.col("total"), prob)
        for rank in (low, high):
            wanted = wanted | holds(F.col("cell_before"), F.col("cell_n"), rank)

    ranked = ranked_counts(value_counts(df, value, by, weight), cell(F.col("value")), by, wanted)
    parts = []
    for i, prob in enumerate(probs):
        position, low, high = ranks(F.col("total"), prob)
        held = F.col("value").cast("double")
        parts += [
            F.max(F.when(holds(F.col("before"), F.col("n"), low), held)).alias(f"low_{i}"),
            F.max(F.when(holds(F.col("before"), F.col("n"), high), held)).alias(f"high_{i}"),
            F.max(position - low).alias(f"part_{i}"),
        ]
    found = ranked.groupBy(*by).agg(*parts)
    rows = F.array(*[
        F.struct(
            F.lit(float(prob)).alias("prob"),
            (F.col(f"low_{i}") + (F.col(f"high_{i}") - F.col(f"low_{i}")) * F.col(f"part_{i}")).alias("quantile"),
        )
        for i, prob in enumerate(probs)
    ])
    return found.select(*by, F.inline(rows))


def rank_cuts(
    df: DataFrame,
    major: Column,
    minor: Column,
    ranks: dict[str, Column],
    major_cell=minute_cell,
    minor_cell=id_cell,
) -> DataFrame:
    """The row at each 0-based rank in (major, minor) order: (cut, major, minor).

    ``ranks`` maps a cut name to its rank, written over the column ``total``. A rank past the last
    row yields no row. Ties of the major value are resolved by a second pass over the ids of that
    value only, again by counted cells.
    """
    keyed = df.select(major.alias("major"), minor.cast("bigint").alias("minor"))

    def targets() -> Column:
        return F.array(*[
            F.struct(F.lit(name).alias("cut"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()
        ])

    wanted = F.exists(
        targets(), lambda t: (t["rank"] >= F.col("cell_before")) & (t["rank"] < F.col("cell_before") + F.col("cell_n"))
    )
    majors = (
        ranked_counts(value_counts(keyed, "major"), major_cell(F.col("value")), wanted=wanted)
        .select("value", "n", "before", F.inline(targets()))
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("cut", F.col("value").alias("major"), (F.col("rank") - F.col("before")).alias("rest"))
    )
    tied = keyed.join(F.broadcast(majors), "major")  # one row per cut
    inside = (F.col("rest") >= F.col("cell_before")) & (F.col("rest") < F.col("cell_before") + F.col("cell_n"))
    keys = ["cut", "major", "rest"]
    return (
        ranked_counts(value_counts(tied, "minor", keys), minor_cell(F.col("value")), keys, wanted=inside)
        .filter(F.col("rest") == F.col("before"))
        .select("cut", "major", F.col("value").alias("minor"))
    )


def cut_scalar(cuts: DataFrame) -> Column:
    """All cuts as one scalar map: cut name -> (major, minor)."""
    entries = F.collect_list(F.struct(F.col("cut"), F.struct("major", "minor").alias("at")))
    return cuts.agg(F.map_from_entries(entries)).scalar()
