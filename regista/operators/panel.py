"""Sparse yearly facts on a calendar: densify, carry forward, accumulate.

Windows here run per key over rows already summed to (key, year), so a group never holds more
rows than the calendar has years.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regista.fixed_values import CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR


def calendar_grid(
    keys: DataFrame,
    first: int = CALENDAR_FIRST_YEAR,
    last: int = CALENDAR_LAST_YEAR,
    year: str = "year",
) -> DataFrame:
    """Every key row in every year: an explode on each row, not a join."""
    return keys.withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))


def densify(grid: DataFrame, facts: DataFrame, on: Sequence[str], fill: dict | None = None) -> DataFrame:
    """The grid with the facts of each cell; a missing fact is NULL, or the value in ``fill``."""
    out = grid.join(facts, list(on), "left")
    for name, value in (fill or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def _up_to_here(keys: Sequence[str], year: str):
    return (
        Window.partitionBy(*keys).orderBy(year).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def last_known(c: Column, keys: Sequence[str], year: str = "year") -> Column:
    """The last non-NULL value up to this year; NULL before the first one."""
    return F.last(c, ignorenulls=True).over(_up_to_here(keys, year))


def running_sum(c: Column, keys: Sequence[str], year: str = "year") -> Column:
    """Sum up to this year; NULL until the first value."""
    return F.sum(c).over(_up_to_here(keys, year))


def hold_until_next(
    facts: DataFrame, keys: Sequence[str], last: int, year: str = "year"
) -> DataFrame:
    """Repeats each key's row for every year up to its next row, or up to ``last``.

    Carrying values over the sparse rows and expanding afterwards gives the same table as filling
    a dense calendar, but the window sorts only the observed years and no grid is joined.
    Expects one row per key and year.
    """
    w = Window.partitionBy(*keys).orderBy(year)
    until = F.coalesce(F.lead(year).over(w) - 1, F.lit(last))
    spans = facts.withColumn("__until", until)
    columns = [F.explode(F.sequence(F.col(year), F.col("__until"))).alias(year) if c == year else c
               for c in facts.columns]
    return spans.select(*columns)


def zero_filled_from_first(
    facts: DataFrame,
    keys: Sequence[str],
    measure: str,
    first: int = CALENDAR_FIRST_YEAR,
    last: int = CALENDAR_LAST_YEAR,
    year: str = "year",
) -> DataFrame:
    """Each key's rows from its first year with a positive measure on, plus a zero row per gap year.

    One shuffle on the keys serves both windows. A key without a positive year gives no row; rows
    outside the calendar are left out. Several rows of one year all stay.
    """
    whole = Window.partitionBy(*keys)
    following = F.lead(year).over(whole.orderBy(year, measure))
    inside = facts.where(F.col(year).between(first, last)).select(
        "*",
        F.min(F.when(F.col(measure) > 0, F.col(year))).over(whole).alias("__first"),
        # the last row of a year also stands for the empty years behind it
        F.when(following.isNull(), F.lit(last))
        .otherwise(F.greatest(following - 1, F.col(year))).alias("__until"),
    ).where(F.col(year) >= F.col("__first"))
    wide = inside.withColumn("__year", F.explode(F.sequence(F.col(year), F.col("__until"))))
    observed = F.col("__year") == F.col(year)
    return wide.select(*[
        F.col("__year").alias(c) if c == year
        else F.when(observed, F.col(c)).otherwise(F.lit(0)).alias(c) if c == measure
        else F.col(c)
        for c in facts.columns
    ])
