"""Grouped and global aggregations.

All of them are partial aggregations before the shuffle, so a hot key arrives as one row per map
task. Distinct counts go through a distinct on (group, value) first.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import REFERENCE_YEAR
from regista.functions.scalar import round_places

CAPACITY_KEYS = ("service_qualification_id", "service_type_id", "comarca_id", "municipal_id")


def capacity_by_month(rows: DataFrame, keys: Sequence[str] = CAPACITY_KEYS) -> DataFrame:
    """Capacity per key, year and month of inscription; NULL keys form groups."""
    return rows.groupBy(
        *keys,
        F.year("inscription_date").alias("year"),
        F.month("inscription_date").alias("month"),
    ).agg(F.sum(F.col("capacity").cast("bigint")).alias("total_capacit"))


def sum_ratio(
    df: DataFrame, keys: Sequence[str], part: str, whole: str, name: str, places: int = 2
) -> DataFrame:
    """Sums of two measures per key and the rounded ratio of the sums."""
    sums = df.groupBy(*keys).agg(
        F.sum(F.col(part).cast("bigint")).alias(part),
        F.sum(F.col(whole).cast("bigint")).alias(whole),
    )
    ratio = F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))
    return sums.withColumn(name, round_places(ratio, places))


def first_active_year(df: DataFrame, keys: Sequence[str], year: str, measure: str) -> DataFrame:
    """First year with a positive measure, per key."""
    return df.where(F.col(measure) > 0).groupBy(*keys).agg(F.min(year).alias("first_year"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value, one row."""
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def nearest_first(year: Column, target: int = REFERENCE_YEAR) -> Column:
    """Ordering value for the year nearest to ``target``; the earlier one on a tie."""
    return F.struct(F.abs(year - F.lit(target)), year)


def nearest_year(df: DataFrame, column: str, target: int = REFERENCE_YEAR) -> DataFrame:
    return df.agg(F.min_by(column, nearest_first(F.col(column), target)).alias("nearest_year"))


def series_sum(df: DataFrame, series: Sequence[str], year: str, measure: str) -> DataFrame:
    """Sum of the measure per series and year."""
    return df.groupBy(*series, year).agg(F.sum(F.col(measure).cast("bigint")).alias(measure))


def distinct_list(df: DataFrame, column: str, most: int | None = None) -> DataFrame:
    """The distinct values as one sorted array; for columns of few values, such as years.

    Values are made distinct before they are gathered, so the array holds each one once and no task
    ever sees the repeated rows. An array is one row: a column whose values grow with the data is
    better read as the rows of ``select(column).distinct()``. With ``most``, more values fail the job before anything is
    gathered.
    """
    values = df.select(column).distinct()
    if most is not None:
        counted = values.agg(F.count("*").alias("n"))
        too_many = F.raise_error(F.concat(F.lit(f"{column} has more than {most} distinct values: "), F.col("n").cast("string")))
        checked = counted.select(F.when(F.col("n") > most, too_many.cast("boolean")).otherwise(True).alias("ok"))
        values = values.where(checked.scalar())
    return values.agg(F.array_sort(F.collect_list(column)).alias("values"))


def all_match(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Per column, whether every non-NULL value contains its pattern: one pass, one row per column.

    A column without values has none that fails, so it matches.
    """
    checks = [
        F.coalesce(F.bool_and(F.col(c).rlike(p)), F.lit(True)).alias(f"m{i}")
        for i, (c, p) in enumerate(patterns.items())
    ]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("pattern"), F.col(f"m{i}").alias("matches"))
        for i, (c, p) in enumerate(patterns.items())
    ])
    return df.agg(*checks).select(F.inline(rows))
