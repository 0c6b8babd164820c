"""Unions and set differences."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, which share one schema; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)


def union_diagonal(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of ``column`` in ``left`` that ``right`` does not have."""
    values = left.select(column).where(left[column].isNotNull()).distinct()
    return values.join(right.select(column), column, "left_anti")
