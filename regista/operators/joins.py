"""Lookup, membership and difference joins.

No join carries a forced broadcast hint here. Spark broadcasts a side when its own size figure
is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles on the key, where AQE
splits hot partitions. Plain equality is used throughout: NULL keys never match.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    take: Mapping[str, str],
) -> DataFrame:
    """Left join that adds ``take`` (new name -> dimension column) to ``facts``.

    Unmatched and NULL keys give NULL. A dimension key that occurs n times gives n rows.
    """
    side = dimension.select(
        F.col(dimension_key).alias("__key"), *[F.col(c).alias(n) for n, c in take.items()]
    )
    return facts.join(side, facts[fact_key] == side["__key"], "left").drop("__key")


def unmapped_values(
    facts: DataFrame,
    column: str,
    dimension: DataFrame,
    dimension_column: str,
    allow_null: bool = False,
) -> DataFrame:
    """Distinct values of ``column`` the dimension lacks; a NULL row too unless allowed."""
    values = facts.select(F.col(column).alias("value")).distinct()
    known = dimension.select(F.col(dimension_column).alias("value"))
    missing = values.join(known, "value", "left_anti")
    return missing.where(F.col("value").isNotNull()) if allow_null else missing


def members_only(df: DataFrame, column: str, members: DataFrame, member_column: str) -> DataFrame:
    """Rows whose ``column`` is in the member list."""
    return df.join(members, df[column] == members[member_column], "left_semi")


def value_difference(
    df: DataFrame,
    key: str,
    year: str,
    value: str,
    latest: Column,
    reference: Column,
) -> DataFrame:
    """Per key, the value in two years and their difference, in one aggregation, no self join.

    Expects one row per key and year.
    """
    def at(y: Column, name: str) -> Column:
        return F.max(F.when(F.col(year) == y, F.col(value))).alias(name)

    both = df.groupBy(key).agg(at(latest, "latest_value"), at(reference, "reference_value"))
    return both.withColumn("variation", F.col("latest_value") - F.col("reference_value"))


def attach_to_features(
    features: DataFrame, feature_id: str, indicators: DataFrame, key: str, values: Sequence[str]
) -> DataFrame:
    """Adds indicator values to boundary features; a feature without any keeps NULL (unknown)."""
    return lookup(features, indicators, feature_id, key, {v: v for v in values})
