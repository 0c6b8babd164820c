"""Values, colour classes and tooltips of the three maps."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import COVERAGE_THRESHOLDS
from regista.functions.scalar import round_half_up, threshold_class, thresholds_around
from regista.operators.joins import attach_to_features, lookup


def place_labels(municipals: DataFrame, code: str, name: str) -> DataFrame:
    """(id, label) pairs, each once."""
    return municipals.select(F.col(code).alias("id"), F.col(name).alias("label")).distinct()


def county_map(
    features: DataFrame,
    indicators: DataFrame,
    municipals: DataFrame,
    elderly_center: Column,
) -> DataFrame:
    """County features with elderly share, its change, coverage and their colour classes.

    Covers the population map, the variation map (no classes: a continuous scale around 0) and
    the coverage map. A county without figures keeps NULL, which the map shows as unknown.
    ``elderly_center`` is the rounded share of the whole territory.
    """
    values = ["population", "census_ge65", "latest_value", "variation", "total_capacit", "coverage_ratio"]
    joined = attach_to_features(features, "comarca_id", indicators, "comarca_id", values)
    named = lookup(
        joined, place_labels(municipals, "codi_comarca", "nom_comarca"),
        "comarca_id", "id", {"label": "label"},
    )
    return named.withColumn("__center", elderly_center).withColumns({
        "elderly_class": threshold_class(F.col("latest_value"), thresholds_around(F.col("__center"))),
        "coverage_class": threshold_class(F.col("coverage_ratio"), COVERAGE_THRESHOLDS),
        "variation_shown": round_half_up(F.col("variation")),
    }).drop("__center").withColumnRenamed("latest_value", "elderly_pct")


def municipal_map(
    features: DataFrame,
    indicators: DataFrame,
    municipals: DataFrame,
    elderly_center: Column,
) -> DataFrame:
    """Municipality features with elderly share, coverage and their colour classes."""
    values = ["population", "population_ge65", "elderly_pct", "total_capacit", "coverage_ratio"]
    joined = attach_to_features(features, "municipal_id", indicators, "municipal_id", values)
    named = lookup(
        joined, place_labels(municipals, "codi", "nom"), "municipal_id", "id", {"label": "label"}
    )
    return named.withColumn("__center", elderly_center).withColumns({
        "elderly_class": threshold_class(F.col("elderly_pct"), thresholds_around(F.col("__center"))),
        "coverage_class": threshold_class(F.col("coverage_ratio"), COVERAGE_THRESHOLDS),
    }).drop("__center")
