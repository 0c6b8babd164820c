"""Serving tables to the figures shown on the dashboard."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR, RESIDENCE_TYPE
from regista.functions.scalar import (
    bed_deficit,
    deficit_label,
    one_decimal_percent,
    plus_sign,
    round_half_up,
    thresholds_around,
)
from regista.operators.aggregate import nearest_first, series_sum
from regista.operators.joins import lookup, value_difference
from regista.operators.panel import running_sum


def latest_year(df: DataFrame) -> Column:
    """The last year of a table, as a value usable in any filter or projection."""
    return df.agg(F.max("year")).scalar()


def reference_year(county_population: DataFrame) -> Column:
    """The census year nearest to 2000, the earlier one on a tie."""
    year = F.col("year")
    return county_population.agg(F.min_by(year, nearest_first(year))).scalar()


def headline_indicators(
    county_population: DataFrame,
    panel: DataFrame,
    county_coverage: DataFrame,
    service_type: str = RESIDENCE_TYPE,
) -> DataFrame:
    """One row with the figures of the whole territory.

    The census is reduced to one row per year first; every census figure is then taken from
    those few rows in one aggregation. The sign compares the rounded latest share with the
    one-decimal reference share, as the dashboard does.
    """
    yearly = county_population.groupBy("year").agg(
        F.sum(F.col("population").cast("bigint")).alias("population"),
        F.sum(F.col("population_ge65").cast("bigint")).alias("ge65"),
    )
    year = F.col("year")
    near = nearest_first(year)
    places = panel.where(F.col("service_type_id") == service_type).agg(
        F.sum(F.col("total_capacit").cast("bigint"))
    )
    figures = yearly.agg(
        F.max(year).alias("census_latest_year"),
        F.min_by(year, near).alias("reference_year"),
        F.max_by("population", year).alias("total_population_latest_year"),
        F.max_by("ge65", year).alias("elderly_population_latest_year"),
        F.min_by("population", near).alias("total_population_reference_year"),
        F.min_by("ge65", near).alias("elderly_population_reference_year"),
    ).withColumns({
        "coverage_latest_year": latest_year(county_coverage),
        "residence_places": places.scalar(),
    })
    latest_65 = F.col("elderly_population_latest_year")
    latest_pct = one_decimal_percent(latest_65, F.col("total_population_latest_year"))
    reference_pct = one_decimal_percent(
        F.col("elderly_population_reference_year"), F.col("total_population_reference_year")
    )
    return figures.withColumns({
        "latest_elderly_pct": latest_pct,
        "latest_elderly_pct_rounded": round_half_up(latest_pct),
        "reference_elderly_pct": reference_pct,
        "residence_coverage_pct": one_decimal_percent(F.col("residence_places"), latest_65),
        "bed_deficit": bed_deficit(latest_65, F.col("residence_places")),
    }).withColumns({
        "elderly_thresholds": F.array(*thresholds_around(F.col("latest_elderly_pct_rounded"))),
        "reference_sign": plus_sign(
            F.col("latest_elderly_pct_rounded"), F.col("reference_elderly_pct")
        ),
        "deficit_label": deficit_label(F.col("bed_deficit")),
    })


def with_elderly_pct(population: DataFrame) -> DataFrame:
    return population.withColumn(
        "elderly_pct", one_decimal_percent(F.col("population_ge65"), F.col("population"))
    )


def county_attention(county_population: DataFrame, county_coverage: DataFrame) -> DataFrame:
    """County coverage and places missing in the latest census year."""
    return county_coverage.where(F.col("year") == latest_year(county_population)).withColumn(
        "deficit_411", bed_deficit(F.col("population_ge65"), F.col("total_capacit"))
    )


def county_variation(county_population: DataFrame) -> DataFrame:
    """Elderly share per county in the latest and the reference census year, and the change."""
    return value_difference(
        with_elderly_pct(county_population), "comarca_id", "year", "elderly_pct",
        latest_year(county_population), reference_year(county_population),
    )


def county_indicators(county_population: DataFrame, county_coverage: DataFrame) -> DataFrame:
    """Latest coverage, deficit and population of each county with its elderly share over time."""
    latest = county_population.where(F.col("year") == latest_year(county_population)).select(
        "comarca_id", "population", F.col("population_ge65").alias("census_ge65")
    )
    attention = county_attention(county_population, county_coverage).select(
        "comarca_id", "total_capacit", "coverage_ratio", "deficit_411"
    )
    return (
        county_variation(county_population)
        .join(latest, "comarca_id", "left")
        .join(attention, "comarca_id", "left")
    )


def municipal_indicators(
    population: DataFrame, municipal_coverage: DataFrame, county_population: DataFrame
) -> DataFrame:
    """Elderly share and residence coverage per municipality in the latest census year."""
    census_year = latest_year(county_population)
    people = with_elderly_pct(population.where(F.col("year") == census_year)).select(
        F.col("municipal_code").alias("municipal_id"), "population", "population_ge65", "elderly_pct"
    )
    places = municipal_coverage.where(F.col("year") == census_year).select(
        "municipal_id", "total_capacit", "coverage_ratio"
    )
    return people.join(places, "municipal_id", "full")


def county_service_trend(panel: DataFrame, by: str = "service_type_id") -> DataFrame:
    """Places accumulated over the years per county and series.

    Summed per year first, so the running sum sees one row per series and year. For the
    initiatives of one service, filter the panel and pass ``service_qualification_id``.
    """
    series = ["comarca_id", by]
    yearly = series_sum(panel, series, "year", "total_capacit")
    return yearly.select(
        *series, "year", running_sum(F.col("total_capacit"), series).alias("accumulated_places")
    )


def county_population_trend(county_population: DataFrame, panel: DataFrame) -> DataFrame:
    """Census rows of each county from its first service year on."""
    first = panel.groupBy("comarca_id").agg(F.min("year").alias("first_service_year"))
    return (
        county_population.join(first, "comarca_id")
        .where(F.col("year") >= F.col("first_service_year"))
        .drop("first_service_year")
    )


def _present(mart: DataFrame, municipals: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    """Distinct (county, keys) with places in a calendar year, straight from the sparse mart rows.

    The panel has a row exactly for what has places in some calendar year.
    """
    named = ("municipal_id", "service_type_id", "service_qualification_id")
    active = mart.where(
        (F.col("total_capacit") > 0) & F.col("year").between(first, last)
        & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in named])
    ).select("municipal_id", *keys).distinct()
    counties = municipals.select(
        F.col("codi").alias("municipal_id"), F.col("codi_comarca").alias("comarca_id")
    ).distinct()
    return active.join(counties, "municipal_id").select("comarca_id", *keys).distinct()


def available_services(
    mart: DataFrame, municipals: DataFrame, service_types: DataFrame,
    first: int = CALENDAR_FIRST_YEAR, last: int = CALENDAR_LAST_YEAR,
) -> DataFrame:
    """Services with places, per county, with their description (NULL outside the catalog)."""
    found = _present(mart, municipals, ["service_type_id"], first, last)
    return _described(found, service_types, "service_type")


def available_initiatives(
    mart: DataFrame, municipals: DataFrame, qualifications: DataFrame,
    first: int = CALENDAR_FIRST_YEAR, last: int = CALENDAR_LAST_YEAR,
) -> DataFrame:
    """Initiatives present, per county and service, with their description."""
    found = _present(mart, municipals, ["service_type_id", "service_qualification_id"], first, last)
    return _described(found, qualifications, "service_qualification")


def _described(found: DataFrame, catalog: DataFrame, name: str) -> DataFrame:
    return lookup(found, catalog, f"{name}_id", f"{name}_id", {f"{name}_description": f"{name}_description"})
