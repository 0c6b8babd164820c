"""Marts to the serving tables of the dashboard.

Facts are summed to (place, year) before any running sum, so each place has one value per year.
Carrying values forward and accumulating run over those sparse rows; the calendar is filled in
afterwards by repeating each row until the next one.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR, RESIDENCE_TYPE
from regista.functions.scalar import percent_ratio
from regista.operators.aggregate import sum_ratio
from regista.operators.panel import hold_until_next, last_known, running_sum, zero_filled_from_first

#: serving measures are 32-bit and overflow is an error; pass "bigint" for larger totals
MEASURE_TYPE = "int"


def active_service_panel(
    mart: DataFrame,
    municipals: DataFrame,
    first: int = CALENDAR_FIRST_YEAR,
    last: int = CALENDAR_LAST_YEAR,
    measure_type: str = MEASURE_TYPE,
) -> DataFrame:
    """Capacity per municipality, type and qualification for every year from the first active one.

    Years without inscriptions are zero rows; a year with several mart rows keeps them all. Rows
    with a NULL id or a municipality outside the catalog drop out. The county is joined to the
    sparse rows, so one shuffle on the municipality serves the join and the gap filling.
    """
    keys = ["municipal_id", "service_type_id", "service_qualification_id"]
    facts = mart.select(*keys, "year", "total_capacit").where(
        " and ".join(f"{k} is not null" for k in keys)
    )
    counties = municipals.select(
        F.col("codi").alias("municipal_id"), F.col("codi_comarca").alias("comarca_id")
    ).distinct()
    placed = facts.join(counties, "municipal_id")
    keys.append("comarca_id")
    return zero_filled_from_first(placed, keys, "total_capacit", first, last).select(
        *keys,
        F.col("year").cast("int").alias("year"),
        F.col("total_capacit").cast(measure_type).alias("total_capacit"),
    )


def _coverage(
    population: DataFrame, mart: DataFrame, places: DataFrame, key: str,
    first: int, last: int, service_type: str, measure_type: str,
) -> DataFrame:
    in_calendar = F.col("year").between(first, last)
    census = population.where(in_calendar).select(
        key, F.col("year").cast("int").alias("year"),
        F.col("population_ge65").cast("bigint").alias("population_ge65"),
        F.lit(None).cast("bigint").alias("total_capacit"),
    )
    capacity = mart.where((F.col("service_type_id") == service_type) & in_calendar).select(
        key, F.col("year").cast("int").alias("year"),
        F.lit(None).cast("bigint").alias("population_ge65"),
        F.col("total_capacit").cast("bigint").alias("total_capacit"),
    )
    yearly = (
        census.unionByName(capacity)
        .where(F.col(key).isNotNull())
        .groupBy(key, "year")
        .agg(
            F.max("population_ge65").alias("population_ge65"),
            F.sum("total_capacit").alias("total_capacit"),
        )
    )
    carried = yearly.select(
        key, "year",
        running_sum(F.col("total_capacit"), [key]).alias("total_capacit"),
        last_known(F.col("population_ge65"), [key]).alias("population_ge65"),
    )
    known = carried.where(F.col("total_capacit").isNotNull()).join(places, key, "left_semi")
    return hold_until_next(known, [key], last).select(
        key, "year",
        F.col("total_capacit").cast(measure_type).alias("total_capacit"),
        F.col("population_ge65").cast(measure_type).alias("population_ge65"),
        percent_ratio(F.col("total_capacit"), F.col("population_ge65")).alias("coverage_ratio"),
    )


def municipal_coverage(
    population: DataFrame,
    mart: DataFrame,
    municipals: DataFrame,
    first: int = CALENDAR_FIRST_YEAR,
    last: int = CALENDAR_LAST_YEAR,
    service_type: str = RESIDENCE_TYPE,
    measure_type: str = MEASURE_TYPE,
) -> DataFrame:
    """Accumulated residence places per hundred people of 65 or over, by municipality and year.

    From a municipality's first places on; before its first census the ratio is NULL. Expects one
    census row per municipality and year.
    """
    by_id = population.withColumnRenamed("municipal_code", "municipal_id")
    places = municipals.select(F.col("codi").alias("municipal_id"))
    return _coverage(
        by_id, mart, places, "municipal_id", first, last, service_type, measure_type
    )


def comarca_population(
    population: DataFrame, municipals: DataFrame, measure_type: str = MEASURE_TYPE
) -> DataFrame:
    """County population per census year with ``elderly_fraction``, the share of 65 or over."""
    counties = municipals.select(
        F.col("codi").alias("municipal_code"), F.col("codi_comarca").alias("comarca_id")
    )
    sums = sum_ratio(
        population.join(counties, "municipal_code"),
        ["comarca_id", "year"], "population_ge65", "population", "elderly_fraction",
    )
    return sums.select(
        "comarca_id",
        F.col("population_ge65").cast(measure_type).alias("population_ge65"),
        F.col("year").cast("int").alias("year"),
        F.col("population").cast(measure_type).alias("population"),
        "elderly_fraction",
    )


def comarca_coverage(
    county_population: DataFrame,
    mart: DataFrame,
    municipals: DataFrame,
    first: int = CALENDAR_FIRST_YEAR,
    last: int = CALENDAR_LAST_YEAR,
    service_type: str = RESIDENCE_TYPE,
    measure_type: str = MEASURE_TYPE,
) -> DataFrame:
    """As :func:`municipal_coverage`, by county, on :func:`comarca_population`."""
    places = municipals.select(F.col("codi_comarca").alias("comarca_id"))
    return _coverage(
        county_population, mart, places, "comarca_id", first, last, service_type, measure_type
    )


def serving_population(population: DataFrame, measure_type: str = MEASURE_TYPE) -> DataFrame:
    """The census table with integer measures."""
    return population.select(
        "municipal_code",
        *[F.col(c).cast(measure_type).alias(c) for c in ("population_ge65", "population")],
        F.col("year").cast("int").alias("year"),
    )


def calendar_last(population: DataFrame, mart: DataFrame) -> int:
    """The last year of the data, at least the calendar's own."""
    years = population.select(F.col("year").cast("int")).unionAll(mart.select(F.col("year").cast("int")))
    return years.agg(F.greatest(F.max("year"), F.lit(CALENDAR_LAST_YEAR)).alias("y")).first()["y"]


def outside_calendar(population: DataFrame, mart: DataFrame, first: int, last: int) -> DataFrame:
    """(dataset, year, row_count) of the years with rows that the calendar leaves out."""
    def of(name: str, df: DataFrame) -> DataFrame:
        return df.where(~F.col("year").between(first, last)).groupBy(F.col("year").cast("int").alias("year")).agg(
            F.count("*").alias("row_count")
        ).select(F.lit(name).alias("dataset"), "year", "row_count")

    return of("population", population).unionByName(of("mart", mart))


def serving_tables(
    population: DataFrame,
    mart: DataFrame,
    municipals: DataFrame,
    service_types: DataFrame,
    qualifications: DataFrame,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
    first: int = CALENDAR_FIRST_YEAR,
    last: int | None = None,
    service_type: str = RESIDENCE_TYPE,
    measure_type: str = MEASURE_TYPE,
) -> dict[str, DataFrame]:
    """The eight serving tables by name.

    The calendar ends with the last year of the data unless ``last`` is given. The catalogs given should each be one snapshot. ``comarca_population`` also feeds the county
    coverage; ``keep`` (such as :func:`regista.workspace.settle`) saves computing it twice when
    all tables are written in one run.
    """
    last = calendar_last(population, mart) if last is None else last
    by_county = keep(comarca_population(population, municipals, measure_type))
    span = (first, last)
    return {
        "social_services_empty_last_year": active_service_panel(mart, municipals, *span, measure_type),
        "municipal_coverage": municipal_coverage(
            population, mart, municipals, *span, service_type, measure_type
        ),
        "comarca_population": by_county,
        "comarca_coverage": comarca_coverage(
            by_county, mart, municipals, *span, service_type, measure_type
        ),
        "municipal": municipals,
        "service_type": service_types,
        "service_qualification": qualifications,
        "population": serving_population(population, measure_type),
    }
