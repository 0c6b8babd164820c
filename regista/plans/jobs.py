"""The jobs end to end: each reads one layer's folders and writes the next.

    landing/<dataset>/downloaded_date=…  ->  staging/<dataset>  ->  marts/<dataset>  ->  serving/

Every job replaces what it writes, by one rename when all of it is written, so a job that failed half-way
leaves what was there and is simply run again. A job checks
what it is about to publish first: where a check fails, what was published before stays as it is.
Tables settled on the way are deleted when the job ends.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regista.fixed_values import BOUNDARY_LEVELS, CALENDAR_FIRST_YEAR, RESIDENCE_TYPE
from regista.operators.geometry import boundary_features
from regista.operators.quality import (
    require_distinct_preserved,
    require_members,
    require_minimum,
    require_rows,
)
from regista.plans.marts import capacity_mart
from regista.plans.serving import MEASURE_TYPE, calendar_last, outside_calendar, serving_tables
from regista.plans.staging import staging_population, staging_register
from regista.schemas import (
    CAPACITY_MART,
    MUNICIPALS,
    POPULATION,
    SERVICE_QUALIFICATION,
    SERVICE_TYPE,
    STAGING_REGISTER,
)
from regista.sources import tables
from regista.sources.catalogs import read_latest_snapshot
from regista.sources.landing import PARTITION, read_census_cubes, read_landing_json
from regista.workspace import scratch, settle

REGISTER = "social_services"
CAPACITY = "social_services_by_service_municipal"
CENSUS = "population_municipal_greater_65"
BOUNDARIES = "comarques_boundaries"


def read_catalogs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The latest snapshot of municipals, service types and service qualifications."""
    return (
        read_latest_snapshot(spark, f"{folder}/municipals", MUNICIPALS),
        read_latest_snapshot(spark, f"{folder}/service_type", SERVICE_TYPE),
        read_latest_snapshot(spark, f"{folder}/service_qualification", SERVICE_QUALIFICATION),
    )


def stage_register(spark: SparkSession, base: str, catalogs: str, downloaded_date: str) -> None:
    """Stages the register pages of one date as the partition of that date.

    The pages are parsed once; every later pass reads the settled columns it needs.
    """
    with scratch(spark):
        raw = settle(read_landing_json(spark, f"{base}/landing/{REGISTER}/{PARTITION}={downloaded_date}"))
        require_minimum(raw, "the landing folder")
        staged = settle(staging_register(raw, *read_catalogs(spark, catalogs)))
        require_distinct_preserved(raw, "registre", staged, "social_service_register_id")
        target = f"{base}/staging/{REGISTER}"
        tables.write_audited(
            staged, f"{REGISTER}/{downloaded_date}", f"{base}/audit",
            lambda df, seen: tables.write_partition(df, target, PARTITION, downloaded_date, seen))


def build_capacity_mart(spark: SparkSession, base: str, downloaded_date: str) -> None:
    """Builds the capacity mart from the staging partition of one date."""
    staged = tables.read_partition(
        spark, f"{base}/staging/{REGISTER}", PARTITION, downloaded_date, STAGING_REGISTER
    )
    tables.write_audited(
        capacity_mart(staged), CAPACITY, f"{base}/audit",
        lambda df, seen: tables.replace_table(df, f"{base}/marts/{CAPACITY}", seen))


def build_population(spark: SparkSession, base: str, announced: Iterable[int] | None = None) -> None:
    """Decodes all landed census years and publishes them as they are.

    ``announced`` names the years that must be among them.
    """
    cubes = read_census_cubes(spark, f"{base}/landing/{CENSUS}")
    require_rows(cubes, "the census landing folder")
    staged = f"{base}/staging/{CENSUS}"
    with scratch(spark):
        decoded = settle(staging_population(cubes))
        if announced is not None:
            years = spark.createDataFrame([(int(y),) for y in announced], "year bigint")
            require_members(years, decoded.select("year").distinct(), "year")
        tables.write_audited(decoded, CENSUS, f"{base}/audit", lambda df, seen: tables.replace_table(df, staged, seen))
    tables.publish_mart(spark, staged, f"{base}/marts/{CENSUS}")


def build_boundaries(shapes_by_level: dict[str, DataFrame], base: str) -> None:
    """Stages the features of each boundary level and publishes them as they are.

    ``feature`` holds one GeoJSON feature per row.
    """
    for level, shapes in shapes_by_level.items():
        if level not in BOUNDARY_LEVELS:
            raise ValueError(f"unknown boundary level {level}")
        staged = f"{base}/staging/{BOUNDARIES}/{level}"
        tables.replace_table(boundary_features(shapes, level), staged)
        tables.publish_mart(shapes.sparkSession, staged, f"{base}/marts/{BOUNDARIES}/{level}")


def build_serving(
    spark: SparkSession,
    base: str,
    catalogs: str,
    first: int = CALENDAR_FIRST_YEAR,
    last: int | None = None,
    service_type: str = RESIDENCE_TYPE,
    measure_type: str = MEASURE_TYPE,
) -> None:
    """Derives the serving tables from the marts and writes them as JSON rows.

    The calendar runs from ``first`` to ``last``, by default to the last year of the data. Rows
    outside it are in no panel or coverage table; ``audit_outside_calendar`` says how many.
    """
    population = tables.read_table(spark, f"{base}/marts/{CENSUS}", POPULATION)
    mart = tables.read_table(spark, f"{base}/marts/{CAPACITY}", CAPACITY_MART)
    last = calendar_last(population, mart) if last is None else last
    with scratch(spark):
        outside_calendar(population, mart, first, last).withColumn(
            "processed_at", F.current_timestamp()
        ).write.mode("append").parquet(f"{base}/audit_outside_calendar")
        derived = serving_tables(
            population, mart, *read_catalogs(spark, catalogs), keep=settle, first=first, last=last,
            service_type=service_type, measure_type=measure_type,
        )
        tables.write_serving_json(derived, f"{base}/serving")
