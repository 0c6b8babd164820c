"""Landing to staging: the register and the census."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import SERVICE_QUALIFICATIONS, SERVICE_TYPES
from regista.functions.scalar import int_lenient, parse_date_strict
from regista.functions.text import strip_quotes
from regista.operators.cube import census_rows
from regista.operators.joins import lookup
from regista.operators.matching import attach_places, match_places
from regista.operators.project import clean_register
from regista.operators.quality import mapping_violations, require_minimum, require_no_violations
from regista.sources.catalogs import catalog_from_records, literal_catalog, write_snapshot
from regista.workspace import broadcast_if_small, settle


def coded_register(
    cleaned: DataFrame, service_types: DataFrame, qualifications: DataFrame
) -> DataFrame:
    """Cleaned register rows with type and qualification ids, exact copies removed."""
    def by_description(catalog: DataFrame, column: str) -> DataFrame:
        return catalog.withColumn(column, strip_quotes(F.col(column)))

    with_type = lookup(
        cleaned, by_description(service_types, "service_type_description"),
        "tipologia", "service_type_description", {"service_type_id": "service_type_id"},
    )
    with_both = lookup(
        with_type, by_description(qualifications, "service_qualification_description"),
        "qualificacio", "service_qualification_description",
        {"service_qualification_id": "service_qualification_id"},
    )
    return with_both.select(
        "registre", "inscripcio", "capacitat", "municipi", "comarca",
        "service_type_id", "service_qualification_id",
    ).distinct()


def typed_register(placed: DataFrame) -> DataFrame:
    """The staging columns: strict dates, lenient capacity."""
    return placed.select(
        F.col("registre").alias("social_service_register_id"),
        parse_date_strict(F.col("inscripcio")).alias("inscription_date"),
        int_lenient(F.col("capacitat")).alias("capacity"),
        "service_type_id",
        "service_qualification_id",
        F.col("codi").alias("municipal_id"),
        F.col("codi_comarca").alias("comarca_id"),
    )


def staging_register(
    raw: DataFrame,
    municipals: DataFrame,
    service_types: DataFrame,
    qualifications: DataFrame,
    validate: bool = True,
) -> DataFrame:
    """Raw register rows to staging rows.

    Types and qualifications must all be known. A row keeps the municipality of its county whose
    name shares most tokens with its own; rows equal in all raw fields and ids are kept once.

    The register is read twice. The first pass keeps only the distinct combinations of the text
    columns that need a catalog, settled as a small table; checking and matching work on that. The
    second pass shuffles the rows once, to remove copies, and meets the match table by broadcast
    if that is measured to be small.
    """
    cleaned = clean_register(raw)
    texts = settle(
        cleaned.select("tipologia", "qualificacio", "comarca", "municipi").distinct()
    )
    if validate:
        require_no_violations(mapping_violations(texts, service_types, qualifications))
    matches = broadcast_if_small(settle(match_places(texts, municipals)))
    coded = coded_register(cleaned, service_types, qualifications)
    return typed_register(attach_places(coded, matches))


def staging_population(cubes: DataFrame) -> DataFrame:
    """Census cubes of all years to one long table."""
    return census_rows(cubes)


def build_catalogs(
    municipal_records: DataFrame, folder: str, snapshot_ts: str, created_at: str | None = None
) -> dict[str, str]:
    """Writes a snapshot of the three catalogs under ``folder``; returns each one's row-count status.

    A catalog without rows stops the run before any snapshot is written.
    """
    spark = municipal_records.sparkSession
    catalogs = {
        "municipals": catalog_from_records(municipal_records, created_at=created_at),
        "service_type": literal_catalog(
            spark, SERVICE_TYPES, "service_type_id", "service_type_description", created_at
        ),
        "service_qualification": literal_catalog(
            spark, SERVICE_QUALIFICATIONS, "service_qualification_id",
            "service_qualification_description", created_at,
        ),
    }
    status = {name: require_minimum(catalog, f"catalog {name}") for name, catalog in catalogs.items()}
    for name, catalog in catalogs.items():
        write_snapshot(catalog, f"{folder}/{name}", snapshot_ts)
    return status
