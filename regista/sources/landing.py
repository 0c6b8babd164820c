"""Landing files: dated folders of JSON pages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regista.fixed_values import CENSUS_FILE_GLOB, REGISTER_FILE_GLOB
from regista.schemas import CENSUS_CUBE, REGISTER_LANDING

PARTITION = "downloaded_date"
#: an array page is parsed by one task, which holds all its records; larger pages must be JSON lines
MAX_PAGE_BYTES = 256 << 20
#: the same for a page that is taken apart as a variant, which also has a largest size of its own
MAX_VARIANT_PAGE_BYTES = 64 << 20


def require_page_size(spark: SparkSession, path: str, file_glob: str, max_bytes: int) -> None:
    """Raises ValueError if a page is larger than ``max_bytes``. Only the listing is read, no page."""
    pages = (spark.read.format("binaryFile").option("pathGlobFilter", file_glob).option("recursiveFileLookup", True)
             .load(path).where(F.col("length") > max_bytes).select("path", "length"))
    if large := pages.limit(5).collect():
        names = ", ".join(f"{r['path']} ({r['length']} bytes)" for r in large)
        raise ValueError(f"array pages over {max_bytes} bytes, land them as JSON lines or in smaller pages: {names}")


def read_landing_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REGISTER_LANDING,
    file_glob: str = REGISTER_FILE_GLOB,
    json_lines: bool = False,
    max_page_bytes: int = MAX_PAGE_BYTES,
) -> DataFrame:
    """All landing pages under ``path`` whose file name matches, pruned to ``schema``.

    A page that is one JSON array is one task; one over ``max_page_bytes`` is refused before anything
    is read. Pages written as JSON lines (``json_lines=True``) are split like any text file, at any size. Files of other names are skipped;
    a column a file lacks is NULL. A broken page fails the job.
    """
    if not json_lines:
        require_page_size(spark, path, file_glob, max_page_bytes)
    return (
        spark.read.schema(schema)
        .option("multiLine", not json_lines)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", file_glob)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def read_landing_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REGISTER_LANDING,
    file_glob: str = REGISTER_FILE_GLOB,
    max_page_bytes: int = MAX_VARIANT_PAGE_BYTES,
) -> DataFrame:
    """The records of landing pages, typed one by one, with bad ones set aside instead of failing the job.

    Columns of ``schema``, then ``_page`` (path), ``_position`` in the page from 0, ``_fault`` and
    ``_record`` (the faulty record's JSON). ``_fault`` is NULL for a good record, else ``page`` (the
    page is no JSON: one row, no position), ``record`` (no object) or the name of the first field whose
    value is not of its type; all columns of ``schema`` are NULL then. A field that is missing or null
    is NULL and no fault. A page is an array or a single object; an empty array gives no rows. Pages
    over ``max_page_bytes`` are refused before anything is read.
    """
    require_page_size(spark, path, file_glob, max_page_bytes)
    texts = (spark.read.option("wholetext", True).option("pathGlobFilter", file_glob)
             .option("recursiveFileLookup", True).text(path))
    array = F.when(F.col("value").rlike(r"^\s*\["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    pages = texts.select(F.col("_metadata.file_path").alias("_page"), F.try_parse_json(array).alias("__page"))
    records = pages.lateralJoin(spark.tvf.variant_explode_outer(F.col("__page").outer())).where(
        F.col("pos").isNotNull() | F.col("__page").isNull())
    record = F.col("value")

    def at(field: T.StructField, kind: str) -> Column:
        return F.try_variant_get(record, f'$["{field.name}"]', kind)

    def wrong(field: T.StructField) -> Column:
        given = at(field, "variant")
        return given.isNotNull() & ~F.is_variant_null(given) & at(field, field.dataType.simpleString()).isNull()

    fault = F.when(F.col("__page").isNull(), "page").when(~F.schema_of_variant(record).startswith("OBJECT<"), "record")
    for field in schema:
        fault = fault.when(wrong(field), field.name)
    return records.withColumn("_fault", fault).select(
        *[F.when(F.col("_fault").isNull(), at(f, f.dataType.simpleString())).alias(f.name) for f in schema],
        "_page", F.col("pos").cast("bigint").alias("_position"), "_fault",
        F.when(F.col("_fault").isNotNull(), F.to_json(record)).alias("_record"))


def read_census_cubes(spark: SparkSession, path: str) -> DataFrame:
    """One row per census cube file."""
    return read_landing_json(spark, path, CENSUS_CUBE, CENSUS_FILE_GLOB)


def count_per_file(landing: DataFrame) -> DataFrame:
    """Rows read from each landing file."""
    return landing.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("row_count")
    )
