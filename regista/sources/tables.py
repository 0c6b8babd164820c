"""Staging, mart and serving tables."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regista.sources import generations


def write_parquet_snappy(df: DataFrame, path: str) -> None:
    """One plain Snappy Parquet folder, for what no one reads while it is written."""
    df.write.option("compression", "snappy").mode("overwrite").parquet(path)


def replace_table(df: DataFrame, path: str, seen: Observation | None = None) -> None:
    """One Snappy Parquet dataset, replaced without a gap; read it with :func:`read_table`."""
    generations.replace(df, path, seen)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str | None = None) -> DataFrame:
    """The current rows of a table, or of a plain Parquet folder; ``key`` is its partition column, if any."""
    return generations.read(spark, path, schema, key)


def write_partition(
    df: DataFrame, base: str, key: str, value: str | None = None, seen: Observation | None = None
) -> None:
    """Writes ``key=value`` partitions, replacing only those present in ``df``.

    With a ``value``, ``df`` is that partition and takes its place as a whole, also if it is empty.
    The old partitions stay readable until the new ones are complete. Writing a partition a second time gives the
    same table, so a failed run can be repeated.
    """
    if value is None:
        generations.write_partitions(df, base, key, seen=seen)
    else:
        generations.write_partitions(df.withColumn(key, F.lit(value)), base, key, gone=(value,), seen=seen)


def read_partition(
    spark: SparkSession, base: str, key: str, value: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of one ``key=value`` partition; only that folder is read and ``key`` stays text."""
    return read_table(spark, base, schema, key).where(F.col(key) == F.lit(value))


def publish_mart(spark: SparkSession, source: str, target: str) -> None:
    """Promotes a staging dataset to the marts unchanged; the old mart stays readable until then."""
    replace_table(read_table(spark, source), target)


# --- Fixed values: row order of the serving tables ---
SERVING_ORDER = {
    "social_services_empty_last_year": ("year", "comarca_id", "municipal_id", "service_type_id"),
    "municipal_coverage": ("municipal_id", "year"),
    "comarca_population": ("comarca_id", "year"),
    "comarca_coverage": ("comarca_id", "year"),
}


def in_serving_order(name: str, df: DataFrame) -> DataFrame:
    """The table in its serving order, as one global sort."""
    return df.orderBy(*SERVING_ORDER[name])


def write_serving_json(tables: Mapping[str, DataFrame], base: str) -> None:
    """Each serving table as a folder of JSON row objects; NULLs are written out.

    All tables become current together, so no reader sees some of this run and some of the last. A
    table's rows are dealt by range of its serving order and sorted; its files read by name are in that order.
    """
    def write(name: str, df: DataFrame, path: str) -> None:
        ordered = in_serving_order(name, df) if name in SERVING_ORDER else df
        ordered.write.option("ignoreNullFields", False).json(path)

    generations.publish_together(tables, base, write)


def read_serving_json(
    spark: SparkSession, base: str, name: str, schema: T.StructType | None = None, version: generations.Version | None = None,
) -> DataFrame:
    """One serving table. Several tables of one run are read through one ``version``."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json((version or generations.Version(spark, base)).path(name))


def write_csv_distinct(df: DataFrame, column: str, path: str) -> None:
    """The distinct values of one column as CSV with a header."""
    df.select(column).distinct().write.option("header", True).mode("overwrite").csv(path)


def audit_row(df: DataFrame, dataset: str) -> DataFrame:
    """One row: dataset, row count, column list and the time of the check."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        F.lit(",".join(df.columns)).alias("columns"),
        F.current_timestamp().alias("processed_at"),
    )


def write_audited(df: DataFrame, dataset: str, audit_path: str, write: Callable[[DataFrame, Observation], object]) -> int:
    """Writes ``df`` by ``write(df, seen)`` and records what went into the sink; returns the rows written.

    Rows are counted while they pass into the sink, so nothing is read a second time. The count is part of
    the tasks that write: of a task that is retried only the attempt that succeeded counts. A write that
    fails records nothing.
    """
    seen = Observation()
    write(df, seen)
    rows = seen.get["row_count"]
    df.sparkSession.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(rows).cast("bigint").alias("row_count"),
        F.lit(",".join(df.columns)).alias("columns"), F.current_timestamp().alias("processed_at"),
    ).write.mode("append").parquet(audit_path)
    return rows


def append_audit(written: DataFrame, dataset: str, audit_path: str) -> None:
    """Records what a sink holds that others wrote: ``written`` reads its files."""
    audit_row(written, dataset).write.mode("append").parquet(audit_path)
