"""Catalogs: small dimensions kept as dated snapshots."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = "snapshot_ts"
MUNICIPAL_COLUMNS = ("codi", "nom", "codi_comarca", "nom_comarca")


def _now_text() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def literal_catalog(
    spark: SparkSession,
    rows: Mapping[str, str],
    id_column: str,
    description_column: str,
    created_at: str | None = None,
) -> DataFrame:
    """A dimension of id -> description rows, stamped with ``created_at``; must not be empty."""
    if not rows:
        raise ValueError("a catalog needs at least one row")
    schema = T.StructType(
        [T.StructField(id_column, T.StringType()), T.StructField(description_column, T.StringType())]
    )
    stamp = F.lit(created_at) if created_at else _now_text()
    return spark.createDataFrame(list(rows.items()), schema).withColumn("created_at", stamp)


def catalog_from_records(
    records: DataFrame,
    wanted: Sequence[str] = MUNICIPAL_COLUMNS,
    created_at: str | None = None,
) -> DataFrame:
    """Keeps those wanted columns the records have (all, if they have none) and stamps them."""
    kept = [c for c in wanted if c in records.columns] or records.columns
    stamp = F.lit(created_at) if created_at else _now_text()
    return records.select(*kept).withColumn("created_at", stamp)


def read_record_pages(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType
) -> DataFrame:
    """All pages of records as one frame: a multi-path read instead of appending page to page."""
    return spark.read.schema(schema).option("multiLine", True).json(list(paths))


def write_snapshot(df: DataFrame, table_path: str, snapshot_ts: str) -> None:
    """Adds one snapshot, named ``YYYYmmdd_HHMMSS``, beside the earlier ones."""
    df.write.option("compression", "snappy").mode("errorifexists").parquet(
        f"{table_path}/{SNAPSHOT}={snapshot_ts}"
    )


def read_all_snapshots(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """Every row of every snapshot, with the snapshot name."""
    named = T.StructType([*schema.fields, T.StructField(SNAPSHOT, T.StringType())])
    return spark.read.schema(named).parquet(table_path)


def read_latest_snapshot(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """Rows of the last snapshot by name.

    The name is a partition, so the maximum is found without reading data columns and the other
    snapshots are pruned when the query runs.
    """
    every = read_all_snapshots(spark, table_path, schema)
    last = every.agg(F.max(SNAPSHOT))
    return every.where(F.col(SNAPSHOT) == last.scalar()).drop(SNAPSHOT)
