"""Landing files as they arrive, cleaned: appended page by page, or kept up to date date by date."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regista.fixed_values import REGISTER_FILE_GLOB
from regista.operators.project import clean_register
from regista.schemas import REGISTER_LANDING
from regista.sources import generations
from regista.sources.landing import PARTITION, read_landing_json
from regista.workspace import settle

#: what is known of a page that has been read
_LEDGER = T.StructType([
    T.StructField(PARTITION, T.StringType()), T.StructField("page", T.StringType()),
    T.StructField("changed_at", T.TimestampType()), T.StructField("bytes", T.LongType()),
])


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REGISTER_LANDING,
    file_glob: str = REGISTER_FILE_GLOB,
    json_lines: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Stream of the landing pages under ``path``; the dated folder becomes a text column."""
    dated = T.StructType([*schema.fields, T.StructField(PARTITION, T.StringType())])
    reader = (
        spark.readStream.schema(dated)
        .option("multiLine", not json_lines)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", file_glob)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def clean_register_keeping_date(landing: DataFrame) -> DataFrame:
    """Stateless cleaning of register pages that keeps the dated folder."""
    return clean_register(landing, PARTITION)


def append_new_landing(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame] = clean_register_keeping_date,
) -> StreamingQuery:
    """Processes all files that arrived since the last run, then stops.

    ``checkpoint`` remembers the files already read, so a run after a failure or with nothing new
    adds no row twice; the file sink commits each batch as a whole. Duplicate register rows are
    removed later, per partition, when the staging table is built.
    """
    return (
        clean(stream).writeStream.format("parquet")
        .partitionBy(PARTITION)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landed_pages(spark: SparkSession, landing: str, file_glob: str = REGISTER_FILE_GLOB) -> DataFrame:
    """(downloaded_date, page, changed_at, bytes) of all landing pages; no page is opened."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", file_glob)
        .option("recursiveFileLookup", True).load(landing)
    )
    date = F.regexp_extract("path", rf"{PARTITION}=([^/]+)/", 1)
    return found.select(
        date.alias(PARTITION), F.regexp_extract("path", "([^/]+)$", 1).alias("page"),
        F.col("modificationTime").alias("changed_at"), F.col("length").alias("bytes"))


def refresh_landing(
    spark: SparkSession,
    landing: str,
    target: str,
    clean: Callable[[DataFrame], DataFrame] = clean_register,
    schema: T.StructType = REGISTER_LANDING,
    file_glob: str = REGISTER_FILE_GLOB,
    json_lines: bool = False,
    epoch: tuple[str, int] | None = None,
) -> list[str]:
    """Brings the dated partitions of ``target`` up to date with the landing pages; returns the dates replaced.

    A date is read again as a whole, and its partition replaced, if one of its pages is new, was corrected
    under its old name, or is gone. So a correction takes the place of the rows it corrects, and rows that
    land again under another page name, exact copies, are kept once. Partitions and the list of pages they
    were made from change in one commit: a run that is killed changes nothing, and running again gives the same table.
    ``epoch``, the id of a stream and the number of its batch, is recorded with them; a batch already recorded is not
    processed again.
    """
    _, record = generations.current(spark, target)
    if epoch and record.get("epochs", {}).get(epoch[0], -1) >= epoch[1]:
        return []
    now = settle(landed_pages(spark, landing, file_glob))
    known = record.get("ledger", {}).get("pages")
    before = spark.read.schema(_LEDGER).parquet(f"{target}/{known}") if known else spark.createDataFrame([], _LEDGER)
    columns = [F.col(c) for c in _LEDGER.names]
    changed = now.select(*columns).exceptAll(before).unionAll(before.exceptAll(now.select(*columns)))
    # as many as dates with a change, each a folder the job reads
    dates = sorted(r[0] for r in changed.select(PARTITION).distinct().collect())
    if not dates and not epoch:
        return []
    held = {r[0] for r in now.where(F.col(PARTITION).isin(dates)).select(PARTITION).distinct().collect()} if dates else set()
    parts = [
        clean(read_landing_json(spark, f"{landing}/{PARTITION}={date}", schema, file_glob, json_lines)).distinct()
        .withColumn(PARTITION, F.lit(date)) for date in dates if date in held
    ]
    ledger = generations.new_generation(target)
    now.select(*columns).write.parquet(f"{ledger}/pages")

    def recorded(record: dict) -> dict:
        epochs = record.get("epochs", {}) | ({epoch[0]: epoch[1]} if epoch else {})
        return record | {"ledger": {"pages": ledger.removeprefix(f"{target}/") + "/pages"}, "epochs": epochs}

    gone = tuple(d for d in dates if d not in held)
    if parts:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        generations.write_partitions(rows, target, PARTITION, gone=tuple(dates), also=recorded)
    else:
        generations.commit(spark, target, lambda r: recorded(r | {
            "partitions": {d: p for d, p in r.get("partitions", {}).items() if d not in gone}}))
    return dates


def follow_landing(
    stream: DataFrame, landing: str, target: str, checkpoint: str, **refresh: object
) -> StreamingQuery:
    """Runs :func:`refresh_landing` for each batch of new pages that ``stream`` finds, then stops.

    A batch only says that pages have landed; what is read are the dates touched. A batch replayed after a
    kill is known by its number, and one that a new checkpoint brings again by its pages: both leave the same table. A correction
    under an old page name starts no batch, but is seen by the next one, or by calling :func:`refresh_landing`.
    """
    def batch(rows: DataFrame, number: int) -> None:
        stream_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        refresh_landing(stream.sparkSession, landing, target, epoch=(stream_id, number), **refresh)

    return (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
