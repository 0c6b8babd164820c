"""Where jobs put tables that cut lineage, and how small tables are proven small."""

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: upper bound for a hinted broadcast, in bytes of the rows written as JSON text
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster, files on one
    machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if urlparse(named).scheme == "file" and not _one_machine(spark):
            raise RuntimeError(f"{named} is a folder of one machine; name one every executor can reach")
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="regista-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors run on one machine, or a setting says that they share files.

    A file system mounted on every machine looks like a local one; ``spark.regista.sharedFiles``
    set to ``true`` declares it.
    """
    master = spark.sparkContext.master
    return master.startswith("local") or spark.conf.get("spark.regista.sharedFiles", "false") == "true"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder, never used before."""
    return f"{shared_folder(spark)}/regista/{name}-{uuid.uuid4().hex}"


_settled: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("settled", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables settled inside the block when it ends, also after an error.

    For jobs that publish all they make; a result that is still to be read must not depend on them.
    """
    token = _settled.set([])
    try:
        yield
    finally:
        paths, files = _settled.get(), spark._jvm.org.apache.hadoop.fs
        _settled.reset(token)
        for path in paths:
            place = files.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder once and reads it from there.

    Later stages neither recompute it nor depend on the executors that produced it.
    """
    spark = df.sparkSession
    path = run_folder(spark, "settled")
    df.write.parquet(path)
    if (settled := _settled.get()) is not None:
        settled.append(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows as JSON text: one distributed sum, one number to the driver."""
    row = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("n")).first()["n"]


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hints a broadcast only after measuring ``df``; otherwise leaves the join to shuffle.

    Meant for settled or scanned tables: measuring reads the table once.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
