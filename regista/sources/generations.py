"""Tables replaced without a gap: every write is a new generation, and one rename makes it the current one.

    <table>/data/generation=<id>/…     what one write produced, never changed afterwards
    <table>/_pointers/<number>.json    which folders make up the table, one record for each commit

A reader takes the record of the highest number. A writer finishes its files first, then writes the
next record under a hidden name and renames it to its number. A writer that is killed before leaves the
table as it was; two writers cannot take the same number, the later one starts again from the newer
record. Generations no record of the last few commits names are deleted, so a reader that began a
short time ago keeps its files.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENERATION = "generation"
#: records, and the generations they name, that stay readable after a commit
KEPT = 3
#: other writers may commit so many times between reading the record and renaming the next one
_ATTEMPTS = 20
_DIGITS = 12
#: commits of one driver go one after another; those of several meet at the rename
_one_commit = threading.Lock()


class CommitConflict(RuntimeError):
    """Other writers committed all the time."""


def _system(spark: SparkSession, path: str):
    files = spark._jvm.org.apache.hadoop.fs
    return files, files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, system = _system(spark, folder)
    place = files.Path(folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def _numbers(spark: SparkSession, table: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{table}/_pointers") if n.endswith(".json") and n[0].isdigit()]


def _record_path(table: str, number: int) -> str:
    return f"{table}/_pointers/{number:0{_DIGITS}d}.json"


def _read_record(spark: SparkSession, table: str, number: int) -> dict:
    """One record; like the folder names in it, it is as small as the table has partitions."""
    files, system = _system(spark, table)
    stream = system.open(files.Path(_record_path(table, number)))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def current(spark: SparkSession, table: str) -> tuple[int, dict]:
    """Number and content of the current record; (0, {}) for a table without commits."""
    numbers = _numbers(spark, table)
    return (numbers[-1], _read_record(spark, table, numbers[-1])) if numbers else (0, {})


def new_generation(table: str) -> str:
    """A folder for the files of a write that is not committed yet."""
    return f"{table}/data/{GENERATION}={uuid.uuid4().hex}"


def commit(spark: SparkSession, table: str, change: Callable[[dict], dict]) -> int:
    """Makes ``change`` of the current record the next one and returns its number.

    ``change`` may run more than once, on the record another writer committed meanwhile. Between several
    drivers this needs a file system whose rename does not replace a file, as HDFS.
    """
    with _one_commit:
        return _commit(spark, table, change)


def _commit(spark: SparkSession, table: str, change: Callable[[dict], dict]) -> int:
    files, system = _system(spark, table)
    for _ in range(_ATTEMPTS):
        number, record = current(spark, table)
        hidden = files.Path(f"{table}/_pointers/.{uuid.uuid4().hex}")
        stream = system.create(hidden)
        try:
            stream.write(bytearray(json.dumps(change(record), ensure_ascii=False).encode()))
        finally:
            stream.close()
        target = files.Path(_record_path(table, number + 1))
        if not system.exists(target) and system.rename(hidden, target):
            _forget(spark, table, number + 1)
            return number + 1
        system.delete(hidden, False)
    raise CommitConflict(f"{table}: other writers took the next {_ATTEMPTS} records")


def _folders(record: dict) -> set[str]:
    """The generations a record names."""
    return {path.split("/")[1] for kind in record.values() if isinstance(kind, dict) for path in kind.values() if isinstance(path, str) and path.startswith("data/")}


def _forget(spark: SparkSession, table: str, number: int) -> None:
    """Deletes the records before the last few, and generations only they name.

    A generation no record ever named may be one that another writer is still filling, so it stays.
    """
    files, system = _system(spark, table)
    old = [n for n in _numbers(spark, table) if n <= number - KEPT]
    if not old:
        return
    kept = set().union(*(_folders(_read_record(spark, table, n)) for n in _numbers(spark, table) if n > number - KEPT))
    for n in old:
        if not system.exists(files.Path(_record_path(table, n))):
            continue
        for name in _folders(_read_record(spark, table, n)) - kept:
            system.delete(files.Path(f"{table}/data/{name}"), True)
        system.delete(files.Path(_record_path(table, n)), False)


# --- whole tables, partitioned tables, sets of tables ---

def counted(df: DataFrame, seen: Observation | None) -> DataFrame:
    """``df``, whose rows ``seen`` counts as row_count. To be called last before a write, so that the tasks
    that write are those that count, and of a task that runs again one attempt counts."""
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("row_count"))


def replace(df: DataFrame, table: str, seen: Observation | None = None) -> int:
    """Makes the rows of ``df`` the table, as one Snappy Parquet dataset. The old rows may be among its sources."""
    folder = new_generation(table)
    counted(df, seen).write.option("compression", "snappy").parquet(f"{folder}/rows")
    return commit(df.sparkSession, table, lambda _: {"whole": {"rows": folder.removeprefix(f"{table}/") + "/rows"}})


def write_partitions(
    df: DataFrame, table: str, key: str, gone: tuple[str, ...] = (), also: Callable[[dict], dict] = dict,
    seen: Observation | None = None,
) -> int:
    """Puts the ``key`` partitions of ``df`` in the place of those of the same value; ``gone`` values have no rows left.

    Rows are gathered by partition to keep files few; the rebalance splits a partition that holds
    much of the data over several tasks. ``also`` may change other parts of the record in the same commit.
    """
    spark, folder = df.sparkSession, new_generation(table)
    counted(df.hint("rebalance", key), seen).write.partitionBy(key).option("compression", "snappy").parquet(folder)
    at = folder.removeprefix(f"{table}/")
    written = {unquote(n.split("=", 1)[1]): f"{at}/{n}" for n in _names(spark, folder) if n.startswith(f"{key}=")}

    def change(record: dict) -> dict:
        held = {v: p for v, p in record.get("partitions", {}).items() if v not in gone}
        return also(record | {"partitions": held | written})

    return commit(spark, table, change)


def publish_together(
    tables: Mapping[str, DataFrame], folder: str, write: Callable[[str, DataFrame, str], None],
) -> int:
    """Writes each table by ``write(name, df, path)``, then makes all of them current at once."""
    spark, out = next(iter(tables.values())).sparkSession, new_generation(folder)
    for name, df in tables.items():
        write(name, df, f"{out}/{name}")
    at = out.removeprefix(f"{folder}/")
    return commit(spark, folder, lambda record: record | {"tables": record.get("tables", {}) | {name: f"{at}/{name}" for name in tables}})


class Version:
    """The tables of a folder as one commit left them, whatever is committed while they are read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.number, self._record = current(spark, folder)
        self._folder = folder

    def path(self, name: str) -> str:
        """Where a table's files are; a folder without commits holds a plain folder for each table."""
        held = self._record.get("tables", {})
        if self.number and name not in held:
            raise KeyError(f"{self._folder} has no table {name}")
        return f"{self._folder}/{held.get(name, name)}"


def read(spark: SparkSession, table: str, schema: T.StructType | None = None, key: str | None = None) -> DataFrame:
    """The current rows of a table; a folder without commits is read as plain Parquet.

    ``key`` names the partition column of a partitioned table and stays text. ``schema`` may leave it out.
    """
    number, record = current(spark, table)
    reader = spark.read
    if not number:
        return (reader.schema(_keyed(schema, key)) if schema else reader).parquet(table)
    if "whole" in record:
        return (reader.schema(schema) if schema else reader).parquet(f"{table}/{record['whole']['rows']}")
    paths = [f"{table}/{p}" for p in record.get("partitions", {}).values()]
    if key is None:
        first = next(iter(record["partitions"].values()), None)
        key = first.split("/")[-1].split("=")[0] if first else None
    if schema is None:
        schema = reader.parquet(*paths).schema
    known = _keyed(schema, key)
    if not paths:
        return spark.createDataFrame([], known)
    every = T.StructType([*known.fields, T.StructField(GENERATION, T.StringType())])
    return reader.schema(every).option("basePath", f"{table}/data").parquet(*paths).select(*[F.col(f"`{n}`") for n in known.names])


def _keyed(schema: T.StructType, key: str | None) -> T.StructType:
    if key is None:
        return schema
    return T.StructType([*[f for f in schema.fields if f.name != key], T.StructField(key, T.StringType())])
