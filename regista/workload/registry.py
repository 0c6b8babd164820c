"""Named queries over the test tables, and the SQL that checks them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, as attributes; a table's schema is looked up once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._schemas: dict[str, T.StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)


def query(sql: str | None = None):
    """Registers a function of :class:`Tables` under its own name."""
    def add(fn: Callable[[Tables], DataFrame]):
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
