"""Data-quality reports and the checks that stop a run."""

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regista.fixed_values import MINIMUM_EXPECTED_ROWS
from regista.functions.document import member_codes
from regista.functions.text import strip_quotes
from regista.operators.joins import unmapped_values
from regista.workspace import run_folder


class DataQualityError(ValueError):
    """A check failed; the message names the findings."""


def mapping_violations(
    register: DataFrame, service_types: DataFrame, qualifications: DataFrame
) -> DataFrame:
    """Every register type or qualification its catalog lacks: (mapping, value).

    A NULL type is a violation, a NULL qualification is not.
    """
    def against(mapping: str, column: str, catalog: DataFrame, described: str, allow_null: bool):
        catalog = catalog.withColumn(described, strip_quotes(F.col(described)))
        facts = register.withColumn(column, strip_quotes(F.col(column)))
        missing = unmapped_values(facts, column, catalog, described, allow_null)
        return missing.select(F.lit(mapping).alias("mapping"), "value")

    return against(
        "service_type", "tipologia", service_types, "service_type_description", False
    ).unionByName(against(
        "service_qualification", "qualificacio", qualifications,
        "service_qualification_description", True,
    ))


def require_no_violations(violations: DataFrame, shown: int = 20) -> None:
    """Writes all violations as a table; if there are any, fails with their number and its place.

    The message also quotes the first ``shown`` in order; the table has every one of them.
    """
    spark = violations.sparkSession
    path = run_folder(spark, "violations")
    violations.write.parquet(path)
    written = spark.read.schema(violations.schema).parquet(path)
    count = written.count()
    if count:
        examples = ", ".join(str(tuple(r)) for r in written.orderBy(*written.columns).limit(shown).collect())
        raise DataQualityError(f"{count} unmapped values, all of them in {path}: {examples}")


#: ids that a bitmap of 32,768 numbers must stand for on average; with fewer, ids are made distinct as they are
_DENSE = 256


def _by_number(ids: DataFrame) -> DataFrame:
    """(side, id, stem, digits, number): the digits an id ends in, as a number, and what stands before them.

    Digits are read at their length, so 7 and 07 differ. An id without digits, with more than 18, and a NULL one have no number.
    """
    if isinstance(ids.schema["id"].dataType, T.IntegralType):
        return ids.select("side", "id", F.lit("").alias("stem"), F.lit(0).alias("digits"), F.col("id").cast("bigint").alias("number"))
    text = F.col("id").cast("string")
    stem = F.rtrim(text, F.lit("0123456789"))
    digits = F.substring(text, F.length(stem) + 1, F.lit(19))
    count = F.length(text) - F.length(stem)
    ends = count.between(1, 18)
    return ids.select("side", "id", F.when(ends, stem).alias("stem"), F.when(ends, count).alias("digits"), F.when(
        ends, digits.cast("bigint")).alias("number"))


def distinct_counts(ids: DataFrame) -> DataFrame:
    """(side, n): exact distinct ids of each ``side`` of (side, id); a NULL id counts as one.

    Ids that end in digits and lie close together, as register numbers do, set bits: one bitmap for each 32,768
    numbers of a stem, put together on the map side, so no id travels. A first pass over side 0 estimates how many
    bitmaps that would be; where ids are scattered, they are made distinct as they are.
    """
    numbered = _by_number(ids)
    bucket = F.bitmap_bucket_number("number")
    row = numbered.where("side = 0").agg(
        F.count("number").alias("rows"), F.approx_count_distinct(F.when(
            F.col("number").isNotNull(), F.xxhash64("side", "stem", "digits", bucket))).alias("bitmaps")).first()
    dense = row["rows"] >= _DENSE * max(1, row["bitmaps"])
    if not dense:
        return numbered.select("side", "id").distinct().groupBy("side").agg(F.count("*").alias("n"))
    # rows without a number share one bitmap without bits; NULL ids are among them, other such ids are text
    bits = numbered.groupBy("side", "stem", "digits", bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"), F.bool_or(F.col("id").isNull()).alias("none"))
    counted = bits.groupBy("side").agg((F.sum(F.bitmap_count("bits")) + F.bool_or("none").cast("int")).alias("n"))
    if not isinstance(ids.schema["id"].dataType, T.IntegralType):
        rest = numbered.where(F.col("number").isNull() & F.col("id").isNotNull()).select("side", "id").distinct()
        counted = counted.unionByName(rest.groupBy("side").agg(F.count("*").alias("n")))
    return counted.groupBy("side").agg(F.sum("n").alias("n"))


def distinct_preserved(
    before: DataFrame, before_id: str, after: DataFrame, after_id: str
) -> DataFrame:
    """Distinct ids of two tables side by side: (before_count, after_count, preserved).

    A NULL id counts as one id. Zero ids are never preserved.
    """
    counted = distinct_counts(
        before.select(F.lit(0).alias("side"), F.col(before_id).alias("id"))
        .unionByName(after.select(F.lit(1).alias("side"), F.col(after_id).alias("id"))))
    return counted.agg(
        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)).alias("before_count"),
        F.coalesce(F.sum(F.when(F.col("side") == 1, F.col("n"))), F.lit(0)).alias("after_count"),
    ).withColumn(
        "preserved", (F.col("before_count") == F.col("after_count")) & (F.col("after_count") > 0)
    )


def require_distinct_preserved(
    before: DataFrame, before_id: str, after: DataFrame, after_id: str
) -> None:
    row = distinct_preserved(before, before_id, after, after_id).first()
    if not row["preserved"]:
        raise DataQualityError(
            f"distinct ids before {row['before_count']}, after {row['after_count']}"
        )


def row_count_status(df: DataFrame, minimum: int = MINIMUM_EXPECTED_ROWS) -> DataFrame:
    """(row_count, status): 'error' for no rows, 'warn' below ``minimum``, else 'ok'."""
    n = F.col("row_count")
    status = F.when(n == 0, "error").when(n < minimum, "warn").otherwise("ok")
    return df.agg(F.count("*").alias("row_count")).withColumn("status", status)


def require_minimum(df: DataFrame, what: str, minimum: int = MINIMUM_EXPECTED_ROWS) -> str:
    """The status of the row-count rule: no rows stop the run, few rows are only reported."""
    row = row_count_status(df, minimum).first()
    if row["status"] == "error":
        raise DataQualityError(f"{what} has no rows")
    if row["status"] == "warn":
        warnings.warn(f"{what} has {row['row_count']} rows, fewer than {minimum}", stacklevel=2)
    return row["status"]


def require_members(expected: DataFrame, landed: DataFrame, column: str) -> None:
    """Fails if an announced member (for instance a census year) did not land."""
    missing = missing_members(expected, landed, column)
    row = missing.agg(F.count("*").alias("n"), F.min(column).alias("first"), F.max(column).alias("last")).first()
    if row["n"]:
        raise DataQualityError(f"{row['n']} values of {column} did not land, {row['first']} to {row['last']}")


def require_rows(df: DataFrame, what: str = "result") -> None:
    """An empty dataset is an error."""
    if df.isEmpty():
        raise DataQualityError(f"{what} has no rows")


def multi_member_dimensions(cubes: DataFrame, dimension: str = "YEAR") -> DataFrame:
    """Cubes whose ``dimension`` does not have exactly one member."""
    codes = member_codes(F.col(f"dimension.{dimension}.category.index"))
    return cubes.withColumn("member_count", F.array_size(codes)).where("member_count <> 1")


def unmatched_names(matches: DataFrame) -> DataFrame:
    """Names that share no token with any candidate, for review."""
    return matches.where(F.col("tokens_similar") == 0)


def by_match_quality(matches: DataFrame, *tie: str) -> DataFrame:
    """Matches ordered weakest first; ``tie`` makes the order total."""
    return matches.orderBy("tokens_similar", *tie)


def missing_members(expected: DataFrame, landed: DataFrame, column: str) -> DataFrame:
    """Announced members (for instance census years) that did not land."""
    # few members land in many rows: join their distinct values, not every landed row of one member in one task
    return expected.select(column).distinct().join(landed.select(column).distinct(), column, "left_anti")
