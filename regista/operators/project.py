"""Projections and filters with rules of their own; plain ones are written as Spark calls."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import COUNTY_RECODES, MART_SERVICE_TYPES
from regista.functions.scalar import null_text_to_null, recode_value
from regista.functions.text import strip_quotes
from regista.schemas import REGISTER_COLUMNS


def clean_register(raw: DataFrame, *keep: str) -> DataFrame:
    """The used raw columns and ``keep``, with text NULLs, county spellings and quotes put right."""
    return raw.select(*REGISTER_COLUMNS, *keep).withColumns({
        "tipologia": strip_quotes(F.col("tipologia")),
        "qualificacio": strip_quotes(null_text_to_null(F.col("qualificacio"))),
        "comarca": recode_value(F.col("comarca"), COUNTY_RECODES),
    })


def mart_rows(staging: DataFrame, service_types: Sequence[str] = MART_SERVICE_TYPES) -> DataFrame:
    """Rows that count toward capacity: positive, and of the listed types."""
    return staging.where((F.col("capacity") > 0) & F.col("service_type_id").isin(*service_types))


def where_equals(df: DataFrame, **params: object) -> DataFrame:
    """Rows where each named column equals the given value."""
    for name, value in params.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def not_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose value does not contain the pattern; NULL values are dropped."""
    return df.where(~F.col(column).rlike(pattern))


def common_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` reduced to the columns both frames have, in its own order."""
    return left.select(*[c for c in left.columns if c in set(right.columns)])


def rename_project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Projection with renames: new name -> column."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])
