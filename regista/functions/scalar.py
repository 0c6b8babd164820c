"""Casts, recodes, ratios, rounding and classes."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from regista.fixed_values import (
    COVERAGE_TARGET,
    DEFICIT_LABEL,
    ELDERLY_THRESHOLD_COUNT,
    ELDERLY_THRESHOLD_OFFSET,
    ELDERLY_THRESHOLD_STEP,
    NULL_TEXT,
    SURPLUS_LABEL,
)


def null_text_to_null(c: Column, text: str = NULL_TEXT) -> Column:
    """The literal text ``null`` becomes NULL."""
    return F.nullif(c, F.lit(text))


def recode_value(c: Column, recodes: Mapping[str, str]) -> Column:
    """Rewrites the given spellings, keeps everything else."""
    return reduce(lambda out, kv: F.when(c == kv[0], F.lit(kv[1])).otherwise(out), recodes.items(), c)


def parse_date_lenient(c: Column) -> Column:
    """``yyyy-MM-dd`` text to date; anything else is NULL.

    The pattern keeps the cast's other formats out. A cast that fails costs nothing, while a
    formatter would raise and catch an exception for every bad row.
    """
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), c.try_cast("date"))


def parse_date_strict(c: Column) -> Column:
    """``yyyy-MM-dd`` text to date; NULL stays NULL, bad text fails the job in any ANSI mode."""
    bad = F.raise_error(F.concat(F.lit("not a yyyy-MM-dd date: "), c)).cast("date")
    return F.when(c.isNull(), F.lit(None).cast("date")).otherwise(
        F.coalesce(parse_date_lenient(c), bad)
    )


def int_lenient(c: Column) -> Column:
    """Text to 32-bit integer; bad text is NULL."""
    return c.try_cast("int")


def trunc_to_long(c: Column) -> Column:
    """Floating point to 64-bit integer, toward zero."""
    return c.cast("double").cast("bigint")


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


#: from here on a double has no fraction, and adding a half to it may round up
_WHOLE = float(2**53)


def _floored(c: Column) -> Column:
    """The floor as a double; ``F.floor`` goes through 64 bits and would stop at 2^63."""
    return F.when((F.abs(c) < F.lit(_WHOLE)) & ~F.isnan(c), F.floor(c).cast("double")).otherwise(c)


def round_half_up(c: Column) -> Column:
    """Rounds to an integer, half toward plus infinity, as browsers do; beyond 64 bits is an error."""
    value = c.cast("double")
    rounded = F.when(F.abs(value) < F.lit(_WHOLE), F.floor(value + F.lit(0.5)).cast("double")).otherwise(value)
    too_large = F.raise_error(F.concat(F.lit("no 64-bit integer: "), value.cast("string"))).cast("bigint")
    return F.when(value.isNull(), F.lit(None).cast("bigint")).when(
        F.abs(rounded) < F.lit(float(2**63)), rounded.cast("bigint")
    ).otherwise(too_large)


def round_places(c: Column, places: int = 2) -> Column:
    """Rounds half away from zero on the scaled double.

    ``F.round`` works on the decimal text of the double, so 1.005 would give 1.01; the analytic
    database the serving tables come from gives 1.0. A value too large to have such decimals,
    infinity and NaN stay as they are.
    """
    scale = float(10**places)
    value = c.cast("double")
    scaled = F.abs(value) * F.lit(scale)
    rounded = F.signum(value) * F.floor(scaled + F.lit(0.5)) / F.lit(scale)
    return F.when((scaled < F.lit(_WHOLE)) | value.isNull(), rounded).otherwise(value)


def percent_ratio(part: Column, whole: Column) -> Column:
    """``part`` per hundred of ``whole`` with two decimals; NULL when ``whole`` is 0."""
    return round_places(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")))


def one_decimal_percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` with one decimal, half toward plus infinity."""
    permille = F.try_divide(part.cast("double") * F.lit(1000.0), whole.cast("double"))
    return F.when(F.abs(permille) < F.lit(_WHOLE), _floored(permille + F.lit(0.5))).otherwise(permille) / F.lit(10.0)


def bed_deficit(elderly: Column, places: Column, target: float = COVERAGE_TARGET) -> Column:
    """Places missing to reach ``target`` places per person of 65 or over."""
    return round_half_up(F.lit(target) * elderly.cast("double") - places.cast("double"))


def deficit_label(deficit: Column) -> Column:
    """A positive deficit is a deficit; zero counts as surplus."""
    return F.when(deficit > 0, F.lit(DEFICIT_LABEL)).otherwise(F.lit(SURPLUS_LABEL))


def plus_sign(value: Column, base: Column) -> Column:
    """'+' when ``value`` is above ``base``, else ''."""
    return F.when(value > base, F.lit("+")).otherwise(F.lit(""))


def threshold_class(value: Column, thresholds: Sequence[float | Column]) -> Column:
    """Number of thresholds at or below ``value``; NULL (unknown) for NULL."""
    hits = [(value >= F.lit(t)).cast("int") for t in thresholds]
    return reduce(lambda a, b: a + b, hits)


def thresholds_around(center: Column) -> list[Column]:
    """Eight evenly spaced class limits around ``center``."""
    return [
        center + F.lit(i * ELDERLY_THRESHOLD_STEP - ELDERLY_THRESHOLD_OFFSET)
        for i in range(ELDERLY_THRESHOLD_COUNT)
    ]
