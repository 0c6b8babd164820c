"""Staging to marts."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from regista.fixed_values import MART_SERVICE_TYPES
from regista.operators.aggregate import CAPACITY_KEYS, capacity_by_month
from regista.operators.project import mart_rows


def capacity_mart(
    staging: DataFrame,
    service_types: Sequence[str] = MART_SERVICE_TYPES,
    keys: Sequence[str] = CAPACITY_KEYS,
) -> DataFrame:
    """Monthly capacity of the listed service types.

    ``keys`` may leave out ``comarca_id`` where the county follows from the municipality; it is
    then looked up on the far smaller mart instead of on every staging row.
    """
    return capacity_by_month(mart_rows(staging, service_types), keys)
