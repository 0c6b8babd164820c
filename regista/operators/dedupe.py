"""Best row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; NULL keys form one group.

    Spark limits each map task to its best row per key before the shuffle, so a key that holds a
    third of all rows sends one row per task. ``order`` should be total, else ties are arbitrary.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
