"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regista.workspace import settle


def with_block_places(df: DataFrame, order: Sequence[Column], blocks: int = 0) -> DataFrame:
    """``df`` sorted by range and settled, with ``block`` and ``place`` (0, 1, 2, … within its block).

    Blocks follow one another in the order. The order must tell all rows apart, so that rows which
    agree in its first columns can still lie in several blocks. ``blocks`` is the least number of
    blocks where the session's number of shuffle partitions is lower.
    """
    at = F.monotonically_increasing_id()
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(blocks, *order) if blocks > shuffles else df.repartitionByRange(*order)
    return settle(ranged.sortWithinPartitions(*order).withColumns({
        "block": F.shiftright(at, 33).cast("int"), "place": at.bitwiseAND(F.lit((1 << 33) - 1))}))


def blocks_before(placed: DataFrame) -> DataFrame:
    """(block, before): the rows in front of each block; one row a block, as many as the sort had partitions."""
    counts = placed.groupBy("block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("block", F.coalesce(before, F.lit(0)).alias("before"))
