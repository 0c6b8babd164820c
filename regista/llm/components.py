"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.workspace import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the smallest node around it."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionAll(moved).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a))")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label): for each node of ``links`` (a > b), the smallest node it is connected to.

    Each round is written to the shared folder and the next one reads it; rounds stop when the links
    no longer change, which takes a number of rounds logarithmic in the longest chain. Minima are
    aggregated before they travel and joins may be split, so a node with very many links is no
    single task's work.
    """
    links = settle(links)
    state = _state(links)
    while True:
        links = settle(_small_star(_large_star(links)))
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        roots.select("node", F.col("node").alias("label")))
