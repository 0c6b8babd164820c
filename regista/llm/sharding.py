"""Consistent hashing with virtual nodes and bounded loads, in built-in functions only.

Every shard owns ``nodes`` points on a ring of 64-bit hashes; a key belongs to the arc that ends at
the next point clockwise. Keys are placed in ring order, each into the first shard clockwise from
its arc that still has room. Keys of one arc meet the shards in the same order, so it is enough to
know how many keys an arc has: the plan (which stretch of which arc goes to which shard) is folded
over ``shards * nodes`` arc totals, a size set by parameters and not by the data. Keys then look
their stretch up by arc and rank.

With ``slack`` zero the capacities add up to the number of rows, so all shards end exactly full and
counts differ by at most one. More slack moves fewer keys when rows or shards change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regista.workspace import settle

SHARDS = 16
NODES = 64
#: rows that one task ranks or writes, about; copies of a row travel in blocks of BLOCK_ROWS
TASK_ROWS = 1 << 20
BLOCK_ROWS = 1 << 12
_CELL_BITS = 10


def _ring(shards: int, nodes: int) -> Column:
    """All points in ring order: array of (at, shard)."""
    return F.expr(
        f"array_sort(transform(sequence(0, {shards * nodes - 1}), "
        f"i -> named_struct('at', xxhash64(i div {nodes}, i % {nodes}, 'ring'), 'shard', cast(i div {nodes} as int))))")


def _arcs(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """(arc, turn): the shards in the order in which keys of the arc meet them."""
    size = shards * nodes
    return spark.range(size).select(F.col("id").cast("int").alias("arc"), _ring(shards, nodes).alias("ring")).select(
        "arc", F.expr(f"array_distinct(transform(concat(slice(ring, arc + 1, {size}), "
                      f"slice(ring, 1, arc)), p -> p.shard))").alias("turn"))


def _cells(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """(cell, ends): the ring in equal cells, each with the arc ends in it and the first one after."""
    half = 1 << (_CELL_BITS - 1)
    points = F.expr("transform(ring, (p, i) -> named_struct('at', p.at, 'arc', cast(i as int)))")
    inside = F.expr(f"filter(points, p -> shiftright(p.at, {64 - _CELL_BITS}) = cell)")
    after = F.expr(f"filter(points, p -> shiftright(p.at, {64 - _CELL_BITS}) > cell)")
    return (spark.range(-half, half).select(F.col("id").alias("cell"), _ring(shards, nodes).alias("ring"))
            .select("cell", points.alias("points"))
            .select("cell", inside.alias("inside"), F.coalesce(F.get(after, F.lit(0))["arc"], F.lit(0)).alias("next"))
            .select("cell", F.concat("inside", F.array(F.struct(
                F.lit((1 << 63) - 1).alias("at"), F.col("next").alias("arc")))).alias("ends")))


def _plan(totals: DataFrame, arcs: DataFrame, shards: int, slack: float) -> DataFrame:
    """(arc, from, until, shard, base): ranks ``from`` to ``until`` - 1 of an arc get slots from ``base`` on.

    One row holds all arcs; a fold walks them in ring order with the room left in each shard.
    """
    steps = arcs.join(F.broadcast(totals), "arc", "left").select("arc", "turn", F.coalesce("rows", F.lit(0)).alias("rows"))
    one = steps.agg(F.array_sort(F.collect_list(F.struct("arc", "turn", "rows"))).alias("steps"),
                    F.sum("rows").alias("n"))
    room = (f"transform(sequence(0, {shards - 1}), s -> " + (
        f"n div {shards} + if(s < n % {shards}, 1, 0)" if not slack else
        f"cast(ceil(n * {1 + slack!r}D / {shards}) as bigint)") + ")")
    folded = one.select("steps", F.expr(room).alias("cap")).select(F.expr("""
        aggregate(
          steps,
          named_struct('used', transform(cap, c -> 0L),
                       'out', cast(array() as array<struct<arc:int,from:bigint,until:bigint,shard:int,base:bigint>>)),
          (state, step) -> if(step.rows = 0, state, aggregate(
            step.turn,
            named_struct('done', 0L, 'used', state.used, 'out', state.out),
            (s, shard) -> if(s.done = step.rows or s.used[shard] = cap[shard], s, named_struct(
              'done', s.done + least(step.rows - s.done, cap[shard] - s.used[shard]),
              'used', transform(s.used, (u, i) -> if(i = shard, u + least(step.rows - s.done, cap[shard] - s.used[shard]), u)),
              'out', concat(s.out, array(named_struct(
                'arc', step.arc, 'from', s.done,
                'until', s.done + least(step.rows - s.done, cap[shard] - s.used[shard]),
                'shard', shard, 'base', s.used[shard]))))),
            s -> named_struct('used', s.used, 'out', s.out))),
          state -> state.out)""").alias("out"))
    return folded.select(F.explode("out").alias("x")).select("x.*")


def _blocks(alike: DataFrame, names: list[str]) -> DataFrame:
    """Copies of a row, counted in ``__rows``, as numbered blocks of at most BLOCK_ROWS."""
    last = F.expr(f"(__rows - 1) div {BLOCK_ROWS}")
    return alike.select(*names, "__rows", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("__block")).select(
        *names, "__block", F.least(F.lit(BLOCK_ROWS), F.col("__rows") - F.col("__block") * BLOCK_ROWS).alias("__rows"))


def _ranged(blocks: DataFrame, names: list[str], shards: int, nodes: int, ranges: int) -> DataFrame:
    """``blocks`` with ring position, arc and the number of the range they lie in.

    Ranges follow ring order and, within a key, its rows, all of which differ: a key of many rows is
    cut into several ranges.
    """
    at = F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit("\x00")))
    return blocks.withColumn("__at", at).withColumn("__cell", F.shiftright("__at", 64 - _CELL_BITS)).join(
        F.broadcast(_cells(blocks.sparkSession, shards, nodes)), F.col("__cell") == F.col("cell")).select(
        *names, "__block", "__rows", "__at",
        F.get(F.filter("ends", lambda e: e["at"] >= F.col("__at")), F.lit(0))["arc"].alias("arc")).repartitionByRange(
        ranges, "__at", *names, "__block").withColumn("__range", F.spark_partition_id())


def assign(keys: DataFrame, shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """``keys`` (key, and columns that tell rows of one key apart) with ``shard`` and ``slot``.

    Slots of a shard run from 0 without gaps. Equal rows are counted before they travel and told
    apart again at the end, block by block; different rows of one key are ranked in several ranges.
    So one key may hold any share of the rows. Null keys hash like a value.
    """
    if slack < 0:
        raise ValueError("slack must not be negative")
    spark = keys.sparkSession
    names = keys.columns
    alike = settle(keys.groupBy(*names).agg(F.count("*").alias("__rows")))
    size = alike.agg(F.count("*").alias("n"), F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-(size["n"] + size["rows"] // BLOCK_ROWS) // TASK_ROWS))
    placed = settle(_ranged(_blocks(alike, names), names, shards, nodes, ranges))
    held = settle(placed.groupBy("arc", "__range").agg(F.sum("__rows").alias("rows")))
    before = held.select("arc", "__range", (F.sum("rows").over(
        Window.partitionBy("arc").orderBy("__range")) - F.col("rows")).alias("__before"))
    plan = _plan(held.groupBy("arc").agg(F.sum("rows").alias("rows")), _arcs(spark, shards, nodes), shards, slack)
    # the plan is bounded by the parameters: a row for each arc and each shard that fills up
    order = Window.partitionBy("arc", "__range").orderBy("__at", *names, "__block")
    ranked = placed.withColumn("__until", F.sum("__rows").over(order)).join(before, ["arc", "__range"]).select(
        *names, "arc", "__rows", (F.col("__before") + F.col("__until") - F.col("__rows")).alias("__first"))
    dealt = ranked.repartition(max(least, -(-size["rows"] // TASK_ROWS)), "arc", "__first").select(
        *names, "arc", F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__rows") - 1)).alias("__rank"))
    return dealt.join(F.broadcast(plan.withColumnRenamed("arc", "__arc")),
                      (F.col("arc") == F.col("__arc")) & (F.col("__rank") >= F.col("from"))
                      & (F.col("__rank") < F.col("until"))).select(
        *names, "shard", (F.col("base") + F.col("__rank") - F.col("from")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus one; null text counts as empty. With no slack the counts
    of the shards are at most one apart (law ``rows``). Repeated rows get slots of their own; rows
    with a null doc_id share one place on the ring; an empty table gives no rows. Texts are measured
    whole at any length; other columns of ``docs`` are not read.
    """
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    keys = docs.select(F.col("doc_id").cast("bigint").alias("key"),
                       (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    return assign(keys, shards, nodes, slack).select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
