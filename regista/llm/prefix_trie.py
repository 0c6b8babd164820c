"""The prefix trie of conversations: what every shared beginning would save.

Conversations are sorted by their turns. Then the members of a prefix are neighbours, and two
conversations share as many turns as the least common-prefix length (LCP) between them. A sparse table
answers the least LCP of any stretch at once, so each prefix finds the first and the last of its members
by two binary searches of its own; no prefix waits for another and no stack is kept. A row
starts a new node for each of its turns beyond its LCP. Counts, smallest members, leaves and shared
characters of a node are then figures of its interval: prefix sums, and another sparse table for minima.

The sorted rows are cut into blocks, and each block is a task. Rows are ordered by id within equal
conversations, so that a conversation which very many repeat is cut as well. A block is told
the rows next to it. Only prefixes of its first and last row can reach beyond it; such pieces are few
and are added up by prefix afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regista.llm.ordering import blocks_before, with_block_places
from regista.llm.shipping import ship
from regista.workspace import settle

#: conversations with ids of one such hundred may begin with turns of the same one
FAMILY = 100
#: turns taken from it: a hash of the id modulo this
HEADS = 6
#: turns of a block of the sorted conversations, about
BLOCK_TURNS = 1 << 20
#: turns from which on a conversation is followed only if another one begins with as many like them
FOLLOWED = 64
#: hexadecimal digits that stand for one turn
_DIGITS = 32
#: characters of member ids that travel as one row
_IDS = 1 << 18
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_PIECES = (
    "key string, parent_key string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, shared bigint, before bigint, ends string, block int, part int, ids string")


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, chars): turns with their place in the order of all turns of all conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = settle(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("row")))
    placed = with_block_places(turns, [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "digest", "row")])
    return placed.join(F.broadcast(blocks_before(placed)), "block").select(
        "conv_id", (F.col("before") + F.col("place")).alias("at"), "digest", "chars")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id, length) and their steps (conv_id, depth, digest, chars).

    Conversation c is the first h turns of c - c % 100, then its own turns after its first h; h is
    crc32(c) % 6. A hot conv_id is not gathered anywhere: turns are numbered by one global sort.
    """
    turns = _numbered(conversations)
    own = turns.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    known = own.select("*", (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"), family.alias("base"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_turns"))
    known = settle(known.join(bases, "base", "left").withColumn(
        "heads", F.least("h", F.coalesce("base_turns", F.lit(0)))).drop("base_turns"))
    within = turns.join(known, "conv_id").withColumn("place", F.col("at") - F.col("first"))
    later = within.where("place >= h").select("conv_id", (F.col("heads") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "chars")
    heads = within.where((F.col("conv_id") == F.col("base")) & (F.col("place") < HEADS)).select("base", "place", "digest", "chars")
    begun = known.where("heads > 0").select("conv_id", "base", "heads").join(heads, "base").where("place < heads").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "digest", "chars")
    length = F.col("heads") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return known.select("conv_id", length.alias("length")), settle(later.unionByName(begun))


def _unshared(known: DataFrame, steps: DataFrame) -> DataFrame:
    """(conv_id): conversations of more than ``FOLLOWED`` turns whose first so many no other one has.

    A set hash of (depth, turn) pairs is added up on the map side, so no conversation is gathered for it.
    """
    long = known.where(F.col("length") >= FOLLOWED).select("conv_id", "length")
    begins = steps.where(F.col("depth") <= FOLLOWED).join(long, "conv_id").groupBy("conv_id", "length").agg(
        F.bit_xor(F.xxhash64("depth", "digest")).alias("a"), F.bit_xor(F.xxhash64("digest", F.lit("b"), "depth")).alias("b"))
    once = begins.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.max("length").alias("length"), F.count("*").alias("n"))
    return once.where((F.col("n") == 1) & (F.col("length") > FOLLOWED)).select("conv_id")


class _Block(NamedTuple):
    """Sorted conversations of a block, and how much their first and last share with the rows next to them."""

    conv: np.ndarray
    length: np.ndarray
    lcp: np.ndarray       # with the row before; of the first row, with the block before (-1: there is none)
    after: int            # of the last row with the block after
    chars: np.ndarray     # of all turns, one row after another
    bounds: np.ndarray    # row i has turns bounds[i] to bounds[i + 1]
    open: np.ndarray      # goes on beyond its turns here
    first: str
    last: str


def _common(paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Turns of each path, and how many of them it shares with the path before (-1 for the first)."""
    data = b"".join(p.encode() for p in paths.to_pylist())
    length = np.array([len(p.as_py()) // _DIGITS for p in paths], np.int64)
    at = np.cumsum(length) - length
    _, turn = np.unique(np.frombuffer(data, f"S{_DIGITS}"), return_inverse=True) if data else (None, np.zeros(0, np.int64))
    lcp = np.zeros(len(length), np.int64)
    lcp[:1] = -1
    alike, depth = np.arange(1, len(length)), 0
    while len(alike):
        alike = alike[(length[alike] > depth) & (length[alike - 1] > depth)]
        alike = alike[turn[at[alike] + depth] == turn[at[alike - 1] + depth]]
        depth += 1
        lcp[alike] = depth
    return length, lcp


def _read_block(table: pa.Table) -> _Block:
    table = table.combine_chunks().sort_by("place")
    length, lcp = _common(table.column("path"))
    place = table.column("place").to_numpy()
    own = np.flatnonzero((place >= 0) & (place < _BEYOND))
    begin, end = int(own[0]), int(own[-1])
    chars = table.column("chars").combine_chunks().slice(begin, end - begin + 1)
    length, paths = length[own], table.column("path")
    return _Block(
        table.column("conv_id").to_numpy()[own], length, lcp[own], int(lcp[end + 1]) if end + 1 < len(lcp) else -1,
        chars.flatten().to_numpy(), np.concatenate(([0], np.cumsum(length))),
        table.column("open").to_numpy(zero_copy_only=False)[own], paths[begin].as_py(), paths[end].as_py())


#: place of the row after a block
_BEYOND = 1 << 40


class _SparseTable:
    """The least of any stretch: level k holds the least of 2 ** k values from each place on."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of values first to last, both included, by two levels that overlap."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k, values in enumerate(self.levels):
            at = level == k
            out[at] = np.minimum(values[first[at]], values[last[at] - (1 << k) + 1])
        return out

    def reach_right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place that all values after ``at`` up to it are at least ``depth``, by binary search."""
        at, end = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            able = at + (1 << k) < end
            able[able] = values[at[able] + 1] >= depth[able]
            at[able] += 1 << k
        return at

    def reach_left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place such that all values after it up to ``at`` are at least ``depth``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            able = at - (1 << k) >= 0
            able[able] = values[at[able] - (1 << k) + 1] >= depth[able]
            at[able] -= 1 << k
        return at


def _before(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(values)))


def _prefix_keys(path: str, depths: int) -> list[str]:
    """A key for each prefix of 0 to ``depths`` turns."""
    hashed, keys = hashlib.md5(usedforsecurity=False), []
    for d in range(depths + 1):
        keys.append(hashed.hexdigest())
        hashed.update(path[d * _DIGITS:(d + 1) * _DIGITS].encode())
    return keys


def block_pieces(table: pa.Table) -> pa.Table:
    """The nodes of a block of sorted conversations. A node that reaches beyond the block is a piece with a key."""
    block = _read_block(table)
    conv, length, lcp = block.conv, block.length, block.lcp
    last_row = len(conv) - 1
    # the first row carries the pieces of all its prefixes, also of those that begin in blocks before
    least_depth = lcp + 1
    least_depth[0] = 0
    at = _before(length - least_depth + 1)
    row = np.repeat(np.arange(len(conv)), length - least_depth + 1)
    depth = np.arange(at[-1]) - at[row] + least_depth[row]

    shared = _SparseTable(lcp)
    smallest = _SparseTable(conv)
    left, right = shared.reach_left(row, depth), shared.reach_right(row, depth)
    inner = depth > 0
    parent_left, parent_right = left.copy(), right.copy()
    parent_left[inner] = shared.reach_left(row[inner], depth[inner] - 1)
    parent_right[inner] = shared.reach_right(row[inner], depth[inner] - 1)
    conv_id, parent_conv = smallest.least(left, right), smallest.least(parent_left, parent_right)

    chars = _before(block.chars)
    begin = block.bounds[:-1]
    with_before = np.where(lcp > 0, chars[begin + np.maximum(lcp, 0)] - chars[begin], 0)
    common = _before(with_before)
    leaf = _before(np.concatenate((lcp[1:], [block.after])) < length)
    continued = (left == 0) & (depth <= lcp[0])
    partial = continued | ((right == last_row) & (depth <= block.after))
    # the row a node begins with shares turns of other nodes only
    own = common[right + 1] - common[left] - np.where(continued, 0, with_before[left])
    new = np.flatnonzero(inner & ~continued)
    children = np.bincount(at[parent_left[new]] + depth[new] - 1 - least_depth[parent_left[new]], minlength=len(row))
    goes_on = np.flatnonzero(block.open)
    np.add.at(children, at[goes_on] + length[goes_on] - least_depth[goes_on], 1)

    # members that end in a node are the equal conversations its interval begins with
    fresh = np.flatnonzero(np.concatenate(([True], (lcp[1:] < length[1:]) | (length[:-1] < length[1:]))))
    stop = np.append(fresh, len(conv))[np.searchsorted(fresh, left, side="right")]
    ends = np.full(len(row), _NO_ENDS, object)
    key, parent_key = np.full(len(row), None, object), np.full(len(row), None, object)
    ids: list[tuple[str, int, int, str]] = []
    head, tail = _prefix_keys(block.first, max(0, int(lcp[0]))), _prefix_keys(block.last, max(0, block.after))
    for i in np.flatnonzero(partial):
        key[i] = head[depth[i]] if continued[i] else tail[depth[i]]
        ends[i] = None
    parent_partial = ((parent_left == 0) & (depth - 1 <= lcp[0])) | ((parent_right == last_row) & (depth - 1 <= block.after))
    for i in np.flatnonzero(inner & parent_partial):
        parent_key[i] = head[depth[i] - 1] if parent_left[i] == 0 and depth[i] - 1 <= lcp[0] else tail[depth[i] - 1]
    for i in np.flatnonzero((length[left] == depth) & ~block.open[left]):
        text = ",".join(map(str, conv[left[i]:stop[i]].tolist()))
        if partial[i]:
            ids += [(key[i], int(depth[i]), part, text[start:start + _IDS]) for part, start in enumerate(range(0, len(text), _IDS))]
        else:
            ends[i] = hashlib.sha256(text.encode()).hexdigest()
    number = table.column("block")[0].as_py()
    n = len(row)
    before = np.where(inner, chars[begin[row] + np.maximum(depth - 1, 0)] - chars[begin[row]], 0)
    nodes = pa.table({
        "key": pa.array(key, pa.string()), "parent_key": pa.array(parent_key, pa.string()), "conv_id": conv_id, "depth": depth,
        "parent_conv_id": pa.array(parent_conv, mask=~inner), "n_convs": right - left + 1, "n_children": children,
        "n_leaves": leaf[right + 1] - leaf[left], "shared": own, "before": before, "ends": pa.array(ends, pa.string()),
        "block": pa.array(np.full(n, number, np.int32)), "part": pa.nulls(n, pa.int32()), "ids": pa.nulls(n, pa.string())})
    if not ids:
        return nodes
    keys, depths, parts, texts = zip(*ids)
    rest = {f.name: pa.nulls(len(ids), f.type) for f in nodes.schema}
    return pa.concat_tables([nodes, pa.table(rest | {
        "key": pa.array(keys, pa.string()), "depth": pa.array(depths, pa.int64()), "part": pa.array(parts, pa.int32()),
        "ids": pa.array(texts, pa.string()), "block": pa.array([number] * len(ids), pa.int32())}, schema=nodes.schema)])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) of rows sorted by key, block and part: one running hash, whatever the number of members."""
    now, block, hashed = None, None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([hashed.hexdigest()])], ["key", "ends"])

    for batch in batches:
        for key, number, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "ids"))):
            if key != now:
                if now is not None:
                    yield done()
                now, hashed = key, hashlib.sha256()
            elif number != block:
                hashed.update(b",")
            hashed.update(ids.encode())
            block = number
    if now is not None:
        yield done()


def _with_neighbours(placed: DataFrame) -> DataFrame:
    """The rows of all blocks, and for each block the row before and the row after it."""
    order = Window.orderBy("block")
    known = placed.groupBy("block").agg(F.max("place").alias("end")).select(
        "block", "end", F.lag("block").over(order).alias("before"), F.lead("block").over(order).alias("after"))
    edges = placed.join(known, "block")
    rest = [c for c in placed.columns if c not in ("block", "place")]
    befores = edges.where("place = end AND after IS NOT NULL").select(F.col("after").alias("block"), F.lit(-1).cast("bigint").alias("place"), *rest)
    afters = edges.where("place = 0 AND before IS NOT NULL").select(F.col("before").alias("block"), F.lit(_BEYOND).alias("place"), *rest)
    return placed.unionByName(befores).unionByName(afters)


def _nodes(*extra: Column) -> list[Column]:
    saved = F.col("shared") - (F.col("n_convs") - 1) * F.col("before")
    return [*map(F.col, ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")), saved.alias("saved_tokens"),
            F.col("ends").alias("ends_sha256"), *extra]


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations, the empty one included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), all but the
    last of them long. ``conversations`` needs conv_id, turn, role and text; other columns are not looked at, whatever their names.

    Rows without a conv_id belong to no conversation. A null turn comes first, turns of one number go by
    a hash of role and text, repeated rows are turns of their own. Null role or text counts as empty. Equal
    conversations are members of the same nodes. Texts of any length enter by their digest and number of
    characters. A conversation of more than 64 turns is gathered only as far as another one may share it; its
    other turns are nodes with one member. An empty table has no root and gives no rows.
    """
    ship(conversations.sparkSession)
    known, steps = rebuilt(conversations)
    alone = settle(_unshared(known, steps))
    far = steps.where(F.col("depth") > FOLLOWED)
    near = steps.where(F.col("depth") <= FOLLOWED).unionByName(far.join(alone, "conv_id", "left_anti"))
    paths = near.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "chars"))).alias("turns"))
    rows = known.join(paths, "conv_id", "left").join(alone.withColumn("open", F.lit(True)), "conv_id", "left").select(
        "conv_id", F.coalesce(F.array_join("turns.digest", ""), F.lit("")).alias("path"),
        F.coalesce("turns.chars", F.array().cast("array<bigint>")).alias("chars"), F.coalesce("open", F.lit(False)).alias("open"))
    turns = known.agg(F.count("*") + F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    placed = with_block_places(rows, [F.col("path").asc(), F.col("conv_id").asc()], -(-turns // block_turns))
    pieces = settle(_with_neighbours(placed).groupBy("block").applyInArrow(block_pieces, _PIECES))

    whole = pieces.where("key IS NULL")
    texts = pieces.where("ids IS NOT NULL").select("key", "block", "part", "ids")
    ends = texts.repartition("key").sortWithinPartitions("key", "block", "part").mapInArrow(_hash_ids, "key string, ends string")
    spread = settle(pieces.where("key IS NOT NULL AND ids IS NULL").groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")], F.max("before").alias("before"))
        .join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.lit(_NO_ENDS))))
    parents = spread.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    below = whole.where("parent_key IS NOT NULL").drop("parent_conv_id").join(parents, "parent_key")
    tails = far.join(alone, "conv_id").join(known, "conv_id")
    end = F.col("depth") == F.col("length")
    one = F.lit(1).cast("bigint")
    return (
        whole.where("parent_key IS NULL").select(*_nodes())
        .unionAll(below.select(*_nodes()))
        .unionAll(spread.join(parents, "parent_key", "left").select(*_nodes()))
        .unionAll(tails.select("conv_id", "depth", "conv_id", one, F.when(end, 0).otherwise(1).cast("bigint"), one, F.lit(0).cast("bigint"),
                               F.when(end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_NO_ENDS))))


# SQL for the same rows: CRC-32 bit by bit, every beginning as a list, every pair of beginnings for the sums
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda r, z: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)), 4294967295::BIGINT)"""

ORACLE = f"""
WITH turns AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, CAST({_CRC} % 6 AS BIGINT) AS h, conv_id - conv_id % 100 AS base, list(said ORDER BY place) AS said
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.said[1:o.h], []), o.said[o.h + 1:]) AS said
  FROM own o LEFT JOIN own b ON b.conv_id = o.base),
beginnings AS (
  SELECT conv_id, said[1:depth] AS node, depth, depth = len(said) AS ends
  FROM rebuilt, LATERAL (SELECT unnest(range(len(said) + 1)) AS depth)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM beginnings GROUP BY node, depth),
children AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
leafed AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node, depth)),
above AS (
  SELECT node[1:up] AS node, up AS depth, n_children = 0 AS leaf,
         CASE WHEN depth > 0 THEN (n_convs - 1) * length(node[depth].t) ELSE 0 END AS saved
  FROM leafed, LATERAL (SELECT unnest(range(depth + 1)) AS up)),
sums AS (SELECT node, depth, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY node, depth)
SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(l.n_convs AS BIGINT) AS n_convs,
       CAST(l.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
FROM leafed l JOIN sums USING (node, depth)
LEFT JOIN nodes p ON l.depth > 0 AND p.depth = l.depth - 1 AND p.node = l.node[1:l.depth - 1]"""
