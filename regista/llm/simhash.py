"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most four bits differ in at most four of their eight
bytes, so they share at least four bytes in place. The index lists fingerprints under the bytes they
have at a few positions; pairs that meet there are tallied over all eight positions, those with at
least four shared bytes stay, and the differing bits of these are counted.

Single positions would list one 256th of all fingerprints each. Positions are therefore taken two,
three or four together, in sets chosen so that any four positions contain one of them
(:func:`position_sets`): nothing is missed, lists stay short, and the set size follows the number of
distinct fingerprints. Equal fingerprints are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.llm.components import components
from regista.llm.shipping import ship
from regista.llm.words import Words, pieces
from regista.workspace import settle

BITS = 4           # most differing bits of a link
SHINGLE = 4
SEED = 42
BYTES = 8
#: lists longer than this are compared in parts, each pair of parts by itself
LIST_PART = 4096
#: lists up to this long are compared by shifting the whole batch
_SHORT = 32
_SPREAD = np.uint64(0x0101010101010101)


def position_sets(width: int, sharing: int = BYTES - BITS) -> list[tuple[int, ...]]:
    """Sets of ``width`` byte positions such that any ``sharing`` positions contain one of them.

    For width two, positions fall in three classes and each pair inside a class is taken: of four
    positions, two share a class. For width three, also two of one class with one of the next.
    """
    if width == sharing:
        return list(combinations(range(BYTES), width))
    if width == 1:
        return [(p,) for p in range(BYTES - sharing + 1)]
    classes = sharing - 1
    of = [p * classes // BYTES for p in range(BYTES)]
    if width == 2:
        return [pair for pair in combinations(range(BYTES), 2) if of[pair[0]] == of[pair[1]]]
    chosen = []
    for three in combinations(range(BYTES), 3):
        kinds = sorted(of[p] for p in three)
        if kinds[0] == kinds[2]:
            chosen.append(three)
        elif len(set(kinds)) == 2:
            double = kinds[1]
            single = kinds[0] if kinds[2] == double else kinds[2]
            if single == (double + 1) % classes:
                chosen.append(three)
    return chosen


def set_width(distinct: int) -> int:
    """Positions taken together so that a fingerprint meets some hundreds of others at most."""
    return 2 if distinct < 1 << 20 else 3 if distinct < 1 << 27 else 4


def _fingerprints(w: Words) -> np.ndarray:
    """One fingerprint for each text of a piece, zero where it has no word."""
    out = np.zeros(w.texts, np.uint64)
    if not len(w.starts):
        return out
    gap = (w.data == 32) | ((w.data >= 9) & (w.data <= 13))
    keep = ~gap
    keep[w.starts[w.starts > 0] - 1] = True
    place = np.cumsum(keep) - 1
    flat = np.where(gap, np.uint8(32), w.data)[keep]
    # two texts may touch without a gap between them; shingles never reach across, so that is harmless
    starts, ends = place[w.starts], place[w.ends - 1] + 1
    count = np.bincount(w.text, minlength=w.texts)
    begin = np.concatenate(([0], np.cumsum(count)))
    index = np.arange(len(starts))
    left = begin[w.text + 1] - index          # words from here to the end of the text
    head = (left >= SHINGLE) | (index == begin[w.text])
    head = np.flatnonzero(head)
    tail = head + np.minimum(left[head], SHINGLE) - 1
    raw, digest = flat.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[s:e], SEED) for s, e in zip(starts[head].tolist(), ends[tail].tolist())),
                    np.uint64, len(head))
    text = w.text[head]
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    # eight one-byte counters in a 64-bit number, added over runs of at most 255 shingles
    run = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    cuts = np.flatnonzero(run % 255 == 0)
    owner = text[cuts]
    many = np.bincount(text, minlength=w.texts)
    for shift in range(8):
        sums = np.add.reduceat((h >> np.uint64(shift)) & _SPREAD, cuts)
        lanes = sums.view(np.uint8).reshape(-1, 8)
        for lane in range(8):
            total = np.bincount(owner, weights=lanes[:, lane], minlength=w.texts)
            out |= (2 * total > many).astype(np.uint64) << np.uint64(8 * lane + shift)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_fingerprints(w) for w in pieces(batch.column(1), lower=True)]
        bits = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], ["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits): the 64 bits as a signed number. Null texts count as empty: all bits zero."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _fingerprint_batches, "doc_id bigint, bits bigint")


def _index_batches(sets: list[tuple[int, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, positions in enumerate(sets):
                key = np.full(len(bits), number, np.uint64)
                for p in positions:
                    key = (key << np.uint64(8)) | ((bits >> np.uint64(8 * p)) & np.uint64(255))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], ["list", "bits"])

    return run


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Tally of shared positional bytes first, then the differing bits of the pairs left."""
    differ = a ^ b
    shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    ok = shared >= BYTES - BITS
    ok[ok] = np.bitwise_count(differ[ok]) <= BITS
    return ok


def _forest(left: np.ndarray, right: np.ndarray | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that join what is linked within one list (or between two parts): a spanning forest.

    Each step takes one fingerprint and looks for links among those not reached yet, so a list of n
    gives fewer than n links however many pairs of it are linked.
    """
    values = left if right is None else np.concatenate((left, right))
    side = None if right is None else np.arange(len(values)) >= len(left)
    waiting = np.arange(len(values))
    froms, tos = [], []
    queue: list[int] = []
    while len(waiting):
        if not queue:
            queue.append(int(waiting[0]))
            waiting = waiting[1:]
        at = queue.pop()
        ok = _linked(np.full(len(waiting), values[at]), values[waiting])
        if side is not None:
            ok &= side[waiting] != side[at]
        hit = waiting[ok]
        if len(hit):
            froms.append(np.full(len(hit), values[at]))
            tos.append(values[hit])
            waiting = waiting[~ok]
            queue.extend(hit.tolist())
    return froms, tos


def _list_links(keys: np.ndarray, bits: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys; ``sides`` 0 and 1 are compared with each other only, 2 among themselves."""
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(cuts, len(keys)))
    froms, tos = [], []
    for at, size in zip(cuts[sizes > _SHORT].tolist(), sizes[sizes > _SHORT].tolist()):
        part, side = bits[at:at + size], sides[at:at + size]
        f, t = _forest(part, None) if side[0] == 2 else _forest(part[side == 0], part[side == 1])
        froms += f
        tos += t
    short = np.repeat(sizes <= _SHORT, sizes)
    k, b, s = keys[short], bits[short], sides[short]
    for step in range(1, _SHORT):
        meet = np.flatnonzero((k[step:] == k[:-step]) & ((s[step:] == 2) | (s[step:] != s[:-step]))) if step < len(k) else []
        if not len(meet) and not (step < len(k) and (k[step:] == k[:-step]).any()):
            break
        ok = _linked(b[meet], b[meet + step])
        froms.append(b[meet][ok])
        tos.append(b[meet + step][ok])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *froms]), np.concatenate([empty, *tos])


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads rows in order of (list, part); the last list of a batch waits for the next batch."""
    kept: list[np.ndarray] | None = None

    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        a, b = _list_links(rows[0], rows[1].view(np.uint64), rows[2])
        a, b = a.view(np.int64), b.view(np.int64)
        both = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        # a list and the pair of its parts in one number, equal exactly where both are
        fresh = [np.stack((columns[0], columns[1]), axis=1), columns[2], columns[3]]
        rows = fresh if kept is None else [np.concatenate(x) for x in zip(kept, fresh)]
        turn = np.concatenate(([True], (rows[0][1:] != rows[0][:-1]).any(axis=1)))
        number, last = np.cumsum(turn), int(np.flatnonzero(turn)[-1])
        if last:
            yield links([number[:last], rows[1][:last], rows[2][:last]])
        kept = [x[last:] for x in rows]
    if kept is not None:
        yield links([np.zeros(len(kept[1]), np.int64), kept[1], kept[2]])


def links(bits: DataFrame, distinct: int) -> DataFrame:
    """(a, b) with a > b: links that join all fingerprints reachable from each other.

    ``bits`` has each fingerprint once. A list longer than :data:`LIST_PART` is cut into parts by a
    hash; every part is compared with itself and with each other part, each such pair being a group
    of its own, so no task gathers a long list.
    """
    sets = position_sets(set_width(distinct))
    index = bits.select("bits").mapInArrow(_index_batches(sets), "list bigint, bits bigint")
    long = (index.groupBy("list").count().where(F.col("count") > LIST_PART)
            .select("list", F.ceil(F.col("count") / F.lit(LIST_PART)).cast("int").alias("parts")))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    mine = F.pmod(F.xxhash64("bits"), parts).cast("int")
    placed = index.join(long, "list", "left").select("list", "bits", parts.alias("parts"), mine.alias("mine"))
    meets = placed.select(
        "list", "bits", "parts", "mine",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "list",
        (F.least("mine", "other") * F.col("parts").cast("bigint") + F.greatest("mine", "other")).alias("pair"),
        "bits",
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"))
    found = meets.repartition("list", "pair").sortWithinPartitions("list", "pair").mapInArrow(
        _link_batches, "a bigint, b bigint")
    return found.distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text; more are ignored).

    ``component_id`` is the smallest doc_id reachable over links of at most four differing bits,
    the row's own included. Null text counts as empty (fingerprint zero, linked like any other).
    Rows with a null doc_id take part; a component of such rows only has a null id. Repeated rows
    give repeated results; an empty table gives none.
    """
    ship(docs.sparkSession)
    prints = settle(fingerprints(docs))
    entries = settle(prints.groupBy("bits").agg(F.min("doc_id").alias("least")))
    found = components(links(entries, entries.count()))
    labelled = entries.join(found, entries["bits"] == found["node"], "left").select(
        "bits", "least", F.coalesce("label", "bits").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = labelled.join(least, "label").select("bits", "component_id")
    return prints.join(classes, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
