"""Removal of word passages an earlier document holds, by prefix-partitioned suffix trees.

A suffix is a position in a document with the words that follow. Suffixes are split by prefixes of
one, two or eight words, longer where a prefix is frequent, into groups that fit in memory. Each
group is one subtree: its suffixes in order with the common prefix lengths of neighbours, where a
node of depth d is a run of neighbours that share d words or more. Runs at depth 13 or more are the
repeats; in each, all suffixes but those of the smallest document are marked.

Few positions of a corpus repeat, so only these become suffixes. Each window of 13 words is known by
the smallest hash of its runs of five words, which equal windows share. Smallest hashes that occur
twice set a bit in a filter of fixed size; a window whose bit is not set cannot repeat. The filter
decides what is looked at, never what is marked. Within a batch of documents all but the smallest
document of a window are marked at once, so a passage that most documents share travels once for
each batch and no group grows with the number of its copies. Marks are dealt by document, into buckets
whose number is planned from the positions of the input; those made in a batch go there as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.llm.shipping import ship
from regista.llm.words import Words, mixed, pieces, run_hashes, same_text, text_buffer

WINDOW = 13
_SEED_WORDS = 5
#: bits of the filter: 16 MB on the driver and in each worker, however large the input
FILTER_BITS = 27
#: suffixes of a group, counted over all positions (of which a part become suffixes); a bucket of
#: documents has about as many marks at most
GROUP_SUFFIXES = 1_000_000
_SYMBOLS = 8                 # words of a suffix that are told apart singly; the rest is one edge
_LAST = (1 << 63) - 1        # stands for a null doc_id: after all others
_U = np.uint64


def row_key() -> tuple[Column, Column, Column]:
    """(key, digest, text) of a row; rows of one id with different texts stay apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)), F.xxhash64(text), text


def _windows(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(start, smallest hash of its five-word runs) of each window within one text."""
    inside = np.flatnonzero(same_text(w.text, WINDOW))
    runs = run_hashes(w.hashes, _SEED_WORDS)
    span, wide = runs, 1
    reach = WINDOW - _SEED_WORDS + 1
    while 2 * wide <= reach:
        span = np.minimum(span[:-wide], span[wide:])
        wide *= 2
    if wide < reach:
        span = np.minimum(span[:len(span) - (reach - wide)], span[reach - wide:])
    return inside, span[inside]


def _symbols(hashes: np.ndarray) -> np.ndarray:
    """The top bytes of eight words from each position on, as one number in their order."""
    top = hashes >> _U(56)
    n = len(hashes) - WINDOW + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(_SYMBOLS):
        out = (out << _U(8)) | top[j:j + n]
    return out


def _anchor_batches(shard_bits: int):
    shards, share = 1 << shard_bits, (1 << 16) >> shard_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = np.zeros(1 << 16, np.int64)
        for batch in batches:
            found = []
            for w in pieces(batch.column(0)):
                start, least = _windows(w)
                if len(start):
                    text = w.text[start]
                    found.append(least[np.concatenate(([True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])))])
                    prefixes += np.bincount((_symbols(w.hashes)[start] >> _U(48)).astype(np.int64), minlength=1 << 16)
            if found:
                # once or twice is all that matters of a batch
                values, count = np.unique(np.concatenate(found), return_counts=True)
                values = np.repeat(values, np.minimum(count, 2))
                cuts = np.searchsorted(values, np.arange(1, shards, dtype=np.uint64) << _U(64 - shard_bits))
                parts = np.split(values, cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(shards), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()),
                     pa.nulls(shards, pa.binary())], ["shard", "anchors", "prefixes"])
        if prefixes.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(shards), pa.int32()), pa.nulls(shards, pa.binary()),
                 pa.array([prefixes[s * share:(s + 1) * share].tobytes() for s in range(shards)], pa.binary())],
                ["shard", "anchors", "prefixes"])

    return run


def _joined(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]


def _filter_slices(shard_bits: int):
    bits = FILTER_BITS - shard_bits

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        values = np.sort(np.concatenate([np.zeros(0, np.uint64), *_joined(table.column("anchors"), "<u8")]))
        twice = values[1:][values[1:] == values[:-1]]
        flags = np.zeros(1 << bits, np.uint8)
        flags[((twice >> _U(64 - FILTER_BITS)) & _U((1 << bits) - 1)).astype(np.int64)] = 1
        counts = _joined(table.column("prefixes"), "<i8")
        return pa.table({"shard": pa.array([shard], pa.int32()), "bits": pa.array([np.packbits(flags).tobytes()]),
                         "prefixes": pa.array([(np.sum(counts, axis=0) if counts else np.zeros(0, np.int64)).tobytes()])})

    return run


class _Plan(NamedTuple):
    """Which windows may repeat, the group of each prefix of two words, and how many groups and buckets.

    Prefixes that fit are packed whole, neighbours together; one that does not has ``splits`` groups
    from its own on, told apart by eight words.
    """

    flags: np.ndarray
    group: np.ndarray
    splits: np.ndarray
    groups: int
    buckets: int    # of documents; bucket b is group ``groups + b`` of what batches send


def _plan(docs: DataFrame, group_suffixes: int) -> _Plan:
    """Reads all texts once; what reaches the driver has a fixed size."""
    want = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard_bits = max(3, min(16, (2 * want - 1).bit_length()))
    anchors = docs.select(row_key()[2].alias("text")).mapInArrow(
        _anchor_batches(shard_bits), "shard int, anchors binary, prefixes binary")
    rows = anchors.groupBy("shard").applyInArrow(
        _filter_slices(shard_bits), "shard int, bits binary, prefixes binary").toArrow().sort_by("shard").to_pylist()
    flags = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    counts = np.zeros(1 << 16, np.int64)
    for row in rows:
        part, prefixes = np.frombuffer(row["bits"], np.uint8), np.frombuffer(row["prefixes"], np.int64)
        flags[row["shard"] * len(part):(row["shard"] + 1) * len(part)] = part
        share = (1 << 16) >> shard_bits
        if len(prefixes):
            counts[row["shard"] * share:(row["shard"] + 1) * share] = prefixes
    group_of, splits = np.zeros(1 << 16, np.int32), np.ones(1 << 16, np.int32)
    number, filled = 0, 0
    one = counts.reshape(256, 256).sum(axis=1)
    for first in range(256):
        whole = one[first] <= group_suffixes
        for second in range(256):
            prefix = first << 8 | second
            size = int(one[first] if whole else counts[prefix])
            if not (whole and second):
                if filled and filled + size > group_suffixes:
                    number, filled = number + 1, 0
                filled += size
            group_of[prefix] = number
            if size > group_suffixes:
                splits[prefix] = -(-size // group_suffixes)
                number, filled = number + int(splits[prefix]), 0
    return _Plan(flags, group_of, splits, number + 1, max(want, -(-int(counts.sum()) // group_suffixes)))


def _pack(doc: np.ndarray, place: np.ndarray, keys: np.ndarray, digests: np.ndarray, *edges: np.ndarray) -> bytes:
    """Places, what belongs to each (``edges``, 64 bits) and the documents they are from, in one value;
    ``doc`` points into keys and digests."""
    own, doc = np.unique(doc, return_inverse=True)
    sizes = np.asarray([len(doc), len(own)], "<i8")
    return b"".join(x.tobytes() for x in (sizes, keys[own], digests[own], *edges, doc.astype("<u4"), place.astype("<u4")))


def _unpack(raw: pa.BinaryScalar, edges: int = 0) -> tuple[np.ndarray, ...]:
    """(keys, digests, edges, doc, place)"""
    buffer, at, out = raw.as_buffer(), 16, []
    n, docs = np.frombuffer(buffer, "<i8", 2)
    for kind, count in (("<i8", docs), ("<i8", docs), *[("<u8", n)] * edges, ("<u4", n), ("<u4", n)):
        out.append(np.frombuffer(buffer, kind, count, at))
        at += out[-1].nbytes
    return tuple(out)


def _parts(target: np.ndarray) -> list[np.ndarray]:
    """The places of each value of ``target``."""
    by = np.argsort(target, kind="stable")
    return np.split(by, np.flatnonzero(target[by][1:] != target[by][:-1]) + 1) if len(by) else []


def _by_bucket(doc: np.ndarray, place: np.ndarray, keys: np.ndarray, digests: np.ndarray, buckets: int) -> tuple[list[int], list[bytes]]:
    """Marks as a value for each bucket of documents: (buckets, values)."""
    target = (mixed(digests.view(np.uint64) ^ mixed(keys.view(np.uint64))) % _U(buckets)).astype(np.int64)[doc]
    parts = _parts(target)
    return [int(target[p[0]]) for p in parts], [_pack(doc[p], place[p], keys, digests) for p in parts]


def _repeats(hi: np.ndarray, lo: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subtree of these suffixes: (order, whether a smaller document shares 13 words or more).

    Neighbours in order share as many words as their leading symbols agree, and the whole window
    where also the last edge (a hash of all its words) agrees.
    """
    order = np.lexsort((lo, hi))
    h, e, k = hi[order], lo[order], key[order]
    differ = h[1:] ^ h[:-1]
    depth = np.where(differ == 0, _SYMBOLS, 0)
    depth[(differ == 0) & (e[1:] == e[:-1])] = WINDOW
    if not len(order):
        return order, np.zeros(0, bool)
    nodes = np.flatnonzero(np.concatenate(([True], depth < WINDOW)))   # first leaf of each node at full depth
    least = np.repeat(np.minimum.reduceat(k, nodes), np.diff(np.append(nodes, len(k))))
    return order, k > least


def _suffix_batches(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, group_of, splits, groups, buckets = plan.value
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            data, bounds = text_buffer(batch.column(1))
            digests = np.zeros(batch.num_rows, np.int64)
            parts: list[tuple[np.ndarray, ...]] = []
            for w in pieces(batch.column(1)):
                start, least = _windows(w)
                at = least >> _U(64 - FILTER_BITS)
                may = (flags[(at >> _U(3)).astype(np.int64)] >> (_U(7) - (at & _U(7))).astype(np.uint8)) & 1
                start = start[may.astype(bool)]
                if len(start):
                    head = np.searchsorted(w.text, w.text[start])
                    parts.append((_symbols(w.hashes)[start], run_hashes(w.hashes, WINDOW)[start],
                                  w.first + w.text[start], start - head))
            if not parts:
                continue
            hi, lo, doc, place = (np.concatenate(x) for x in zip(*parts))
            for row in np.unique(doc).tolist():
                digests[row] = np.uint64(xxhash.xxh64_intdigest(data[bounds[row]:bounds[row + 1]].tobytes(), 42)).astype(np.int64)
            order, later = _repeats(hi, lo, keys[doc])
            marked, stay = np.sort(order[later]), np.sort(order[~later])
            target, payload = _by_bucket(doc[marked], place[marked], keys, digests, buckets)
            target = [groups + bucket for bucket in target]
            prefix = (hi[stay] >> _U(48)).astype(np.int64)
            group = group_of[prefix] + (mixed(hi[stay]) % splits[prefix].astype(np.uint64)).astype(np.int32)
            for part in _parts(group):
                own = stay[part]
                target.append(int(group[part[0]]))
                payload.append(_pack(doc[own], place[own], keys, digests, hi[own], lo[own]))
            yield pa.RecordBatch.from_arrays([pa.array(target, pa.int32()), pa.array(payload, pa.binary())], ["group", "payload"])

    return run


def _subtree(groups: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """Marks of one group, in a value for each bucket of documents. Marks made in batches are in their bucket already."""
        number = table.column("group")[0].as_py()
        if number >= groups:
            return pa.table({"bucket": pa.array(np.full(table.num_rows, number - groups, np.int32)), "marks": table.column("payload")})
        target, marks = _by_bucket(*_marked(table), buckets)
        return pa.table({"bucket": pa.array(target, pa.int32()), "marks": pa.array(marks, pa.binary())})

    return run


def _marked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place, keys, digests): the suffixes of a group that are marked, and the documents of the group."""
    parts = [_unpack(raw, 2) for raw in table.column("payload")]
    shift = np.cumsum([0, *[len(p[0]) for p in parts]])
    key, digest, hi, lo = (np.concatenate([p[i] for p in parts]) for i in range(4))
    doc = np.concatenate([p[4].astype(np.int64) + s for p, s in zip(parts, shift)])
    place = np.concatenate([p[5] for p in parts])
    order, later = _repeats(hi, lo, key[doc])
    marked = order[later]
    return doc[marked], place[marked], key, digest


def _by_document(table: pa.Table) -> pa.Table:
    """Marks of one bucket: (key, digest, places), a row for each document with any."""
    parts = [_unpack(raw) for raw in table.column("marks")]
    shift = np.cumsum([0, *[len(p[0]) for p in parts]])
    key, digest = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    doc = np.concatenate([p[2].astype(np.int64) + s for p, s in zip(parts, shift)])
    place = np.concatenate([p[3] for p in parts])
    by = np.lexsort((place, digest[doc], key[doc]))
    k, d, place = key[doc[by]], digest[doc[by]], place[by].astype("<u4")
    cuts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1]))))
    ends = np.append(cuts, len(k)).tolist()
    return pa.table({"key": pa.array(k[cuts]), "digest": pa.array(d[cuts]),
                     "places": pa.array([place[s:e].tobytes() for s, e in zip(ends, ends[1:])], pa.binary())})


def repeats(docs: DataFrame, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(key, digest, places): for each row of ``docs`` with any, where windows start that an earlier
    document holds too. Places are word numbers, in little-endian 32-bit lists."""
    ship(docs.sparkSession)
    key, digest, text = row_key()
    plan = _plan(docs, group_suffixes)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(plan))
    suffixes = docs.select(key.alias("key"), text.alias("text")).mapInArrow(_suffix_batches(shared), "group int, payload binary")
    marks = suffixes.groupBy("group").applyInArrow(_subtree(plan.groups, plan.buckets), "bucket int, marks binary")
    return marks.groupBy("bucket").applyInArrow(_by_document, "key bigint, digest bigint, places binary")


def _kept(text: bytes, places: bytes | None) -> tuple[int, list[bytes] | None]:
    """The number of words, and those that stay; None if all do."""
    words = text.split()     # bytes split at 0x20 and 0x09 to 0x0D
    if not places:
        return len(words), None
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.unique(np.frombuffer(places, "<u4")).astype(np.int64)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return len(words), list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, removed, digests = [], [], []
        for text, places in zip(batch.column(1), batch.column(2)):
            raw = text.as_buffer().to_pybytes()
            n, kept = _kept(raw, places.as_py())
            words.append(n)
            removed.append(0 if kept is None else n - len(kept))
            digests.append(hashlib.sha256(b" ".join(raw.split() if kept is None else kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(digests, pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _text_batches(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, places in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                kept = _kept(text.as_py().encode(), places.as_py())[1] if places.is_valid else None
                texts.append(text.as_py() if kept is None else b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])], batch.schema.names[:-1])

    return run


def _with_places(docs: DataFrame, marks: DataFrame) -> DataFrame:
    key, digest, _ = row_key()
    return docs.withColumn("__key", key).withColumn("__digest", digest).join(
        marks.select(F.col("key").alias("__key"), F.col("digest").alias("__digest"), F.col("places").alias("__places")),
        ["__key", "__digest"], "left").drop("__key", "__digest")


def removal_digests(docs: DataFrame, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row of ``docs`` (doc_id, text; more are ignored).

    A word goes if a window of 13 words over it also starts in a document of a smaller doc_id. Null
    text counts as empty. A null doc_id comes after all others; repeated rows have the same id, so
    none is earlier. An empty table gives no rows.
    """
    docs = docs.select("doc_id", row_key()[2].alias("text"))
    return _with_places(docs, repeats(docs, group_suffixes)).mapInArrow(
        _digest_batches, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``; all columns and rows stay.

    Texts without a repeat stay as they are. In others the words left are joined by single spaces.
    Null texts stay null.
    """
    marks = repeats(docs, group_suffixes)
    filled = docs.withColumn("__null", F.col("text").isNull()).withColumn("text", row_key()[2])
    joined = _with_places(filled, marks)
    schema = joined.drop("__places").schema
    cut = joined.mapInArrow(_text_batches(joined.columns.index("text")), schema)
    return cut.withColumn("text", F.when(~F.col("__null"), F.col("text"))).select(*docs.columns)
