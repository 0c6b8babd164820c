"""Importance resampling towards a target text: hashed word n-grams, Gumbel top-k.

Every run of 1 to 3 words falls into the bucket of its CRC. A document is scanned once: its words,
joined by one space, feed one running CRC, which is kept at the start and the end of each word. CRC
is linear over GF(2). The CRC of the bytes between two places is the CRC at the second, less (XOR)
the CRC at the first moved on by as many zero bytes as lie between. So any run of words costs one
shift of a stored value, however long it is, and no n-gram is ever put together as text.

Bucket counts of all documents and of the target are summed in Spark; the logarithm of their ratio
is what a feature weighs. Sampling without replacement is taking the highest weights after Gumbel
noise, which here comes from a hash of the document's id: the draw is the same on every run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.llm.ordering import blocks_before, with_block_places
from regista.llm.shipping import ship
from regista.workspace import settle

BUCKETS = 10_000
#: longest run of words that is a feature
LONGEST = 3
#: documents drawn, in hundredths of those with enough words
PERCENT = 5
MIN_WORDS = 20
SEED = 42
#: words whose n-grams are taken together
_BLOCK_WORDS = 1 << 17
#: bytes of a text that are split into words together
_SLICE = 1 << 20
#: word bytes stay, A to Z become a to z, all other ASCII becomes a space
_WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256))


# --- CRC-32 over GF(2) ---

@lru_cache(maxsize=1)
def _one_byte() -> np.ndarray:
    """What each lowest byte of a register becomes when a zero byte follows."""
    return np.array([crc32(bytes([v])) ^ crc32(b"\0") for v in range(256)], np.uint32)


def _applied(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map, given as what each value of each of the four bytes becomes."""
    out = table[0][values & 255]
    for byte in (1, 2, 3):
        out = out ^ table[byte][(values >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


@lru_cache(maxsize=1)
def _short_shifts() -> np.ndarray:
    """(256 lengths, 4 bytes, 256 values): values moved on by up to 255 zero bytes."""
    step, tables = _one_byte(), np.empty((256, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, 256):
        tables[n] = step[tables[n - 1] & 255] ^ (tables[n - 1] >> np.uint32(8))
    return tables


@lru_cache(maxsize=64)
def _long_shift(bit: int) -> np.ndarray:
    """The map for 2 ** bit zero bytes, bit at least 8: the map for half as many, twice."""
    half = _short_shifts()[128] if bit == 8 else _long_shift(bit - 1)
    return _applied(half, half)


def shifted(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs moved on by ``lengths`` zero bytes, each by its own."""
    short, low = _short_shifts(), lengths & 255
    out = short[low, 0, values & 255]
    for byte in (1, 2, 3):
        out = out ^ short[low, byte, (values >> np.uint32(8 * byte)) & np.uint32(255)]
    for bit in range(8, int(lengths.max(initial=0)).bit_length()):
        far = (lengths >> bit) & 1 == 1
        out[far] = _applied(_long_shift(bit), out[far])
    return out


# --- running CRCs of texts ---

class _Words(NamedTuple):
    """Words in a row: their text's number, length, and the running CRC at their start and end."""

    text: np.ndarray
    length: np.ndarray
    opened: np.ndarray
    closed: np.ndarray
    seen: int        # so many of the first words were in the block before


def _slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of one text, some at a time."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= _SLICE else data.rfind(b" ", at, at + _SLICE) + 1
        if end <= at:                       # a word longer than a slice
            end = data.find(b" ", at + _SLICE) + 1 or len(data)
        yield data[at:end].split()
        at = end


def _scan(texts: Iterator[str | None], longest: int) -> Iterator[_Words]:
    """Every word of every text, in order; the last words of a block begin the next one too."""
    number: list[int] = []
    length: list[int] = []
    opened: list[int] = []
    closed: list[int] = []
    seen = 0

    def block():
        return _Words(np.array(number, np.int64), np.array(length, np.int64), np.array(opened, np.uint32),
                      np.array(closed, np.uint32), seen)

    for i, text in enumerate(texts):
        crc = 0
        for words in _slices((text or "").encode().translate(_WORD_BYTES)):
            for word in words:
                opened.append(crc)
                crc = crc32(word, crc)
                closed.append(crc)
                crc = crc32(b" ", crc)
            length.extend(map(len, words))
            number.extend([i] * len(words))
            if len(number) >= _BLOCK_WORDS:
                yield block()
                seen = min(longest - 1, len(number))
                for kept in (number, length, opened, closed):
                    del kept[:len(kept) - seen]
    yield block()


def _ngrams(words: _Words, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, CRC) of the runs of each length that end at a new word."""
    ends = np.cumsum(words.length + 1) - 1
    starts = ends - words.length
    for n in range(1, longest + 1):
        last = np.arange(max(words.seen, n - 1), len(words.text))
        first = last - (n - 1)
        whole = words.text[first] == words.text[last]
        first, last = first[whole], last[whole]
        yield words.text[last], words.closed[last] ^ shifted(words.opened[first], ends[last] - starts[first])


# --- Spark ---

def _count_batches(buckets: int, longest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for words in _scan((t.as_py() for t in batch.column("text")), longest):
            for _, crc in _ngrams(words, longest):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): features of all whole texts; each task sends one row a bucket at most."""
    ship(texts.sparkSession)
    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_count_batches, buckets, longest), "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    """At most one row for each of ``buckets``, a parameter."""
    out = np.zeros(buckets, np.int64)
    for row in counts.toLocalIterator():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket weighs, in thousandths of a natural logarithm, rounded down."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh_batches(buckets: int, longest: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gain = shared.value
    for batch in batches:
        n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for words in _scan((t.as_py() for t in batch.column("text")), longest):
            n_words += np.bincount(words.text[words.seen:], minlength=batch.num_rows)
            for text, crc in _ngrams(words, longest):
                n_features += np.bincount(text, minlength=batch.num_rows)
                np.add.at(weight, text, gain[crc % np.uint32(buckets)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight))], ["doc_id", "n_words", "n_features", "weight"])


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document, in thousandths, rounded down; a null id counts as empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST,
    percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for each row of ``docs``; drawn rows have a rank.

    ``docs`` needs doc_id and text, ``target`` text; other columns are not looked at, whatever their
    names. A null text has no words: no features, weight 0, never drawn. Texts of any length are
    scanned whole, a slice at a time. Repeated rows are documents of their own, with one score; ties
    go to the smaller doc_id, null ids last, equal rows in any order. An empty ``docs`` gives no rows,
    an empty ``target`` counts no feature.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(_dense(bucket_counts(rows, buckets, longest), buckets), _dense(bucket_counts(target, buckets, longest), buckets))
    weighed = rows.mapInArrow(
        partial(_weigh_batches, buckets, longest, spark.sparkContext.broadcast(gain)),
        "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = settle(weighed.select(
        "*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), F.monotonically_increasing_id().alias("row")))
    enough = F.col("n_words") >= min_words
    draws = scored.where(enough).count() * percent // 100
    # the candidates come first, so a row's place among all is its place among them
    placed = with_block_places(scored, [(~enough).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()])
    place = F.col("before") + F.col("place") + 1
    return placed.join(blocks_before(placed), "block").select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(enough & (place <= draws), place).alias("rank"))
