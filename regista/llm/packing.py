"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

Each document becomes token ids and an end id. A document longer than a sequence is cut: full
pieces fill a sequence each, and its remainder, the first piece, is packed like a short document.
Open sequences matter only through their residual gaps; a piece goes where the squared counts of
open sequences per gap become smallest, over all gaps it fits and a new sequence.

The texts are tokenised where they are read and never travel; pieces (a few numbers each) are dealt
by hash into groups of bounded size which are packed side by side.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.llm.shipping import ship
from regista.workspace import settle

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: pieces a task packs at once: enough that its last open sequences weigh little
GROUP_PIECES = 60_000


def _byte_characters() -> dict[str, int]:
    """The character by which a byte-level vocabulary spells each byte: itself if printable, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _merging(path: str):
    """The same vocabulary for the faster merging engine, or None where it would merge in another order.

    That engine merges the pair of the lowest id first, the file's merges are in an order of their own.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, split = content["model"], content.get("pre_tokenizer") or {}
    spelt = _byte_characters()
    merged = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    alike = (
        model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and not content.get("normalizer") and not model.get("ignore_merges")
        and None not in merged and all(a < b for a, b in zip(merged, merged[1:])) and all(set(t) <= spelt.keys() for t in model["vocab"]))
    if not alike:
        return None
    ranks = {bytes(spelt[c] for c in token): number for token, number in model["vocab"].items()}
    return tiktoken.Encoding("merging", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Encoder:
    """The ids that ``encode(text, add_special_tokens=False)`` of the tokenizer file gives.

    Texts are merged whole by the faster engine. A text with the string of a special token, or with a stretch of
    white space too long for that engine, goes to the tokenizer itself.
    """

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        path = name if os.path.sep in name else public_tokenizers.path(name)
        self.model = Tokenizer.from_file(str(path))
        self.merging = _merging(str(path))
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> np.ndarray:
        if self.merging and not any(s in text for s in self.special):
            try:
                return self.merging.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:                # its splitting gave up
                pass
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=1)
def _encoder(name: str) -> _Encoder:
    return _Encoder(name)


def _cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """A document's pieces: the remainder first if there is one, then full pieces."""
    head = total % capacity or min(total, capacity)
    ends = [0, *range(head, total, capacity), total]
    return list(zip(ends, ends[1:]))


def _piece_batches(name: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(name)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            found = []
            for row, text in enumerate(batch.column(1)):
                ids = np.concatenate((encode(text.as_py() or ""), end))
                found += [(row, number, s, e - s, zlib.crc32(ids[s:e]))
                          for number, (s, e) in enumerate(_cuts(len(ids), capacity))]
            rows, number, start, length, crc = np.asarray(found, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(number.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every text; null counts as empty (the end id only)."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _piece_batches(tokenizer, capacity),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed in the given order.

    With N(g) open bins of gap g, moving one from gap g to g - s changes the sum of squares by
    2 (N(g - s) - N(g)) + 2, a new bin by 2 N(capacity - s) + 1; a gap of zero is closed and counts
    nothing. The smallest change wins, the smallest gap among equals.
    """
    count = np.zeros(capacity + 1, np.int64)   # open bins by gap
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset, opened = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    never = np.int64(1) << 60
    for i, s in enumerate(lengths.tolist()):
        change = count[:capacity + 1 - s] - count[s:]      # N(g - s) - N(g) for g = s, s + 1, ...
        change = 2 * change + 2
        change[0] = -2 * count[s] + 1                      # fills the bin: gap zero is not counted
        change[count[s:] == 0] = never
        new = 2 * count[capacity - s] + 1 if s < capacity else 0
        best = int(np.argmin(change))
        if change[best] <= new and change[best] != never:
            gap = best + s
            at = bins[gap].pop()
            count[gap] -= 1
        else:
            gap, at, opened = capacity, opened, opened + 1
        where[i], offset[i] = at, capacity - gap
        left = gap - s
        if left:
            count[left] += 1
            bins[left].append(at)
    return where, offset


def _fewest(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The best of three orders: as dealt, the short pieces last, and longest first.

    Many pieces pack best as they come; the last open sequences of few pieces fill better when
    short pieces are left for the end.
    """
    longest = np.argsort(-lengths, kind="stable")
    short = lengths <= capacity // 8
    best = None
    for order in (np.arange(len(lengths)), np.concatenate((np.flatnonzero(~short), longest[short[longest]])), longest):
        at, offset = sum_of_squares(lengths[order], capacity)
        used = int(at.max()) + 1
        if best is None or used < best[0]:
            back = np.argsort(order, kind="stable")
            best = used, at[back], offset[back]
    return best[1], best[2]


def pack(found: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``found`` (written pieces) with ``sequence_id`` and ``offset``.

    Pieces of full length have a sequence each. The others are dealt evenly into groups of about
    ``group_pieces``, whatever rows repeat, and each group is packed by itself.
    """
    tagged = found.withColumn("__row", F.monotonically_increasing_id())
    full = tagged.where(F.col("length") == capacity).select(
        *found.columns, (2 * F.col("__row") + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    groups = max(1, -(-found.where(F.col("length") < capacity).count() // group_pieces))
    short = tagged.where(F.col("length") < capacity).withColumn(
        "sequence_id", F.pmod(F.xxhash64("__row"), F.lit(groups)).cast("bigint")).drop("__row")

    def group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ids_crc32", "doc_id", "piece"], kind="stable", ignore_index=True)
        at, offset = _fewest(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=2 * ((key[0] << 32) + at), offset=offset)

    packed = short.groupBy("sequence_id").applyInPandas(group, f"{_schema(short)}, offset bigint")
    return packed.select(full.columns).unionAll(full)


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of ``docs``.

    Null text counts as empty and gives one piece, the end id. Texts of any length are encoded whole, one at a
    time. Repeated rows are packed as often as they come, null doc_ids stay null, an empty table gives no
    pieces; other columns are not looked at. Among gaps that change the sum alike the smallest is filled; pieces of equal ids may
    change places. Sequence numbers are unique but not dense; offsets run from 0 without gaps.
    """
    ship(docs.sparkSession)
    return pack(settle(pieces(docs, capacity, tokenizer)), capacity)
