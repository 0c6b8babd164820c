"""Benchmark passages in documents, found by greedy string tiling.

Words are compared without the case of A to Z. Runs of five words that a document shares with a
benchmark item are the seeds; pairs of document and item whose seeds could cover enough of the item
are tiled: the longest common run of words not yet marked is marked on both sides, again and again,
down to runs of five; an item of fewer words is sought by runs of all its words. Runs are looked up by running Karp-Rabin hashes at a search length that falls
as the long ones are used up. Tiles may lie in any order, so a passage with its parts moved around
is found as well. An item is in a document if tiles cover the stated share of its words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.llm.shipping import ship
from regista.llm.words import mixed, pieces, run_hashes, same_text

MIN_MATCH = 5
COVERAGE = 0.8
#: benchmark text broadcast at once; a larger benchmark is searched block by block
BLOCK_BYTES = 32 << 20
_FIRST_LENGTH = 32
#: (text, item, place) rows compared at once, beyond a text that has more
_SEED_ROWS = 1 << 20
SCHEMA = "doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, tiles bigint, coverage double"


def tiles(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of greedy tiles; both are arrays of word hashes."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    found: list[tuple[int, int, int]] = []
    length = max(least, min(_FIRST_LENGTH, len(item)))
    while True:
        matches, longest = _matches(item, text, free_item, free_text, length)
        if longest > 2 * length:
            length = longest
            continue
        for size, a, b in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if not (free_item[a:a + size].all() and free_text[b:b + size].all()):
                break     # a tile has taken part of it; what is left comes up again in the order of its new size
            free_item[a:a + size] = False
            free_text[b:b + size] = False
            found.append((a, b, size))
        if matches:
            continue
        if length == least:
            return sorted(found)
        length = max(least, length // 2)


def _free_runs(free: np.ndarray, length: int) -> np.ndarray:
    if len(free) < length:
        return np.zeros(0, np.int64)
    taken = np.concatenate(([0], np.cumsum(~free)))
    return np.flatnonzero(taken[length:] == taken[:-length])


def _matches(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray,
             length: int) -> tuple[list[tuple[int, int, int]], int]:
    """Maximal unmarked matches of at least ``length`` words as (size, place, place), and the longest size."""
    a, b = _free_runs(free_item, length), _free_runs(free_text, length)
    if not len(a) or not len(b):
        return [], 0
    ha, hb = run_hashes(item, length)[a], run_hashes(text, length)[b]
    order = np.argsort(ha, kind="stable")
    ha, a = ha[order], a[order]
    low, high = np.searchsorted(ha, hb, "left"), np.searchsorted(ha, hb, "right")
    out, seen, longest = [], set(), 0
    for k in np.flatnonzero(high > low).tolist():
        t = int(b[k])
        for p in a[low[k]:high[k]].tolist():
            if (p - t, p) in seen:
                continue
            size = 0
            while (p + size < len(item) and t + size < len(text) and free_item[p + size] and free_text[t + size]
                   and item[p + size] == text[t + size]):
                size += 1
            if size < length:
                continue
            # later starts on the same diagonal are part of this match
            seen.update((p - t, p + i) for i in range(size))
            out.append((size, p, t))
            longest = max(longest, size)
    return out, longest


class Seeds:
    """Items that are sought by runs of ``length`` words, with these runs in order of hash."""

    def __init__(self, ids: list, items: list[np.ndarray], length: int):
        self.ids, self.items, self.length = ids, items, length
        hashes = [run_hashes(x, length) for x in items]
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]) if hashes else np.zeros(0, np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(h)) for h in hashes]])
        order = np.argsort(flat, kind="stable")
        self.hashes, self.item, self.place = flat[order], item[order], place[order]
        self.words = np.asarray([len(x) for x in items], np.int64)


def _tables(ids: list, texts: list[str | None]) -> list[Seeds]:
    """The items with words by the length of their seeds: five words, or all words of a shorter item."""
    items: list[np.ndarray] = []
    for w in pieces(pa.array([t or "" for t in texts], pa.large_string()), lower=True):
        items += np.split(w.hashes, np.searchsorted(w.text, np.arange(1, w.texts))) if w.texts else []
    found = []
    for length in range(1, MIN_MATCH + 1):
        chosen = [k for k, x in enumerate(items) if min(len(x), MIN_MATCH) == length]
        if chosen:
            found.append(Seeds([ids[k] for k in chosen], [items[k] for k in chosen], length))
    return found


_built: tuple[str, list[Seeds]] | None = None


def _block(name: str, shared) -> list[Seeds]:
    """The tables of a block; a process keeps those it used last."""
    global _built
    if _built is None or _built[0] != name:
        _built = None
        _built = (name, _tables(*shared.value))
    return _built[1]


def _candidates(seeds: Seeds, text: np.ndarray, runs: np.ndarray, coverage: float) -> Iterator[tuple[int, int]]:
    """(text, item) pairs whose seeds, were they all tiles, cover enough of the item."""
    low = np.searchsorted(seeds.hashes, runs, "left")
    hit = np.flatnonzero((low < len(seeds.hashes)) & (seeds.hashes[np.minimum(low, len(seeds.hashes) - 1)] == runs))
    if not len(hit):
        return
    pair = np.unique(np.stack((text[hit], low[hit]), axis=1), axis=0)      # each seed of a text once
    many = np.searchsorted(seeds.hashes, seeds.hashes[pair[:, 1]], "right") - pair[:, 1]
    total, ends = np.cumsum(many), np.append(np.flatnonzero(np.diff(pair[:, 0])) + 1, len(pair))
    start = 0
    while start < len(pair):
        ahead = ends[ends > start]
        fit = ahead[total[ahead - 1] - (total[start] - many[start]) <= _SEED_ROWS]
        stop = int(fit[-1] if len(fit) else ahead[0])
        yield from _enough(seeds, pair[start:stop], many[start:stop], coverage)
        start = stop


def _enough(seeds: Seeds, pair: np.ndarray, many: np.ndarray, coverage: float) -> Iterator[tuple[int, int]]:
    """:func:`_candidates` of whole texts, from (text, first place in the seeds) and how many seeds follow."""
    at = np.repeat(pair[:, 1], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    rows = np.stack((np.repeat(pair[:, 0], many), seeds.item[at], seeds.place[at]), axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
    reach = np.full(len(rows), seeds.length)
    reach[:-1] = np.where(first[1:], seeds.length, np.minimum(seeds.length, rows[1:, 2] - rows[:-1, 2]))
    heads = np.flatnonzero(first)
    covered = np.add.reduceat(reach, heads)
    for k in heads[covered >= coverage * seeds.words[rows[heads, 1]]].tolist():
        yield int(rows[k, 0]), int(rows[k, 1])


def _near(item: np.ndarray, text: np.ndarray, length: int = MIN_MATCH) -> np.ndarray:
    """``text`` cut down to the runs it shares with the item, with something unequal between them."""
    runs = run_hashes(text, length)
    hit = np.flatnonzero(np.isin(runs, run_hashes(item, length)))
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + length, -1)
    keep = np.cumsum(edge[:-1]) > 0
    breaks = np.flatnonzero(keep[1:] & ~keep[:-1]) + 1
    stand_in = mixed(~item[:1])
    return np.concatenate([np.concatenate((part[k], stand_in)) for part, k in
                           zip(np.split(text, breaks), np.split(keep, breaks))])


def _search(name: str, shared, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            rows = []
            for w in pieces(batch.column(1), lower=True):
                bounds = np.searchsorted(w.text, np.arange(w.texts + 1))
                for seeds in _block(name, shared):
                    length = seeds.length
                    inside = np.flatnonzero(same_text(w.text, length))
                    if not len(inside):
                        continue
                    for text, number in _candidates(seeds, w.text[inside], run_hashes(w.hashes, length)[inside], coverage):
                        item = seeds.items[number]
                        found = tiles(item, _near(item, w.hashes[bounds[text]:bounds[text + 1]], length), length)
                        covered = sum(size for _, _, size in found)
                        if covered >= coverage * len(item):
                            rows.append((ids[w.first + text].as_py(), seeds.ids[number], len(item), covered, len(found),
                                         covered / len(item)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.float64()])],
                ["doc_id", "item_id", "item_words", "covered_words", "tiles", "coverage"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, tiles, coverage): items found in documents.

    One row for each row of ``docs`` and item with at least ``coverage`` of the item's words under
    tiles; documents without any have no row. Null texts count as empty. An item of fewer than five
    words is found where all its words stand in a row; one without words is never found. Of equally
    long tiles that overlap, the one that starts first in the item, then in the text, is marked.
    Repeated rows on either side give repeated results; an empty table on either side gives none;
    other columns are not read. Texts of any length are searched whole. All documents are read once
    for each block of the benchmark.
    """
    ship(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = None
    for block in range(blocks):
        rows: pd.DataFrame = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toPandas()
        ids = [None if pd.isna(i) else int(i) for i in rows["item_id"]]
        shared = docs.sparkSession.sparkContext.broadcast((ids, rows["text"].tolist()))
        part = texts.mapInArrow(_search(uuid.uuid4().hex, shared, coverage), SCHEMA)
        found = part if found is None else found.unionAll(part)
    return found
