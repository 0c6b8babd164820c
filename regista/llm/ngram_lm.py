"""Interpolated modified Kneser-Ney bigrams over a whole corpus, as memory-mapped hash arrays.

Counting is done in Spark: tasks count the pairs of words in their texts, the pairs are dealt by
hash into shards, and every shard is written as arrays in order of hash (pairs and their counts). A
second, smaller exchange adds up what concerns single words: how often a word occurs, after how many
different words, and how many words follow it once, twice and more often. Scoring tasks memory-map
the arrays they need from the shared folder and look up their pairs and words by binary search, so
neither the driver nor a worker's memory ever holds the model. It grows with the corpus, in shards.

Frequent words are spread: a pair's shard depends on both words, so what follows one word is in
several shards. Counts of a word from all shards add up.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regista.llm.kneser_ney import discounted, discounts
from regista.llm.shipping import ship
from regista.llm.words import Words, mixed, pieces
from regista.workspace import run_folder

FOLDS = 7
HELD_OUT = 2
_START, _END = np.uint64(1), np.uint64(2)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_SPREAD = 4            # shards over which the followers of one word are spread
_TOKENS = 1_500_000    # tokens counted or looked up at once
_U = np.uint64


def held_out(doc_id: Column) -> Column:
    """Rows nothing is learned from; a null doc_id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _tokens(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, token, text) of a piece: its words and one end for each text, the empty ones too."""
    place = np.arange(len(w.hashes)) + w.text
    count = np.bincount(w.text, minlength=w.texts) + 1
    token = np.full(len(w.hashes) + w.texts, _END)
    token[place] = w.hashes
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[np.cumsum(count) - count] = _START
    return before, token, np.repeat(np.arange(w.texts), count)


def _gathered(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, before, token, text) of runs of texts with about :data:`_TOKENS` tokens."""
    first, held, size = 0, [], 0
    for w in pieces(column, lower=True):
        before, token, text = _tokens(w)
        held.append((before, token, text + (w.first - first)))
        size += len(token)
        if size >= _TOKENS:
            yield first, w.first + w.texts - first, *(np.concatenate(x) for x in zip(*held))
            first, held, size = w.first + w.texts, [], 0
    if held:
        yield first, len(column) - first, *(np.concatenate(x) for x in zip(*held))


def _pair_shard(before: np.ndarray, token: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(before) + mixed(token ^ _PAIR) % _U(_SPREAD)) % _U(shards)).astype(np.int64)


def _word_shard(word: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(word) % _U(shards)).astype(np.int64)


def _written(*arrays: np.ndarray) -> bytes:
    return b"".join([np.asarray([len(a) for a in arrays], "<i8").tobytes(), *[a.tobytes() for a in arrays]])


def _read(buffer, kinds: tuple[str, ...], at: int = 0) -> tuple[list[np.ndarray], int]:
    sizes = np.frombuffer(buffer, "<i8", len(kinds), at)
    at += 8 * len(kinds)
    out = []
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(buffer, kind, int(size), at))
        at += out[-1].nbytes
    return out, at


def _split(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, rows) for each shard that has any; rows stay in order."""
    by = np.argsort(target, kind="stable")
    if len(by):
        cuts = np.flatnonzero(np.concatenate(([True], target[by][1:] != target[by][:-1])))
        for part in np.split(by, cuts[1:]):
            yield int(target[part[0]]), part


_COUNTED = ("<u8", "<u4", "<u8", "<u4")     # histories, how many pairs each has, words, counts


def _count_batches(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, before, token, _ in _gathered(batch.column(0)):
                _, index, counts = np.unique(mixed(before * _PAIR + token), return_index=True, return_counts=True)
                v, w = before[index], token[index]
                order = np.argsort(v, kind="stable")
                v, w, counts = v[order], w[order], counts[order].astype("<u4")
                shard, data = [], []
                for number, rows in _split(_pair_shard(v, w, shards)):
                    own = v[rows]
                    heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                    shard.append(number)
                    data.append(_written(own[heads], np.diff(np.append(heads, len(own))).astype("<u4"), w[rows], counts[rows]))
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(data, pa.binary())], ["shard", "data"])

    return run


_PARTIAL = ("<u8", "<u8", "<u4", "<u4", "<u4", "<u8", "<u8")   # histories with four figures; words with their histories


def _merge_pairs(word_shards: int):
    def run(table: pa.Table) -> pa.Table:
        """One shard: its sorted arrays, and what it knows of single words for each shard of words."""
        parts = [_read(x.as_buffer(), _COUNTED)[0] for x in table.column("data")]
        v = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        w = np.concatenate([p[2] for p in parts])
        counts = np.concatenate([p[3] for p in parts])
        keys = mixed(v * _PAIR + w)
        order = np.argsort(keys, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
        total = np.add.reduceat(counts[order].astype("<u8"), heads)
        keys, v, w = keys[order][heads], v[order][heads], w[order][heads]
        large = np.flatnonzero(total >= 255)
        out = [("pairs", table.column("shard")[0].as_py(), _written(
            keys, np.minimum(total, 255).astype("<u1"), keys[large], total[large]))]
        histories, own = np.unique(v, return_inverse=True)
        figures = [np.bincount(own, weights=total, minlength=len(histories)).astype("<u8")]
        figures += [np.bincount(own, weights=x, minlength=len(histories)).astype("<u4")
                    for x in (total == 1, total == 2, total >= 3)]
        words, after = np.unique(w, return_counts=True)
        parts_v, parts_w = dict(_split(_word_shard(histories, word_shards))), dict(_split(_word_shard(words, word_shards)))
        none = np.zeros(0, np.int64)
        for number in sorted({*parts_v, *parts_w}):
            a, b = parts_v.get(number, none), parts_w.get(number, none)
            raw = zstandard.ZstdCompressor(level=1).compress(_written(
                histories[a], *[f[a] for f in figures], words[b], after[b].astype("<u8")))
            out.append(("partial", number, np.asarray([len(raw)], "<i8").tobytes() + raw))
        tally = np.bincount(np.minimum(total, 5).astype(np.int64), minlength=6)[1:5]
        out.append(("tally", 0, tally.astype("<i8").tobytes()))
        return _rows(out)

    return run


def _rows(out: list[tuple[str, int, bytes]]) -> pa.Table:
    kind, shard, data = zip(*out)
    return pa.table({"kind": pa.array(kind), "shard": pa.array(shard, pa.int32()), "data": pa.array(data, pa.binary())})


_ROWS = "kind string, shard int, data binary"
_VOCABULARY = ("<u8", "<u8", "<u8", "<u4", "<u4", "<u4")       # word, count, histories, followers seen once, twice, more


def _merge_words(table: pa.Table) -> pa.Table:
    """One shard of words: sorted arrays, and its part of the corpus figures."""
    columns: list[list[np.ndarray]] = [[] for _ in _PARTIAL]
    for content in table.column("content"):
        data, at = content.as_py(), 0
        while at + 8 <= len(data):
            size = int(np.frombuffer(data, "<i8", 1, at)[0])
            raw = zstandard.ZstdDecompressor().decompress(data[at + 8:at + 8 + size])
            for column, array in zip(columns, _read(raw, _PARTIAL)[0]):
                column.append(array)
            at += 8 + size + 1          # the writer ends each value with a line end
    history, *figures, word, after = (np.concatenate(c) for c in columns)
    keys, own = np.unique(np.concatenate((history, word)), return_inverse=True)
    of_history, of_word = own[:len(history)], own[len(history):]
    size = len(keys)
    count, one, two, more = (np.bincount(of_history, weights=f, minlength=size) for f in figures)
    before = np.bincount(of_word, weights=after, minlength=size)
    # ends are no history and starts no word: an end occurs as often as a start
    known = (count > 0) & (keys != _START)
    tally = np.bincount(np.minimum(before, 5).astype(np.int64), minlength=6)[1:5]
    figures = np.asarray([count.sum(), known.sum(), count[keys == _START].sum(), before.sum(), *tally])
    out = [("words", table.column("shard")[0].as_py(), _written(
        keys, count.astype("<u8"), before.astype("<u8"), one.astype("<u4"), two.astype("<u4"), more.astype("<u4"))),
        ("figures", 0, figures.astype("<i8").tobytes())]
    return _rows(out)


def _write(rows: DataFrame, folder: str) -> None:
    """Each value as raw bytes in a file (with a line end after it) of its kind and shard."""
    rows.select("kind", "shard", F.col("data").cast("string")).write.partitionBy("kind", "shard").text(folder)


class Model(NamedTuple):
    """Where the arrays are, and the figures of the whole corpus."""

    pairs: dict[int, str]
    words: dict[int, str]
    shards: int
    word_shards: int
    tokens: int
    types: int
    texts: int
    histories: int                # different pairs
    pair_discounts: list[float]
    word_discounts: list[float]
    freed: float                  # what the discounts of words leave for all words alike


def _files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where(F.col("kind") == kind)


def _paths(spark: SparkSession, folder: str, kind: str) -> dict[int, str]:
    return {r["shard"]: r["path"] for r in _files(spark, folder, kind).select("shard", "path").collect()}


def _sums(spark: SparkSession, folder: str, kind: str, size: int) -> np.ndarray:
    """Adds up the figures of all shards: a few numbers of each reach the driver."""
    total = np.zeros(size, np.int64)
    for row in _files(spark, folder, kind).select("content").collect():
        data = bytes(row["content"])
        for at in range(0, len(data) - 8 * size + 1, 8 * size + 1):
            total += np.frombuffer(data, "<i8", size, at)
    return total


def train(texts: DataFrame) -> Model:
    """Counts the column ``text`` of ``texts`` and writes the model to the shared folder."""
    spark = texts.sparkSession
    ship(spark)
    folder = run_folder(spark, "ngrams")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    word_shards = shards // 4 + 1
    counted = texts.select("text").mapInArrow(_count_batches(shards), "shard int, data binary")
    _write(counted.groupBy("shard").applyInArrow(_merge_pairs(word_shards), _ROWS), f"{folder}/counts")
    if not _any(spark, f"{folder}/counts"):
        return Model({}, {}, shards, word_shards, 0, 0, 0, 0, [0.0] * 4, [0.0] * 4, 1.0)
    partial = _files(spark, f"{folder}/counts", "partial").select("shard", "content")
    _write(partial.groupBy("shard").applyInArrow(_merge_words, _ROWS), f"{folder}/words")
    tokens, types, starts, histories, *tally = _sums(spark, f"{folder}/words", "figures", 8).tolist()
    word_discounts = discounts(np.asarray(tally))
    pair_discounts = discounts(_sums(spark, f"{folder}/counts", "tally", 4))
    # the discounts of words: each word with one, two, and three or more histories gives up its own
    types += 1
    seen_more = types - tally[0] - tally[1]
    freed = (word_discounts[1] * tally[0] + word_discounts[2] * tally[1] + word_discounts[3] * seen_more) / histories
    return Model(_paths(spark, f"{folder}/counts", "pairs"), _paths(spark, f"{folder}/words", "words"), shards, word_shards,
                 tokens, types, starts, histories, pair_discounts.tolist(), word_discounts.tolist(), float(freed))


def _any(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/kind=pairs")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


@lru_cache(maxsize=512)
def _mapped(uri: str, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of a file, memory-mapped; a file the worker cannot open is spooled to its disk first."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        buffer = np.memmap(unquote(parts.path), np.uint8, "r")
    else:
        import pyarrow.fs

        system, path = pyarrow.fs.FileSystem.from_uri(uri)
        with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as source:
            while block := source.read(1 << 22):
                copy.write(block)
            copy.flush()
            buffer = np.memmap(copy, np.uint8, "r")      # keeps the file open after its name is gone
    return _read(buffer, kinds)[0]


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``keys``, which of ``wanted`` are there)."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _pair_counts(model: Model, before: np.ndarray, token: np.ndarray) -> np.ndarray:
    keys = mixed(before * _PAIR + token)
    counts = np.zeros(len(keys), np.int64)
    for shard, rows in _split(_pair_shard(before, token, model.shards)):
        if shard not in model.pairs:
            continue
        table, small, large, totals = _mapped(model.pairs[shard], ("<u8", "<u1", "<u8", "<u8"))
        at, here = _found(table, keys[rows])
        own = np.where(here, small[at], 0).astype(np.int64)
        full = np.flatnonzero(own == 255)
        if len(full):
            own[full] = totals[np.searchsorted(large, keys[rows][full])]
        counts[rows] = own
    return counts


def _word_figures(model: Model, words: np.ndarray) -> np.ndarray:
    """(5, words): count, histories, followers seen once, twice and more often."""
    out = np.zeros((5, len(words)), np.int64)
    for shard, rows in _split(_word_shard(words, model.word_shards)):
        if shard in model.words:
            table, *figures = _mapped(model.words[shard], _VOCABULARY)
            at, here = _found(table, words[rows])
            for row, figure in zip(out, figures):
                row[rows] = np.where(here, figure[at], 0)
    return out


def _score(model: Model, before: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log10 probability, base log10 probability, whether known) of each token after the one before it."""
    _, index, inverse = np.unique(mixed(before * _PAIR + token), return_index=True, return_inverse=True)
    v, w = before[index], token[index]
    words, place = np.unique(np.concatenate((v, w)), return_inverse=True)
    figures = _word_figures(model, words)
    of_v, of_w = figures[:, place[:len(v)]], figures[:, place[len(v):]]
    count = np.where(w == _END, model.texts, of_w[0])
    single = model.freed / (model.types + 1) + np.zeros(len(w))
    if model.histories:
        single += discounted(of_w[1], np.asarray(model.word_discounts)) / model.histories
    d = np.asarray(model.pair_discounts)
    total = np.maximum(of_v[0], 1)
    backoff = np.where(of_v[0] > 0, (d[1] * of_v[2] + d[2] * of_v[3] + d[3] * of_v[4]) / total, 1.0)
    p = discounted(_pair_counts(model, v, w), d) / total + backoff * single
    base = np.log10((count + 1) / (model.tokens + model.types + 1))
    return np.log10(p)[inverse], base[inverse], (count > 0)[inverse]


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            tokens, known, base, score = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
            for first, texts, before, token, text in _gathered(batch.column(1)):
                log_p, log_base, seen = _score(model, before, token)
                rows = slice(first, first + texts)
                tokens[rows] = np.bincount(text, minlength=texts)
                known[rows] = np.bincount(text, weights=seen, minlength=texts)
                base[rows] = np.bincount(text, weights=log_base, minlength=texts)
                score[rows] = np.bincount(text, weights=log_p, minlength=texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens), pa.array(known), pa.array(np.full(size, model.tokens)), pa.array(base),
                 pa.array(score)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Learns from the rows that are not held out and scores all. Null texts count as empty and are one
    token, their end. Scores are log10 probabilities of whole texts; perplexity is
    ``10 ** (-score / n_tokens)``. Without rows to learn from every token has probability one. Null
    doc_ids are learned from. Repeated rows are learned from and scored as often as they come; an
    empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = train(texts.where(~held_out(F.col("doc_id"))))
    return texts.mapInArrow(
        _score_batches(model),
        "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
