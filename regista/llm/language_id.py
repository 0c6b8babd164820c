"""Language of a text: multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased and every stretch without letters becomes one space. Runs of 1 to 4 characters of
a word, the spaces around it included, are hashed into a fixed number of buckets. How many training texts hold a
bucket is counted over all of them in Spark. The regression is fitted on a sample of bounded size
by follow-the-regularised-leader with an elastic net: the L1 part keeps weights of uninformative buckets
at exactly zero, the L2 part bounds the others. A part of the sample is kept apart, and on it one temperature
is chosen that makes the probabilities as sure as they are right. All texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regista.llm.shipping import ship
from regista.workspace import settle

BUCKETS = 1 << 17
#: weights of a model; with more languages than these allow, buckets become fewer
WEIGHTS = 1 << 23
#: longest run of characters that is a feature
LONGEST = 4
#: labelled rows the regression is fitted on, over all languages: of each those whose ids hash lowest
SAMPLE_ROWS = 2000
#: and of each language at most
LANGUAGE_ROWS = 500
#: no single text over so many bytes is learned from; it is counted and scored whole
LONGEST_SAMPLED = 32 << 10
#: of the sample's rows one in so many is for the temperature
APART = 5
#: hashes ranked for each row wanted, about
_MARGIN = 8
FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"
#: step sizes and penalties of the regression
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.002, 0.001
#: it goes over its rows until it has seen so many, and EPOCHS times at least
EPOCHS, LEAST_STEPS = 3, 10_000
#: characters whose n-grams are taken together
_BLOCK_CHARS = 1 << 18
_SPACE = np.uint32(32)


def held_out(doc_id: Column) -> Column:
    """Rows nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


# --- features ---

@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters or marks that belong to letters."""
    import regex

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    out = np.zeros(0x110000, bool)
    out[np.frombuffer("".join(regex.findall(r"[\p{L}\p{M}]+", every)).encode("utf-32-le"), np.uint32)] = True
    return out


def _plain(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after another, each text between spaces, and which text each is of."""
    texts = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letter = _letters()[points]
    # of a stretch without letters the first character of each text stays, as a space
    kept = letter.copy()
    kept[1:] |= letter[:-1] | (text[1:] != text[:-1])
    kept[:1] = True
    points = np.where(letter, points, _SPACE)
    return points[kept], text[kept]


def _ngrams(points: np.ndarray, text: np.ndarray, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all runs of 1 to ``longest`` characters of a word and the spaces around it."""
    hashes = np.zeros(len(points), np.uint64)
    space = points == _SPACE
    spaces = np.cumsum(space)
    for n in range(1, longest + 1):
        if len(points) < n:
            return
        # a multiplicative hash of the run that ends at each place
        hashes = (hashes[:len(points) - n + 1] + points[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
        first, last = text[:len(text) - n + 1], text[n - 1:]
        inside = ~space if n == 1 else (first == last) & (spaces[max(0, n - 2):len(spaces) - 1] == spaces[:len(spaces) - n + 1])
        yield last[inside], (hashes[inside] >> np.uint64(20)) % np.uint64(buckets)


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch, some at a time: (number of the first, texts)."""
    first, taken, size = 0, [], 0
    for i, text in enumerate(column):
        text = text.as_py() or ""
        if taken and size + len(text) > _BLOCK_CHARS:
            yield first, taken
            first, taken, size = i, [], 0
        taken.append(text)
        size += len(text)
    if taken:
        yield first, taken


def _parts(text: str) -> Iterator[str]:
    """A text in slices that end between words, unless a word is longer than a slice."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _BLOCK_CHARS)
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def _features(texts: list[str], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all occurrences, in bounded arrays; a very long text is walked slice by slice."""
    if len(texts) == 1 and len(texts[0]) > _BLOCK_CHARS:
        for part in _parts(texts[0]):
            yield from _ngrams(*_plain([part]), longest, buckets)
    else:
        yield from _ngrams(*_plain(texts), longest, buckets)


def _distinct(texts: list[str], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket, times), each pair once."""
    keys = np.zeros(0, np.int64)
    times = np.zeros(0, np.int64)
    for text, bucket in _features(texts, longest, buckets):
        own = np.sort(text * buckets + bucket.astype(np.int64))
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(own)))
        keys, place = np.unique(np.concatenate((keys, own[first])), return_inverse=True)
        times = np.bincount(place, np.concatenate((times, count)), len(keys)).astype(np.int64)
    yield keys // buckets, keys % buckets, times


def _holding_batches(longest: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts hold each bucket; bucket -1 counts the texts."""
    total, texts = np.zeros(buckets, np.int64), 0
    for batch in batches:
        texts += batch.num_rows
        for _, block in _blocks(batch.column("text")):
            for _, bucket, _ in _distinct(block, longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(held, -1)), pa.array(np.append(total[held], texts))], ["bucket", "n"])


def inverse_frequencies(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the bucket)) + 1; a task sends one row a bucket at most."""
    ship(texts.sparkSession)
    counted = texts.select("text").mapInArrow(partial(_holding_batches, longest, buckets), "bucket bigint, n bigint")
    holding, total = np.zeros(buckets), 0
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        if row["bucket"] < 0:
            total = row["n"]
        else:
            holding[row["bucket"]] = row["n"]
    return np.log((1.0 + total) / (1.0 + holding)) + 1.0


# --- regression ---

class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray      # (buckets, languages), float32: inverse frequencies are multiplied in
    bias: np.ndarray
    temperature: float


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n_classes: int, width: int,
    alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights (width, classes) of a multinomial regression on sparse rows (places, values).

    A coordinate's step shrinks with the gradients it has seen. Its weight is the least point of all
    linearised losses so far plus l1 |w| + l2 w^2 / 2; below l1 it is zero.
    """
    z, n = np.zeros((width, n_classes)), np.zeros((width, n_classes))

    def solved(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(0)
    for _ in range(max(epochs, -(-LEAST_STEPS // max(1, len(rows))))):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[at], n[at]
            w = solved(zi, ni)
            p = _softmax(x @ w)
            p[classes[i]] -= 1.0
            g = x[:, None] * p[None, :]
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[at] = grown
    return solved(z, n)


def best_temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over 1/4 to 32."""
    def loss(log_t):
        p = _softmax(logits / np.exp(log_t))[np.arange(len(classes)), classes]
        return -np.log(np.maximum(p, 1e-300)).mean()

    low, high, part = np.log(1 / 4), np.log(32), (5 ** 0.5 - 1) / 2
    if not len(classes):
        return 1.0
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def _row(text: str, idf: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of one text; the last place is the constant one."""
    (_, bucket, times), = _distinct([text], longest, len(idf))
    values = np.append(times / max(1, times.sum()) * idf[bucket], 1.0)
    return np.append(bucket, len(idf)).astype(np.int32), values.astype(np.float32)


def _sample(labelled: DataFrame, rows: int, per_language: int, longest_bytes: int) -> DataFrame:
    """Labelled rows, ``rows`` at most; each language gets an even share. Equal texts of a language count once."""
    order = F.xxhash64("text", F.lit("sample"))
    able = labelled.where(F.octet_length("text") <= longest_bytes)
    digests = able.select("lang", order.alias("h")).distinct()
    held = settle(digests.groupBy("lang").agg(F.count("*").alias("n")))
    share = max(1, min(per_language, rows // max(1, held.count())))
    # of each language the lowest hashes, some times as many as wanted, are all that is ranked
    part = F.shiftright("h", 1).cast("double") / 2.0 ** 62
    few = digests.join(held, "lang").where(part < -1 + 2.0 * _MARGIN * share / F.col("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = settle(few.withColumn("place", first).where(F.col("place") <= share).orderBy("place", "lang").limit(rows).select("lang", "h"))
    # at most ``rows`` rows are broadcast
    return able.withColumn("h", order).join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, longest: int = LONGEST, buckets: int = BUCKETS) -> Model:
    """A model of the languages of ``docs`` (doc_id, text, lang), from rows that are not held out.

    Frequencies are those of all training rows. The regression sees at most ``rows`` texts.
    """
    ship(docs.sparkSession)
    learned = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    able = learned.where(F.col("text").rlike(r"\p{L}"))
    sample = sorted((r["lang"], r["h"], r["text"]) for r in settle(_sample(able, rows, LANGUAGE_ROWS, LONGEST_SAMPLED)).toLocalIterator())
    languages = sorted({lang for lang, _, _ in sample})
    if not languages:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0)
    buckets = min(buckets, 1 << (WEIGHTS // len(languages)).bit_length() - 1)
    idf = inverse_frequencies(learned, longest, buckets)
    x = [_row(text, idf, longest) for _, _, text in sample]
    y = np.searchsorted(languages, [lang for lang, _, _ in sample])
    apart = np.array([i % APART == 0 for i in range(len(sample))]) & (len(sample) > 4 * APART * len(languages))
    fit = np.flatnonzero(~apart)
    weights = follow_the_leader([x[i] for i in fit], y[fit], len(languages), buckets + 1)
    kept = np.flatnonzero(apart)
    logits = np.array([x[i][1] @ weights[x[i][0]] for i in kept]).reshape(len(kept), len(languages))
    return Model(languages, (weights[:-1] * idf[:, None]).astype(np.float32), weights[-1], best_temperature(logits, y[kept]))


def _predict_batches(longest: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    languages, weights, bias, temperature = shared.value
    names = np.array([*languages, UNKNOWN], object)
    for batch in batches:
        best, score = np.full(batch.num_rows, len(languages)), np.zeros(batch.num_rows)
        for first, texts in _blocks(batch.column("text")) if languages else ():
            sums, found = np.zeros((len(texts), len(languages))), np.zeros(len(texts), np.int64)
            for text, bucket in _features(texts, longest, len(weights)):
                found += np.bincount(text, minlength=len(texts))
                for k in range(len(languages)):
                    sums[:, k] += np.bincount(text, weights[:, k][bucket], len(texts))
            p = _softmax((sums / np.maximum(found, 1)[:, None] + bias) / temperature)
            best[first:first + len(texts)] = p.argmax(axis=1)
            score[first:first + len(texts)] = p.max(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lettered"), pa.array(names[best], pa.string()), pa.array(score)],
            ["doc_id", "lettered", "lang", "score"])


def identify(docs: DataFrame, rows: int = SAMPLE_ROWS, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``; only its text is looked at.

    ``docs`` needs doc_id, text and lang; other columns are not looked at, whatever their names. A text
    that is null or has no letter is ``und`` with score 0, and so is every text where no row can be learned
    from. Rows with a null doc_id are learned from, those with a null lang are not. Of equal probabilities the first language by name wins.
    Repeated rows give repeated results and are learned from once; an empty table gives no rows. Texts of any length are
    read whole, a slice of 2^18 characters at a time; only within a longer word n-grams across two slices do not count.
    """
    spark = docs.sparkSession
    model = train(docs, rows, longest, buckets)
    text = F.col("text").cast("string")
    shared = spark.sparkContext.broadcast((model.languages, np.asfortranarray(model.weights), model.bias, model.temperature))
    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    ).mapInArrow(partial(_predict_batches, longest, shared), "doc_id bigint, lettered boolean, lang string, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("lettered"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"))
