"""Toxicity by two class-conditional Kneser-Ney models over one shared backoff.

A bigram model of toxic and one of ordinary texts are counted from labelled rows.
Both back off to the pairs and words of either class together, weighed by how much likelier their own
class makes the word. What counts in the models is the number of different contexts. A text is scored
by the difference of its length-normalised log-likelihoods, and by its most toxic stretch. There a
likelihood ratio alone would say as much of a word seen once as of one seen often, so a stretch is
weighed by how many texts of either class hold its words and pairs, drawn to the shares of the classes
where these are few; no expression is left out, and later words of a fixed phrase count like others.
Of near copies in a class one is learned from. A logistic curve fitted on labelled rows apart weighs
the two, and the rising share of toxic texts among these rows turns the weighted sum into a score.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.llm.kneser_ney import count_of_counts, discounted, discounts
from regista.llm.shipping import ship
from regista.llm.words import mixed, pieces, run_hashes, same_text
from regista.workspace import settle

#: labelled rows a model is fitted on, for each class: those whose ids hash lowest
SAMPLE_ROWS = 2000
#: and the most text of them, so that the model has a bounded size
SAMPLE_BYTES = 16 << 20
#: no text over this part of these bytes (512 KB) is learned from, so that none fills its class; it is scored whole
LONGEST_PART = 32
#: what the whole text's difference weighs at least, as a part of the weight of its best stretch
LEAST_WEIGHT = 0.1
#: texts of either class, in their shares, that are added to those with an expression
PRIOR_TEXTS = 10
#: texts of a class are near copies if they share half of so many smallest hashes of three words
_SKETCH = 16
_SKETCH_WORDS = 3
#: words of the stretches compared beside the whole text
STRETCH = 1
FOLDS = 5
HELD_OUT = 0
_START = np.uint64(1)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


class Model(NamedTuple):
    words: np.ndarray        # sorted hashes
    word_prob: np.ndarray    # (3, words + 1): ordinary, toxic, shared; the last is for unknown words
    backoff: np.ndarray      # (3, words + 1): weight of what the bigram backs off to, 1 after unknown words
    pairs: np.ndarray        # sorted hashes of two words
    pair_prob: np.ndarray    # (3, pairs + 1): what the bigram itself adds
    word_sure: np.ndarray    # (words + 1): log ratio of toxic and ordinary texts with the word, drawn to their shares
    pair_sure: np.ndarray    # (pairs + 1)
    curve: np.ndarray        # weights of (whole text, best stretch, 1)
    steps: np.ndarray        # (2, steps): a weighted sum, and the share of toxic texts at it
    constant: float | None   # the score of every text if a class has no rows


def _look(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table; its length where absent."""
    at = np.searchsorted(table, keys)
    if not len(table):
        return at
    return np.where(table[np.minimum(at, len(table) - 1)] == keys, at, len(table))


def _histories(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.concatenate(([True], text[1:] != text[:-1]))] = _START
    return before


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _PAIR + second)


def _first_in_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """1 where a key stands for the first time in its text, else 0."""
    order = np.lexsort((keys, text))      # stable: the first comes first
    k, t = keys[order], text[order]
    out = np.zeros(len(keys), np.int32)
    out[order[np.concatenate(([True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])))]] = 1
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for w in pieces(batch.column(0), lower=True):
            if len(w.hashes):
                before = _histories(w.hashes, w.text)
                two_before = _histories(before, w.text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(two_before.view(np.int64)), pa.array(before.view(np.int64)), pa.array(w.hashes.view(np.int64)),
                     pa.array(toxic[w.first + w.text].astype(np.int32)),
                     pa.array(_first_in_text(pair_hashes(before, w.hashes), w.text)), pa.array(_first_in_text(w.hashes, w.text))],
                    ["u", "v", "w", "toxic", "pair", "word"])


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [b""] * batch.num_rows
        for w in pieces(batch.column(1), lower=True):
            inside = np.flatnonzero(same_text(w.text, _SKETCH_WORDS))
            runs, text = run_hashes(w.hashes, _SKETCH_WORDS)[inside], w.text[inside]
            cuts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(text) else []
            for t, part in zip(text[cuts], np.split(runs, cuts[1:]) if len(text) else []):
                out[w.first + t] = np.unique(part)[:_SKETCH].tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "sketch"])


def _near_copies(sample: DataFrame) -> list[int]:
    """The doc_ids of a sample that are near copies of another of their class; of each group one is not."""
    copies: list[int] = []
    for toxic in (0, 1):
        found = sample.where(F.col("toxic") == toxic).select("doc_id", "text").mapInArrow(
            _sketch_batches, "doc_id bigint, sketch binary").toArrow().sort_by("doc_id").to_pylist()
        holders: dict[int, list[int]] = defaultdict(list)
        for row in found:
            sketch = np.frombuffer(row["sketch"], "<u8").tolist()
            shared = Counter(doc for h in sketch for doc in holders[h])
            if shared and 2 * max(shared.values()) >= len(sketch):
                copies.append(row["doc_id"])
            else:
                for h in sketch:
                    holders[h].append(row["doc_id"])
    return copies


def _fit(first: np.ndarray, second: np.ndarray, counts: np.ndarray, pair_texts: np.ndarray, word_texts: np.ndarray) -> Model:
    """``counts`` is (2, pairs): after how many words each pair stands in ordinary and toxic texts.
    ``pair_texts``: how many texts hold it, ``word_texts``: in how many its second word first stands in it."""
    words, own = np.unique(second, return_inverse=True)
    contexts = np.bincount(own)                                  # distinct words before it, in both classes
    left = discounted(contexts, discounts(count_of_counts(contexts)))
    shared = np.append(left, 0.0) / contexts.sum() + (1 - left.sum() / contexts.sum()) / (len(words) + 1)
    order = np.argsort(pair_hashes(first, second))
    history = _look(words, first)
    word_prob, backoff, pair_prob = [], [], []
    for c in (*counts, counts.sum(axis=0)):
        if len(word_prob) < 2:
            single = np.bincount(own, weights=c > 0, minlength=len(words))
            left = discounted(single, discounts(count_of_counts(single)))
            many = max(1.0, single.sum())
            word_prob.append(np.append(left, 0.0) / many + (1 - left.sum() / many) * shared)
        else:
            word_prob.append(shared)
        left = discounted(c, discounts(count_of_counts(c)))
        # the start of a text is no word: it has the last place, like histories never seen, and backs off whole
        total = np.bincount(history, weights=c, minlength=len(words) + 1)
        seen = np.bincount(history, weights=left, minlength=len(words) + 1)
        total[-1], seen[-1] = 0.0, 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff.append(np.where(total > 0, (total - seen) / total, 1.0))
            pair_prob.append(np.append(np.where(total[history] > 0, left / total[history], 0.0)[order], 0.0))
    sure = _sure(np.stack([np.bincount(own, weights=t, minlength=len(words)) for t in word_texts]))
    return Model(words, np.asarray(word_prob), np.asarray(backoff), pair_hashes(first, second)[order],
                 np.asarray(pair_prob, np.float32), sure, _sure(pair_texts)[np.append(order, -1)].astype(np.float32),
                 np.zeros(3), np.zeros((2, 1)), None)


def _sure(texts: np.ndarray) -> np.ndarray:
    """Log ratio of toxic and ordinary ``texts`` (2, expressions), against all of them; 0 at the end for unknown ones."""
    share = (texts.sum(axis=1) + 1) / (texts.sum() + 2)
    ordinary, toxic = (np.log(t / s + PRIOR_TEXTS) for t, s in zip(texts, share))
    return np.append(toxic - ordinary, 0.0)


def _evidence(model: Model, hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """(texts, 2): the difference of log-likelihoods for each word of a text, and the surest toxic stretch."""
    out = np.zeros((texts, 2))
    if not len(hashes):
        return out
    before = _histories(hashes, text)
    word, pair, history = _look(model.words, hashes), _look(model.pairs, pair_hashes(before, hashes)), _look(model.words, before)
    common = model.pair_prob[2][pair] / model.word_prob[2][word] + model.backoff[2][history]
    ordinary, toxic = (model.pair_prob[c][pair] + model.backoff[c][history] * common * model.word_prob[c][word] for c in (0, 1))
    # a word nobody knows speaks for neither class, whatever the two models keep for such words
    gain = np.log(toxic) - np.log(ordinary) - np.log(model.word_prob[1][-1] / model.word_prob[0][-1])
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    many = np.diff(np.append(first, len(text)))
    out[text[first], 0] = np.add.reduceat(gain, first) / many
    # stretches shorter at the end of a text divide by the full length as well
    sums = np.concatenate(([0.0], np.cumsum(np.maximum(model.word_sure[word], model.pair_sure[pair]))))
    ends = np.minimum(np.arange(len(gain)) + STRETCH, np.repeat(first + many, many))
    out[text[first], 1] = np.maximum.reduceat((sums[ends] - sums[:-1]) / STRETCH, first)
    return out


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression of weights above zero: the score rises with the models' difference and with the stretch."""
    beta = _newton(x, y, weight)
    kept = np.flatnonzero(beta[:-1] > 0)
    if len(kept) < x.shape[1]:
        part = _newton(x[:, kept], y, weight)
        beta = np.zeros(x.shape[1] + 1)
        beta[kept], beta[-1] = np.maximum(part[:-1], 0.0), part[-1]
    beta[0] = max(beta[0], LEAST_WEIGHT * beta[1])
    return beta


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.column_stack((x, np.ones(len(x))))
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 1e-2 * beta * np.append(np.ones(x.shape[1] - 1), 0)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _rising(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The share of ``y`` over ``z`` as steps that never fall (isotonic regression): edges and shares."""
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []       # lowest z, highest z, weight, weighted sum
    for at, hit, w in zip(z[order], y[order], weight[order]):
        blocks.append([at, at, w, w * hit])
        while len(blocks) > 1 and (blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2] or blocks[-2][1] == blocks[-1][0]):
            _, high, w_, sum_ = blocks.pop()
            blocks[-1][1:] = [high, blocks[-1][2] + w_, blocks[-1][3] + sum_]
    edges = np.asarray([(b[i], b[3] / b[2]) for b in blocks for i in (0, 1)]).T
    return edges if len(blocks) else np.asarray([[0.0], [0.0]])


def _scores(model: Model, x: np.ndarray) -> np.ndarray:
    """The share of toxic texts at the weighted sum; the sum itself decides among equal shares."""
    z = x @ model.curve[:2] + model.curve[2]
    return 0.99 * np.interp(z, *model.steps) + 0.01 / (1 + np.exp(-np.clip(z, -60, 60)))


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            x = np.zeros((batch.num_rows, 2))
            if model.constant is None:
                for w in pieces(batch.column(1), lower=True):
                    x[w.first:w.first + w.texts] = _evidence(model, w.hashes, w.text, w.texts)
                score = _scores(model, x)
            else:
                score = np.full(batch.num_rows, model.constant)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(x[:, 0]), pa.array(x[:, 1])],
                ["row", "score", "text_gain", "stretch_gain"])

    return run


def _labelled(labels: DataFrame) -> tuple[DataFrame, list[int]]:
    """(doc_id, toxic) of the labels to learn from, and how many are ordinary and toxic."""
    marks = settle(labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
                   .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
                   .agg((F.max(F.col("toxic").cast("int")) != 0).cast("int").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    return marks, [counts.get(0, 0), counts.get(1, 0)]


def _sample(docs: DataFrame, marks: DataFrame, rows: int, most: int) -> DataFrame:
    """(doc_id, text, toxic, fit) of at most ``rows`` labelled texts of each class, one of each group of
    near copies; fit 0 is for the curve.

    Texts over a part of ``most`` bytes are left out, each by itself. Where that leaves nothing of a class, it is an error.
    """
    order = F.xxhash64("doc_id", F.lit("sample"))
    chosen = settle(marks.where("toxic = 0").orderBy(order, "doc_id").limit(rows).unionAll(
        marks.where("toxic <> 0").orderBy(order, "doc_id").limit(rows)))
    # at most 2 * rows rows are broadcast
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # of several rows of one id the text of the lowest hash stands for it
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    own = F.octet_length("text").cast("bigint")
    size = F.sum(F.when(own <= most // LONGEST_PART, own).otherwise(0)).over(_by_class(order))
    taken = F.coalesce((own <= most // LONGEST_PART) & (F.col("size") <= most // 2), F.lit(False))
    found = settle(found.withColumn("size", size).select(
        "doc_id", F.when(taken, F.col("text")).alias("text"), F.when(F.col("toxic") != 0, 1).otherwise(0).alias("toxic"),
        (F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(3)) > 0).cast("int").alias("fit")))
    taken = {r["toxic"]: r["taken"] for r in found.groupBy("toxic").agg(F.count("text").alias("taken")).collect()}
    if len(taken) == 2 and not all(taken.values()):
        raise ValueError(f"labelled texts of both classes, but of one only texts over {most // LONGEST_PART} bytes: {taken} (toxic: texts taken)")
    sample = found.where(F.col("text").isNotNull())
    copies = _near_copies(sample)
    # at most 2 * rows ids
    return sample.where(~F.col("doc_id").isin(copies)) if copies else sample


def _by_class(order: Column):
    from pyspark.sql import Window

    return Window.partitionBy("toxic").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> Model:
    """A model of bounded size: pairs are counted in Spark, the distinct pairs of the sample come back."""
    ship(docs.sparkSession)
    marks, shares = _labelled(labels)
    sample = _sample(docs, marks, rows, most)
    classes = {r["toxic"]: r["fit"] for r in sample.groupBy("toxic").agg(F.sum("fit").alias("fit")).collect()}
    if len(classes) == 2 and not all(classes.values()):       # few rows: all are for the models
        sample = sample.withColumn("fit", F.lit(1))
    empty = np.zeros(0, np.uint64)
    if len(classes) < 2:
        none = np.zeros((3, 1))
        return Model(empty, none, none, empty, none, none[0], none[0], np.zeros(3), none[:2], 0.0)
    counted = sample.where("fit = 1").select("text", "toxic").mapInArrow(
        _count_batches, "u bigint, v bigint, w bigint, toxic int, pair int, word int").groupBy("u", "v", "w", "toxic").agg(
        F.sum("pair").alias("pair"), F.sum("word").alias("word"))
    by_class = [F.when(F.col("toxic") == c, F.col(x)) for x in ("u", "pair", "word") for c in (0, 1)]
    pairs = counted.groupBy("v", "w").agg(*[
        F.coalesce(F.count(x) if i < 2 else F.sum(x), F.lit(0)).cast("int").alias(f"n{i}") for i, x in enumerate(by_class)]).toArrow()
    v, w, *counts = (column.to_numpy() for column in pairs.columns)
    if not len(v):
        none = np.zeros((3, 1))
        return Model(empty, none, none, empty, none, none[0], none[0], np.zeros(3), none[:2], 0.0)
    model = _fit(v.view(np.uint64), w.view(np.uint64), *(np.stack(counts[i:i + 2]) for i in (0, 2, 4)))
    apart = sample.where("fit = 0").select(F.col("toxic").cast("bigint").alias("row"), "text")
    if not apart.count():
        apart = sample.select(F.col("toxic").cast("bigint").alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    x = _scored(apart, shared).toArrow()
    y = x.column("row").to_numpy().astype(float)
    # the classes weigh as much as among all labels
    weight = np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum())) * len(y) / sum(shares)
    gains = np.column_stack((x.column("text_gain"), x.column("stretch_gain")))
    curve = _curve(gains, y, weight)
    return model._replace(curve=curve, steps=_rising(gains @ curve[:2] + curve[2], y, weight))


def _scored(rows: DataFrame, shared) -> DataFrame:
    return rows.mapInArrow(_score_batches(shared), "row bigint, score double, text_gain double, stretch_gain double")


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; only its text is scored.

    Null texts count as empty; an empty text has no evidence either way and gets the score of none.
    Rows with a null doc_id are scored and not held out. Conflicting labels of a document count as
    toxic; null labels do not count. Without labelled rows of both classes every score is 0;
    if one class has only texts too long to learn from, that is an error. Repeated rows give repeated results, an empty table none.
    """
    model = train(docs, labels, rows, most)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _scored(texts, shared).select(
        F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_gain", "stretch_gain")
