import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from regista.llm import language_id

SYLLABLES = {"aa": ["ba", "lo", "mi", "tu", "ka"], "bb": ["sch", "ung", "ein", "ta", "mi"], "cc": ["日", "本", "語", "の", "は"]}


def sentence(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(seed, size):
    rng = random.Random(seed)
    langs = [rng.choice(["aa", "aa", "bb", "cc"]) for _ in range(size)]
    return [(i, sentence(rng, lang, rng.randint(3, 40)).title() + "!!", lang) for i, lang in enumerate(langs)]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def ngrams(text, longest):
    """Every run of characters of a word and the spaces around it."""
    words, word = [], ""
    for c in f"{(text or '').lower()} ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    # neighbours share a space: count the lone word's own runs, then those that take a space in
    return Counter(w[i:i + n] for word in words for w in [f" {word} "] for n in range(1, longest + 1)
                   for i in range(len(w) - n + 1) if w[i:i + n].strip())


def hashed(run, buckets):
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for n, c in enumerate(run, 1):
            h = (h + np.uint64(ord(c)) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return int((h >> np.uint64(20)) % np.uint64(buckets))


TEXTS = ["Ab, cd; ÉÉ?", "", "12 -", "a", "日本語 Text\nab", "x" * 50, "  lead and trail  "]


def test_features_equal_brute_force():
    found = Counter()
    for text, bucket in language_id._features(TEXTS, 4, 1 << 17):
        found.update(zip(text.tolist(), bucket.tolist()))
    expected = Counter()
    for i, text in enumerate(TEXTS):
        for run, n in ngrams(text, 4).items():
            expected[i, hashed(run, 1 << 17)] += n
    assert found == expected


def test_long_texts_are_walked_whole(monkeypatch):
    text = " ".join(sentence(random.Random(3), "bb", 400).split() + ["word's"] * 100)

    def counted(size):
        monkeypatch.setattr(language_id, "_BLOCK_CHARS", size)
        (_, bucket, times), = language_id._distinct([text], 4, 1 << 17)
        return dict(zip(bucket.tolist(), times.tolist()))

    assert counted(1 << 18) == counted(50) == counted(777)


def test_inverse_frequencies(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS + [None]], "text string").repartition(3)
    got = language_id.inverse_frequencies(df, 4, 1 << 12)
    holding = Counter(b for t in TEXTS for b in {hashed(run, 1 << 12) for run in ngrams(t, 4)})
    for bucket in range(1 << 12):
        assert got[bucket] == pytest.approx(math.log((2 + len(TEXTS)) / (1 + holding[bucket])) + 1)


def test_follow_the_leader_equals_coordinate_by_coordinate(monkeypatch):
    monkeypatch.setattr(language_id, "LEAST_STEPS", 1)
    rng = np.random.default_rng(7)
    rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4)) for _ in range(15)]
    classes = rng.integers(0, 3, 15)
    got = language_id.follow_the_leader(rows, classes, 3, 12, alpha=0.4, beta=1.0, l1=0.05, l2=0.1, epochs=2)
    z, n = [[0.0] * 3 for _ in range(12)], [[0.0] * 3 for _ in range(12)]

    def weight(i, k):
        if abs(z[i][k]) <= 0.05:
            return 0.0
        return -(z[i][k] - math.copysign(0.05, z[i][k])) / ((1.0 + math.sqrt(n[i][k])) / 0.4 + 0.1)

    order = np.random.default_rng(0)
    for _ in range(2):
        for r in order.permutation(15):
            at, x = rows[r]
            w = {(i, k): weight(i, k) for i in at for k in range(3)}
            e = [math.exp(sum(v * w[i, k] for i, v in zip(at, x))) for k in range(3)]
            for k in range(3):
                for i, v in zip(at, x):
                    g = v * (e[k] / sum(e) - (classes[r] == k))
                    sigma = (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / 0.4
                    z[i][k] += g - sigma * w[i, k]
                    n[i][k] += g * g
    expected = np.array([[weight(i, k) for k in range(3)] for i in range(12)])
    assert np.allclose(got, expected)
    assert (got == 0).any() and (got != 0).any()


def test_temperature_calms_what_is_too_sure():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 2, 4000)
    right = rng.random(4000) < 0.8                     # right four times in five, but nearly certain
    logits = np.zeros((4000, 2))
    logits[np.arange(4000), np.where(right, classes, 1 - classes)] = 10.0
    t = language_id.best_temperature(logits, classes)
    assert language_id._softmax(logits / t).max(axis=1).mean() == pytest.approx(0.8, abs=0.02)


@pytest.fixture(scope="module")
def identified(spark):
    rows = corpus(1, 400)
    return rows, {r["doc_id"]: r for r in language_id.identify(table(spark, rows)).collect()}


def test_held_out_accuracy(identified):
    rows, found = identified
    held = [(lang, found[i]) for i, _, lang in rows if crc32(str(i).encode()) % 4 == 2]
    assert all(r["held_out"] for _, r in held) and sum(r["held_out"] for r in found.values()) == len(held)
    assert sum(r["lang_pred"] == lang for lang, r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, identified):
    rows, found = identified
    changed = [(i, text, "zz" if crc32(str(i).encode()) % 4 == 2 else lang) for i, text, lang in rows]
    again = table(spark, changed).selectExpr("*", "'x' AS bucket", "'y' AS h", "1 AS n", "'z' AS source", "2 AS place", "true AS lettered")
    got = language_id.identify(again.repartition(5)).collect()
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got} == {
        i: (r["lang_pred"], pytest.approx(r["score"], abs=1e-5)) for i, r in found.items()}


def test_awkward_rows(spark):
    long = sentence(random.Random(8), "bb", 400_000)
    rows = corpus(2, 200) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 + 3 !", "bb"), (1003, long, "bb"), (1004, "ſ", None),
                             (None, "mitu kalo", "aa"), (1005, "Tu", None), (1005, "Tu", None), (1006, "日" * 600_000, None)]
    found = language_id.identify(table(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by_id[1003]["lang_pred"] == "bb" and by_id[1006]["lang_pred"] == "cc" and by_id[1004]["lang_pred"] in SYLLABLES
    assert by_id[None]["held_out"] is False
    twice = [r for r in found if r["doc_id"] == 1005]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_nothing_to_learn_from(spark):
    assert language_id.identify(table(spark, [])).collect() == []
    found = language_id.identify(table(spark, [(1, "some text", None), (2, None, "aa")])).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}


def test_one_language_only(spark):
    found = language_id.identify(table(spark, [(i, "mitu", "aa") for i in range(9)])).collect()
    assert {r["lang_pred"] for r in found} == {"aa"}


def test_many_copies_are_learned_from_once(spark):
    rows = corpus(4, 60) + [(5000 + i, "kalo mitu", "bb") for i in range(600)]
    sample = language_id._sample(table(spark, rows).select("text", "lang"), 300, 100, 1 << 16)
    assert sample.where("text = 'kalo mitu'").count() == 1


def test_block_by_block_is_all_at_once(monkeypatch):
    column = pa.array([t for _, t, _ in corpus(6, 30)] + [None, ""])
    monkeypatch.setattr(language_id, "_BLOCK_CHARS", 100)
    assert [t for first, texts in language_id._blocks(column) for t in texts] == [t or "" for t in column.to_pylist()]
