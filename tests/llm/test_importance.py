import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from regista.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_force(docs, target, min_words=20, percent=5):
    """Every n-gram as text, its CRC taken from its bytes."""
    def counted(texts):
        return Counter(crc32(f.encode()) % 10000 for text in texts for f in features(text)[1])

    source, aim = counted(t for _, t in docs), counted(target)
    all_source, all_target = source.total(), aim.total()
    out = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((aim[b] + 1) * (all_source + 10000) / ((source[b] + 1) * (all_target + 10000))))
                     for b in (crc32(f.encode()) % 10000 for f in found))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("length", [0, 1, 7, 255, 256, 1000, 70_000, 1 << 20])
def test_crc_of_a_part_from_two_running_crcs(length):
    rng = random.Random(length)
    head, part = rng.randbytes(rng.randint(0, 50)), rng.randbytes(length)
    moved = importance.shifted(np.array([crc32(head)], np.uint32), np.array([length]))
    assert int(moved[0]) ^ crc32(head + part) == crc32(part)


def test_equals_brute_force(spark, frame, awkward_rows):
    rng = random.Random(5)
    rows = awkward_rows + [(1000 + i, " ".join(f"W{rng.randint(0, 90)}" for _ in range(rng.randint(1, 60)))) for i in range(300)]
    rows += [(2000, "ÉTÉ été\x7fa_b-9 c 　日本 語\n" * 9), (2001, "x" * 3000 + " y " * 30)]
    target = ["w3 w4 w5 again and again", None, "", "été 9 w1 w2 w1 w2"]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    expected = brute_force(rows, target)
    assert got(importance.resample(frame(rows), aim)) == expected
    assert sum(r[4] is not None for r in expected) > 5


def test_slices_and_blocks_do_not_matter(spark, frame, awkward_rows, monkeypatch):
    texts = [text for _, text in awkward_rows]

    def all_ngrams(block, part):
        monkeypatch.setattr(importance, "_BLOCK_WORDS", block)
        monkeypatch.setattr(importance, "_SLICE", part)
        return Counter((int(i), int(c)) for words in importance._scan(iter(texts), 3)
                       for text, crc in importance._ngrams(words, 3) for i, c in zip(text, crc))

    expected = Counter((i, crc32(f.encode())) for i, text in enumerate(texts) for f in features(text)[1])
    assert all_ngrams(1 << 17, 1 << 20) == expected
    assert all_ngrams(1, 1) == expected
    assert all_ngrams(5, 37) == expected


def test_a_text_of_megabytes(spark, frame):
    rows = [(1, "a bc " * 600_000), (2, "z" * 3_000_000), (3, "a bc d")]
    aim = spark.createDataFrame([(1, "bc a")], "item_id bigint, text string")
    assert got(importance.resample(frame(rows), aim)) == brute_force(rows, ["bc a"])


def test_empty_tables_and_clashing_columns(spark, frame, awkward_rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert got(importance.resample(frame([]), none)) == []
    clashing = frame(awkward_rows, clash=True).selectExpr("*", "1 AS block", "2 AS place", "3 AS rank", "4 AS before")
    assert got(importance.resample(clashing, none.selectExpr("*", "1 AS bucket", "2 AS n"))) == brute_force(awkward_rows, [])


def test_ties_and_repeated_rows(spark, frame):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(7, text)] * 60 + [(8, text)] * 60
    aim = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    ranks = sorted(r["rank"] for r in importance.resample(frame(rows), aim).where("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 7))
