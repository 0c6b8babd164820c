import random

import numpy as np
import pytest
from conftest import prose

from regista.llm import decontamination as D


def _naive(a, b, least):
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best, places = 0, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best:
                    best, places = k, [(i, j)]
                elif k == best:
                    places.append((i, j))
        if best < least:
            return covered
        for i, j in places:
            if all(free_a[i:i + best]) and all(free_b[j:j + best]):
                for x in range(best):
                    free_a[i + x] = free_b[j + x] = False
                covered += best


def test_tiles_agree_with_naive_tiling():
    rng = random.Random(3)
    for _ in range(120):
        size = rng.choice([2, 3, 6, 40])
        a = [rng.randrange(size) for _ in range(rng.randrange(5, 40))]
        b = [rng.randrange(size) for _ in range(rng.randrange(0, 60))]
        for _ in range(3):
            i = rng.randrange(len(a))
            b[rng.randrange(len(b) + 1):0] = a[i:i + rng.randrange(3, 20)]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        found = D.tiles(x, y)
        assert all((x[p:p + n] == y[q:q + n]).all() for p, q, n in found)
        for side in (0, 1):
            places = [t[side] + k for t in found for k in range(t[2])]
            assert len(places) == len(set(places))
        want = _naive(a, b, 5)
        assert sum(t[2] for t in found) == want
        assert sum(t[2] for t in D.tiles(x, D._near(x, y))) == want


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, prose(31, 40)), (2, prose(32, 18)), (3, "too few words"), (4, None), (5, ""), (6, prose(33, 50)), (6, prose(33, 50)),
            (None, prose(34, 30))]
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "'x' AS doc_id", "1 AS coverage")


def _rows():
    item = prose(31, 40).split()
    moved = item[20:] + ["between"] + item[:20]
    holes = item[:16] + ["q"] + item[17:]
    return [(1, " ".join(item)), (2, prose(50, 30) + "\n" + " ".join(moved) + " " + prose(51, 9)), (3, " ".join(holes)),
            (4, " ".join(item[:25])), (5, prose(52, 300)), (6, None), (7, ""), (8, prose(32, 18).upper()), (9, prose(33, 50)),
            (None, prose(34, 30)), (10, "too few words"), (10, "too few words"), (11, prose(31, 40) + " " + prose(32, 18))]


def test_contaminated(frame, benchmark):
    docs = frame(_rows(), clash=True)
    got = sorted(((r.doc_id, r.item_id, r.covered_words) for r in D.contaminated(docs, benchmark).collect()), key=str)
    want = [(1, 1, 40), (2, 1, 40), (3, 1, 39), (8, 2, 18), (9, 6, 50), (9, 6, 50), (None, None, 30), (10, 3, 3), (10, 3, 3), (11, 1, 40), (11, 2, 18)]
    assert got == sorted(want, key=str)


def test_agrees_with_tiling_every_pair(spark, frame):
    rng = random.Random(9)
    item_rows = [(i, " ".join(rng.choice("abcdef") for _ in range(1 + i % 9))) for i in range(60)] + [(100, ""), (101, None)]
    docs = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    docs += [(50 + i, f"x {item_rows[i][1].upper()}\ty") for i in range(30)]
    want = set()
    for doc, text in docs:
        for item, passage in item_rows:
            sought = (passage or "").split()
            covered = _naive(sought, text.lower().split(), min(5, len(sought))) if sought else 0
            if sought and covered >= D.COVERAGE * len(sought):
                want.add((doc, item, covered))
    table = spark.createDataFrame(item_rows, "item_id bigint, text string")
    got = [(r.doc_id, r.item_id, r.covered_words) for r in D.contaminated(frame(docs), table).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_candidates_in_small_steps_are_the_same(monkeypatch):
    rng = random.Random(4)
    tables = D._tables(list(range(30)), [" ".join(rng.choice("abc") for _ in range(7)) for _ in range(30)])
    assert [t.length for t in tables] == [5]
    text, runs = np.repeat(np.arange(50), 20), np.tile(tables[0].hashes[::3], 50)[:1000]
    whole = list(D._candidates(tables[0], text, runs, 0.8))
    monkeypatch.setattr(D, "_SEED_ROWS", 40)
    assert whole and list(D._candidates(tables[0], text, runs, 0.8)) == whole


def test_blocks_of_the_benchmark_give_the_same(frame, benchmark):
    docs = frame(_rows())
    whole = sorted(map(tuple, D.contaminated(docs, benchmark).collect()), key=str)
    assert sorted(map(tuple, D.contaminated(docs, benchmark, block_bytes=100).collect()), key=str) == whole


def test_empty_tables(frame, benchmark):
    assert D.contaminated(frame([]), benchmark).count() == 0
    assert D.contaminated(frame(_rows()), benchmark.limit(0)).count() == 0
