from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import LOWER, prose, words

from regista.llm import simhash
from regista.llm.components import components


def _print(text):
    w = words((text or "").translate(LOWER))
    runs = [w[i:i + 4] for i in range(len(w) - 3)] if len(w) >= 4 else [w] if w else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _expected(rows):
    prints = [_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((d, f"{p:016x}", least[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_every_four_positions_hold_a_set(width):
    sets = simhash.position_sets(width)
    assert all(any(set(s) <= set(four) for s in sets) for four in combinations(range(8), 4))
    assert len({frozenset(s) for s in sets}) == len(sets)


def test_agrees_with_brute_force(frame, awkward_rows):
    rows = awkward_rows + [(200 + i, prose(9, 300) + f" tail{i}") for i in range(12)]
    got = simhash.near_duplicates(frame(rows, clash=True)).collect()
    assert sorted(map(tuple, got), key=str) == _expected(rows)


def test_empty_table(frame):
    df = simhash.near_duplicates(frame([]))
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    assert df.count() == 0


@pytest.mark.parametrize("width", [2, 3, 4])
def test_long_lists_are_compared_in_parts(spark, monkeypatch, width):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    close = base[rng.integers(0, 30, 600)] ^ (np.uint64(1) << rng.integers(0, 64, 600, dtype=np.uint64))
    bits = np.unique(np.concatenate((base, close)))
    monkeypatch.setattr(simhash, "LIST_PART", 9)
    monkeypatch.setattr(simhash, "set_width", lambda distinct: width)
    df = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "bits bigint")
    got = {r.node: r.label for r in components(simhash.links(df, len(bits))).collect()}
    root = {int(b): int(b) for b in bits.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(bits.tolist(), 2):
        if (a ^ b).bit_count() <= 4:
            x, y = (find(int(np.uint64(v).astype(np.int64))) for v in (a, b))
            root[max(x, y)] = min(x, y)
    assert all(got.get(b, b) == find(b) for b in root)


def test_chains_and_stars_end_at_the_smallest(spark):
    links = [(i + 1, i) for i in range(1, 60)] + [(i, 500) for i in range(501, 560)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(500, 560), 500)}
