import hashlib
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from regista.llm import prefix_trie


def brute_force(rows):
    """Every beginning of every rebuilt conversation as a tuple of turns."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn, role or "", text or ""))
    ordered = {c: [t[2:] for t in sorted(own, key=lambda t: (t[0], t[1] or 0, hashed(*t[2:])))] for c, own in turns.items()}
    members = defaultdict(list)
    for conv, own in sorted(ordered.items()):
        h = crc32(str(conv).encode()) % 6
        whole = ordered.get(conv - conv % 100, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((conv, len(whole) == d))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (members[n][0][0], len(n), members[n[:-1]][0][0] if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(str(c) for c, ends in members[n] if ends).encode()).hexdigest())
        for n in members)


def hashed(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def random_rows(seed, convs=120, longest=9, texts=3):
    rng = random.Random(seed)
    ids = rng.sample(range(400), convs) + [100, 200]
    return [(c, t, rng.choice(["user", "assistant"]) if t > 1 else "user", "é" * rng.randint(1, texts))
            for c in set(ids) for t in range(rng.randint(0, longest))]


@pytest.mark.parametrize("block_turns", [1 << 20, 40, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, block_turns):
    rows = random_rows(seed, texts=1 + seed)
    rows += [(c, t, "user", "copy") for c in range(401, 480) for t in range(3)]   # copies over several blocks
    assert got(prefix_trie.trie(table(spark, rows), block_turns)) == brute_force(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "x"), (None, None, None, None), (0, None, None, None), (0, None, "user", "b"), (0, 1, "user", ""),
            (1, 1, None, "a"), (1, 1, "", "a"), (1, 1, "", "a"), (2, 5, "user", "long " * 400_000), (7, 0, "a", "bc"), (8, 0, "ab", "c"),
            (300, 0, "user", "only"), (305, 0, "user", "other"), (305, 1, "user", "other")]
    expected = brute_force(rows)
    assert got(prefix_trie.trie(table(spark, rows))) == expected
    clashing = table(spark, rows).selectExpr("*", "1 AS block", "2 AS place", "3 AS depth", "4 AS key", "5 AS length", "6 AS heads")
    assert got(prefix_trie.trie(clashing, 2)) == expected
    assert got(prefix_trie.trie(table(spark, []))) == []


@pytest.mark.parametrize("followed", [1, 3, 5])
def test_long_conversations_are_followed_while_shared(spark, monkeypatch, followed):
    monkeypatch.setattr(prefix_trie, "FOLLOWED", followed)
    rows = random_rows(9, convs=60, longest=12, texts=2)
    assert got(prefix_trie.trie(table(spark, rows), 30)) == brute_force(rows)


def test_one_conversation_of_many_turns_is_not_gathered(spark):
    one, other = [c for c in range(1, 100) if crc32(str(c).encode()) % 6 == 0][:2]
    rows = [(one, t, "user", f"t{t}") for t in range(3000)] + [(other, t, "user", f"t{t}") for t in range(70)]
    assert prefix_trie._unshared(*prefix_trie.rebuilt(table(spark, rows))).count() == 0
    apart = rows[:-70] + [(other, t, "user", f"other {t}") for t in range(70)]
    assert {r[0] for r in prefix_trie._unshared(*prefix_trie.rebuilt(table(spark, apart))).collect()} == {one, other}
    nodes = prefix_trie.trie(table(spark, apart))
    assert nodes.count() == 1 + 3000 + 70
    assert got(nodes.where("depth = 0").select("n_convs", "n_children", "n_leaves")) == [(2, 2, 2)]
    assert got(nodes.where(f"depth = 3000 AND conv_id = {one}").select("ends_sha256")) == [(hashlib.sha256(str(one).encode()).hexdigest(),)]
    assert nodes.where("depth < 3000 AND depth <> 70 AND n_children = 0").count() == 0


def test_sparse_table():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(0, 5, n)
        table = prefix_trie._SparseTable(values)
        for at in range(n):
            for depth in range(6):
                right, left = at, at
                while right + 1 < n and values[right + 1] >= depth:
                    right += 1
                while left > 0 and values[left] >= depth:
                    left -= 1
                a, d = np.array([at]), np.array([depth])
                assert (table.reach_right(a, d)[0], table.reach_left(a, d)[0]) == (right, left)
            for last in range(at, n):
                assert table.least(np.array([at]), np.array([last]))[0] == values[at:last + 1].min()
