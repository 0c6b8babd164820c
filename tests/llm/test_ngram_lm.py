import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import LOWER, prose, words

from regista.llm import ngram_lm
from regista.llm.kneser_ney import discounts


def _expected(rows):
    split = [(d, words((t or "").translate(LOWER)) + ["</s>"]) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    train = [w for (_, w), h in zip(split, held) if not h]
    count = Counter(x for w in train for x in w)
    pairs = Counter(p for w in train for p in zip(["<s>", *w], w))
    total, follow = Counter(), {}
    for (a, _), k in pairs.items():
        total[a] += k
        follow.setdefault(a, [0, 0, 0])[min(k, 3) - 1] += 1
    before = Counter(b for _, b in pairs)
    tokens, types, histories = sum(count.values()), len(count), len(pairs)
    d1 = discounts(np.array([sum(v == k for v in before.values()) for k in (1, 2, 3, 4)]))
    d2 = discounts(np.array([sum(v == k for v in pairs.values()) for k in (1, 2, 3, 4)]))
    freed = sum(d1[min(v, 3)] for v in before.values()) / histories if histories else 1.0

    def p(a, b):
        single = freed / (types + 1) + (max(before[b] - d1[min(before[b], 3)], 0) / histories if histories else 0)
        if not total[a]:
            return single
        left = max(pairs[a, b] - d2[min(pairs[a, b], 3)], 0) + sum(d2[i + 1] * follow[a][i] for i in range(3)) * single
        return left / total[a]

    return [(d, h, len(w), sum(count[x] > 0 for x in w), tokens,
             sum(math.log10((count[x] + 1) / (tokens + types + 1)) for x in w),
             sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], w))) for (d, w), h in zip(split, held)], p, count


def _agree(got, want):
    got, want = sorted(map(tuple, got), key=str), sorted(want, key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("batch", [40, 3_000_000])
def test_agrees_with_brute_force(frame, awkward_rows, monkeypatch, batch):
    monkeypatch.setattr(ngram_lm, "_TOKENS", batch)
    rows = awkward_rows + [(300 + i, "the same few words") for i in range(400)]
    _agree(ngram_lm.score(frame(rows, clash=True).repartition(3)).collect(), _expected(rows)[0])


def test_probabilities_add_up_to_one():
    rows = [(i, prose(i, 30, 20)) for i in range(30)]
    _, p, count = _expected(rows)
    for history in ["<s>", "w1", "never seen"]:
        assert sum(p(history, w) for w in count) + p(history, "unknown") == pytest.approx(1)


def test_held_out_texts_are_likelier_than_by_the_base(frame):
    rows = [(i, prose(i % 40, 80, 300)) for i in range(200)]
    held = [r for r in ngram_lm.score(frame(rows)).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(frame):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    _agree(ngram_lm.score(frame([(held, "a b")])).collect(), [(held, True, 3, 0, 0, 0.0, 0.0)])
    assert ngram_lm.score(frame([])).count() == 0
