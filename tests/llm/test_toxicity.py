import zlib

import pytest
from conftest import prose

from regista.llm import toxicity

RUDE = ["blorg", "snark", "vextil"]


def _rows(n=420):
    rows, marks = [], []
    for i in range(n):
        text, toxic = prose(1000 + i, 60 + i % 50, 3000).split(), int(i % 4 == 0)
        if toxic:
            for k in range(3):
                text.insert((7 * i + 13 * k) % len(text), RUDE[(i + k) % 3])
        rows.append((i, " ".join(text)))
        if i % 5 != 2:
            marks.append((i, toxic))
    return rows, marks


def _held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labels(spark):
    def build(marks):
        return spark.createDataFrame(marks, "doc_id bigint, toxic int").selectExpr("*", "1 AS quality", "'x' AS text", "2 AS score")

    return build


def test_learns_the_words_of_toxic_texts(frame, labels):
    rows, marks = _rows()
    got = toxicity.score(frame(rows, clash=True), labels(marks)).collect()
    assert len(got) == len(rows)
    wrong = [r.doc_id for r in got if r.predicted != int(r.doc_id % 4 == 0)]
    assert len(wrong) <= 4
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == _held_out(r.doc_id)


def test_held_out_labels_change_nothing(frame, labels):
    rows, marks = _rows(160)
    flipped = [(d, 1 - t if _held_out(d) else t) for d, t in marks]
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score(frame(rows), labels(m)).collect()) for m in (marks, flipped))
    assert a == b


def test_awkward_rows(frame, labels, awkward_rows):
    rows, marks = _rows(160)
    extra = [(r[0] + 5000 if r[0] is not None else None, r[1]) for r in awkward_rows]
    marks = marks + [(None, 1), (3, None), (5, 1), (5, 0), (99999, 1)]
    got = toxicity.score(frame(rows + extra), labels(marks)).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 for r in got)
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(d) for d, _ in rows + extra)


@pytest.mark.parametrize("marks", [[], [(1, 0), (2, 0)], [(1, 1)]])
def test_without_both_classes(frame, labels, marks):
    rows, _ = _rows(10)
    assert {(r.score, r.predicted) for r in toxicity.score(frame(rows), labels(marks)).collect()} == {(0.0, 0)}


def test_empty_table(frame, labels):
    assert toxicity.score(frame([]), labels([(1, 1), (2, 0)])).count() == 0


def _few_seen(n, add):
    rows, marks = [], []
    for i in range(n):
        text, toxic = prose(5000 + i, 40, 3000).split(), int(i % 3 == 0)
        if toxic:
            add(text, i // 3)
        rows.append((i, " ".join(text)))
        marks.append((i, toxic))
    return rows, marks


def _rare_words(text, i):
    """Two of 200 words: each is in one of a hundred toxic texts."""
    for k in (2 * i, 2 * i + 1):
        text.insert(k % 37, f"rude{k % 200}")


def _fixed_phrase(text, i):
    """Ordinary words, then words that always follow them."""
    text[i % 37:i % 37] = "w1 w2 w3 mizzle frump".split()


@pytest.mark.parametrize("add,n", [(_rare_words, 5400), (_fixed_phrase, 900)])
def test_learns_expressions_of_few_texts_or_contexts(frame, labels, add, n):
    rows, marks = _few_seen(n, add)
    got = [r for r in toxicity.score(frame(rows), labels(marks)).collect() if r.held_out]
    wrong = [r.doc_id for r in got if r.predicted != int(r.doc_id % 3 == 0)]
    assert len(wrong) <= 0.03 * len(got)


def test_near_copies_speak_once(frame, labels):
    rows, marks = _rows(420)
    story = prose(9, 80, 10**6).split()
    for i in range(60):      # copies of one story, all labelled toxic, with words changed
        copy = list(story)
        for k in range(4):
            copy[(17 * i + 19 * k) % 80] = f"changed{i}x{k}"
        rows.append((1000 + i, " ".join(copy + [RUDE[i % 3]])))
        marks.append((1000 + i, 1))
    rows.append((2000, " ".join(story)))
    got = {r.doc_id: r.predicted for r in toxicity.score(frame(rows), labels(marks)).collect()}
    assert got[2000] == 0 and sum(got[i] != int(i % 4 == 0) for i in range(420)) <= 4


def test_a_very_long_text_costs_one_sample_row(spark, frame, labels):
    rows, marks = _rows()
    first = {c: spark.createDataFrame([(d,) for d, t in marks if t == c and not _held_out(d)], "doc_id bigint").selectExpr(
        "doc_id", "xxhash64(doc_id, 'sample') AS at").orderBy("at").first().doc_id for c in (0, 1)}
    rows = [(d, f"{t} " * 1000 if d in first.values() else t) for d, t in rows]
    got = toxicity.score(frame(rows), labels(marks), most=1 << 19).collect()
    wrong = [r.doc_id for r in got if r.predicted != int(r.doc_id % 4 == 0)]
    assert len(got) == len(rows) and len(wrong) <= 4


def test_a_class_of_too_long_texts_is_an_error(frame, labels):
    rows, marks = _rows(60)
    rows = [(d, f"{t} " * 1000 if d % 4 == 0 else t) for d, t in rows]
    with pytest.raises(ValueError, match="over 16384 bytes"):
        toxicity.score(frame(rows), labels(marks), most=1 << 19)


def test_the_score_rises_with_both():
    import numpy as np

    rng = np.random.default_rng(2)
    y = (rng.random(3000) < 0.3).astype(float)
    x = np.column_stack((-y + rng.normal(size=3000), 2 * y + rng.normal(size=3000)))     # the first speaks against its class
    curve = toxicity._curve(x, y, np.ones(3000))
    assert curve[0] == pytest.approx(toxicity.LEAST_WEIGHT * curve[1]) and curve[1] > 1
    assert (toxicity._curve(-x, y, np.ones(3000))[:2] >= 0).all()


def test_rows_of_one_id_with_different_texts_are_learned_from_alike(spark, frame, labels):
    rows, marks = _rows(160)
    rows += [(d, f"other {t}") for d, t in rows[:60]]
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score(frame(x).repartition(n), labels(marks)).collect())
            for x, n in ((rows, 2), (rows[::-1], 5)))
    assert [r[0] for r in a] == [r[0] for r in b]
    assert [r[1] for r in a] == pytest.approx([r[1] for r in b], abs=1e-6)
