import hashlib

import pytest
from conftest import prose, words
from pyspark.sql import functions as F

from regista.llm import substrings


def _expected(rows):
    split = [(i, d, words(t)) for i, (d, t) in enumerate(rows)]
    last = 1 << 63
    first = {}
    for _, d, w in split:
        for i in range(len(w) - 12):
            k = tuple(w[i:i + 13])
            first[k] = min(first.get(k, last), last if d is None else d)
    out = []
    for _, d, w in split:
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < (last if d is None else d):
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [5, 400, substrings.GROUP_SUFFIXES])
def test_agrees_with_brute_force(frame, awkward_rows, group):
    got = substrings.removal_digests(frame(awkward_rows, clash=True).repartition(5), group).collect()
    assert sorted(map(tuple, got), key=str) == _expected(awkward_rows)


def test_texts_keep_their_form_where_nothing_repeats(frame, awkward_rows):
    docs = frame(awkward_rows, clash=True)
    out = substrings.without_repeats(docs)
    assert out.schema == docs.schema
    want = dict(zip(range(len(awkward_rows)), _expected(awkward_rows)))
    assert out.count() == len(want)
    texts = {r.doc_id: r.text for r in out.where("doc_id < 70").collect()}
    given = dict(r for r in awkward_rows if r[0] is not None and r[0] < 70)
    digest = {d: (n, k) for d, _, n, k in want.values()}
    for doc, text in texts.items():
        removed, kept = digest[doc]
        if removed:
            assert hashlib.sha256(text.encode()).hexdigest() == kept
        else:
            assert text == given[doc]


def test_empty_table(frame):
    assert substrings.removal_digests(frame([])).count() == 0
    assert substrings.without_repeats(frame([])).count() == 0


def test_a_passage_in_most_documents(frame):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"x{i} {passage} y{i}") for i in range(300)]
    got = {r.doc_id: r.n_removed for r in substrings.removal_digests(frame(rows).repartition(7), 50).collect()}
    assert got == {i: 20 if i else 0 for i in range(300)}


def test_marks_made_in_batches_are_dealt_by_document(spark, frame):
    text = prose(8, 300)
    docs = frame([(i, text) for i in range(400)]).repartition(20)
    key, _, body = substrings.row_key()
    plan = spark.sparkContext.broadcast(tuple(substrings._plan(docs, 1000)))
    sent = docs.select(key.alias("key"), body.alias("text")).mapInArrow(
        substrings._suffix_batches(plan), "group int, payload binary")
    sizes = [r.size for r in sent.groupBy("group").agg(F.sum(F.length("payload")).alias("size")).collect()]
    assert max(sizes) <= 0.1 * sum(sizes)
    # 288 marks of eight bytes and a header for each of 399 documents but one in each batch
    assert sum(sizes) <= 1.3 * 8 * 288 * 400
