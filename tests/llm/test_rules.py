from collections import Counter

import duckdb
import pandas as pd
import pytest
from conftest import prose, words

from regista.llm import rules


def _measured(doc, text):
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if many[x] > 1:
            covered.update(range(i, i + 5))
    return (doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def rows(awkward_rows):
    return awkward_rows + [(80, "same line here\nother\nsame line here\n \nsame line here\r\n" * 3), (81, "### $$$ |a| <b> & % * " * 9),
                           (82, "a b c d e a b c d e a b c d"), (83, "x" * 400 + " y" * 12), (84, "äöü ß ß   é" * 30),
                           (85, prose(8, 300) + "\n" + prose(8, 300)), (86, "a " * 3000)]


def test_ledger_agrees_with_brute_force(frame, rows):
    got = rules.ledger(frame(rows, clash=True)).drop("failures").collect()
    assert sorted(map(tuple, got), key=str) == sorted((_measured(*r) for r in rows), key=str)


def test_sql_agrees(frame, rows):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})  # noqa: F841  (read by the SQL)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({rules.ORACLE})").fetchall()
    got = rules.judged(rules.ledger(frame(rows))).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_versions_and_ablations_agree_with_sql(frame, rows):
    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})  # noqa: F841  (read by the SQL)
    entries = rules.open_ledger(frame(rows, clash=True))
    for df, sql in ((rules.verdicts(entries).drop("n_lines"), rules.ORACLE), (rules.policy_ablations(entries), rules.ABLATIONS_ORACLE)):
        want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    kept = {r.version: r.kept for r in rules.policy_ablations(entries).collect()}
    assert kept == {v: rules.judged(entries, v).where("kept").count() for v in rules.POLICIES}


def test_bits_policies_and_ablations(frame, rows):
    entries = rules.ledger(frame(rows)).cache()
    bits = {r: rules.bit(r) for r in rules.RULES}
    got = entries.collect()
    for r in got:
        for rule, condition in rules.RULES.items():
            assert bool(r.failures & bits[rule]) == eval(condition, {}, r.asDict())
    for version, chosen in rules.POLICIES.items():
        mask = rules.mask(version)
        kept = sum(r.kept for r in rules.judged(entries, version).collect())
        assert kept == sum(not r.failures & (mask | rules.mask("base")) for r in got)
        table = {r.rule: (r.failed, r.failed_alone) for r in rules.ablations(entries, version).collect()}
        assert table == {rule: (sum(bool(r.failures & bits[rule]) for r in got), sum(r.failures & mask == bits[rule] for r in got))
                         for rule in chosen}
    summary = rules.failed_anywhere(entries.withColumn("part", entries["n_words"] < 20), "part").collect()
    for s in summary:
        own = [r.failures for r in got if (r.n_words < 20) == s.part]
        every, some = own[0], 0
        for f in own:
            every, some = every & f, some | f
        assert (s.any_failed, s.all_failed, s["rows"]) == (some, every, len(own))


def test_empty_table(frame):
    assert rules.judged(rules.ledger(frame([]))).count() == 0
    assert rules.policy_ablations(rules.ledger(frame([]))).count() == 0
    assert {(r.failed, r.failed_alone) for r in rules.ablations(rules.ledger(frame([]))).collect()} <= {(0, 0)}
