import random

import numpy as np
import pytest

from regista.operators.matching import attach_places, match_places
from regista.operators.quality import by_match_quality, unmatched_names

WORDS = ["sant", "de", "la", "vall", "riu", "mont", "pla", "torre", "nova"]


def tokens(name):
    return set() if name is None else {w for w in name.lower().split() if len(w) > 1}


def brute_force(names, catalog):
    """Every name against every official name of its county."""
    best = {}
    for county, place in set(names):
        scored = [(-len(tokens(place) & tokens(nom)), codi, comarca)
                  for codi, nom, comarca, nom_comarca in catalog if nom_comarca == county]
        if county is not None and scored:
            rank, codi, comarca = min(scored)
            best[(county, place)] = (codi, comarca, -rank)
    return {(*k, *v) for k, v in best.items()}


@pytest.mark.parametrize("frequent", [0, 2, 10, 32])
def test_equals_brute_force(spark, frequent):
    rng = random.Random(frequent)

    def name():
        return " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 5)))

    names = [(rng.choice(["A", "B", "Hot", "Hot", "Hot"]), name()) for _ in range(120)]
    names += [("A", None), (None, "sant"), ("Nowhere", "sant"), ("B", ""), ("B", "zzz")]
    catalog = [(f"{i:03d}", name(), c, c) for i, c in enumerate(["A", "B"] * 10 + ["Hot"] * 40)]
    catalog += [("900", None, "C", "C"), ("901", "sant", "C", "C")]
    names += [("C", "sant"), ("C", "riu")]
    matched = match_places(
        spark.createDataFrame(names, "comarca string, municipi string"),
        spark.createDataFrame(catalog, "codi string, nom string, codi_comarca string, nom_comarca string"),
        frequent=frequent,
    )
    got = {tuple(r) for r in matched.select(
        "comarca", "municipi", "codi", "codi_comarca", "tokens_similar").collect()}
    assert got == brute_force(names, catalog)
    assert matched.count() == len(got)


def test_ties_and_review(spark, rows):
    catalog = spark.createDataFrame(
        [("2", "Prat de Llobregat, el", "11", "Baix Llobregat"),
         ("1", "Sant Joan Despí", "11", "Baix Llobregat"),
         ("3", "Sant Boi de Llobregat", "11", "Baix Llobregat")],
        "codi string, nom string, codi_comarca string, nom_comarca string",
    )
    names = spark.createDataFrame(
        [("Baix Llobregat", "El Prat de Llobregat"), ("Baix Llobregat", "Sant"),
         ("Baix Llobregat", "Gavà"), ("Osona", "Vic")],
        "comarca string, municipi string",
    )
    matches = match_places(names, catalog)
    assert rows(matches, "municipi", "codi", "tokens_similar") == [
        ("El Prat de Llobregat", "2", 4), ("Gavà", "1", 0), ("Sant", "1", 1),
    ]
    assert rows(unmatched_names(matches), "municipi") == [("Gavà",)]
    weakest = by_match_quality(matches, "municipi").collect()
    assert [r["municipi"] for r in weakest] == ["Gavà", "Sant", "El Prat de Llobregat"]
    placed = attach_places(names.withColumnRenamed("x", "x"), matches)
    assert rows(placed, "municipi", "codi", "codi_comarca")[-1] == ("Vic", None, None)
    assert placed.count() == 4


def test_rows_without_a_name(spark, rows):
    catalog = spark.createDataFrame(
        [("5", "Vic", "24", "Osona")], "codi string, nom string, codi_comarca string, nom_comarca string"
    )
    names = spark.createDataFrame([("Osona", None), (None, "Vic")], "comarca string, municipi string")
    placed = attach_places(names, match_places(names, catalog))
    assert rows(placed, "comarca", "municipi", "codi") == [("Osona", None, "5"), (None, "Vic", None)]


def test_long_names_with_common_words_meet_few_candidates(spark):
    """Eleven tokens each, two of them in every name: candidates grow with the names, not their product."""
    def word(kind, i, k):
        return kind + f"{i}x{k}".translate(str.maketrans("0123456789", "abcdefghij"))

    def frame(n):
        names = [("A", " ".join([word("n", i, k) for k in range(8)] + [word("o", i % 50, 1), "de", "la"])) for i in range(n)]
        official = [(f"{i:04d}", " ".join([word("o", i, k) for k in range(9)] + ["de", "la"]), "A", "A") for i in range(n)]
        return (spark.createDataFrame(names, "comarca string, municipi string"),
                spark.createDataFrame(official, "codi string, nom string, codi_comarca string, nom_comarca string"), names, official)

    def largest_join(n):
        names, catalog, raw, official = frame(n)
        matched = match_places(names, catalog)
        got = {tuple(r) for r in matched.select("comarca", "municipi", "codi", "codi_comarca", "tokens_similar").collect()}
        assert got == brute_force(raw, official)
        return max(_join_rows(matched))

    small, large = largest_join(60), largest_join(240)
    assert large <= 5 * small


def test_a_county_of_frequent_words_only(spark):
    """A hundred thousand names in one county, every word in hundreds of them: no name meets them all."""
    words, n = 60, 100_000
    rng = random.Random(8)
    letters = str.maketrans("0123456789", "abcdefghij")
    spelt = [f"w{i:02d}".translate(letters) for i in range(words)]
    picked = [sorted(rng.sample(range(words), rng.randint(3, 6))) for _ in range(n)]
    names = [sorted(rng.sample(range(words), rng.randint(1, 7))) for _ in range(200)]
    official = spark.createDataFrame(
        [(f"{i:06d}", " ".join(spelt[w] for w in held), "A", "A") for i, held in enumerate(picked)],
        "codi string, nom string, codi_comarca string, nom_comarca string")
    wanted = spark.createDataFrame([("A", " ".join(spelt[w] for w in held)) for held in names], "comarca string, municipi string")
    matched = match_places(wanted, official)
    got = {r["municipi"]: (r["codi"], r["tokens_similar"]) for r in matched.collect()}
    holds = np.zeros((n, words), np.int8)
    for i, held in enumerate(picked):
        holds[i, held] = 1
    for held in names:
        shared = holds[:, held].sum(axis=1)
        assert got[" ".join(spelt[w] for w in held)] == (f"{int(shared.argmax()):06d}", int(shared.max()))
    assert max(_join_rows(matched)) < len({tuple(h) for h in names}) * n / 20


def _join_rows(df):
    """Output rows of every join and explode in the plan that ran."""
    counts = []

    def walk(node):
        name = node.nodeName()
        if "Join" in name or name == "Generate":
            metric = node.metrics().get("numOutputRows")
            if metric.isDefined():
                counts.append(metric.get().value())
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in name:
            walk(node.plan())
        else:
            for i in range(node.children().size()):
                walk(node.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    walk(plan)
    return counts
