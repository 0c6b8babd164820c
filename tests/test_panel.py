import random

from pyspark.sql import functions as F

from regista.operators.dedupe import top1_per_group
from regista.operators.panel import (
    calendar_grid,
    densify,
    hold_until_next,
    last_known,
    running_sum,
    zero_filled_from_first,
)


def facts(spark, data):
    return spark.createDataFrame(data, "k string, year int, v bigint")


def test_grid_has_every_key_in_every_year(spark):
    grid = calendar_grid(spark.createDataFrame([("a",), ("b",)], "k string"), 2000, 2003)
    assert grid.count() == 8
    cells = densify(grid, facts(spark, [("a", 2001, 5)]), ["k", "year"], {"v": 0})
    assert cells.count() == 8
    assert cells.agg(F.sum("v")).first()[0] == 5
    assert cells.where("v is null").count() == 0


def test_null_keys_do_not_join(spark):
    grid = calendar_grid(spark.createDataFrame([(None,)], "k string"), 2000, 2000)
    cells = densify(grid, facts(spark, [(None, 2000, 5)]), ["k", "year"])
    assert [r["v"] for r in cells.collect()] == [None]


def test_forward_fill_and_running_sum(spark, rows):
    df = facts(spark, [("a", 1, None), ("a", 2, 4), ("a", 3, None), ("a", 4, 1)])
    out = df.select("year", last_known(F.col("v"), ["k"]).alias("f"), running_sum(F.col("v"), ["k"]).alias("s"))
    assert rows(out) == [(1, None, None), (2, 4, 4), (3, 4, 4), (4, 1, 5)]


def test_hold_equals_dense_forward_fill(spark, rows):
    rng = random.Random(1)
    data = [(k, y, rng.randint(1, 9)) for k in "abcd" for y in range(1990, 2000) if rng.random() < 0.4]
    sparse = facts(spark, data)
    grid = calendar_grid(sparse.select("k").distinct(), 1990, 1999)
    dense = densify(grid, sparse, ["k", "year"]).select(
        "k", "year", last_known(F.col("v"), ["k"]).alias("v")
    ).where("v is not null")
    assert rows(hold_until_next(sparse, ["k"], 1999)) == rows(dense)


def test_zero_fill_equals_dense_panel(spark, rows):
    rng = random.Random(2)
    data = [(k, y, rng.choice([0, 0, 3, 7])) for k in "abcdefgh" for y in range(1988, 2003)
            for _ in range(rng.choice([0, 0, 1, 2]))]
    df = facts(spark, data)
    first = {}
    for k, y, v in data:
        if v > 0 and 1990 <= y <= 2000:
            first[k] = min(first.get(k, 9999), y)
    expected = []
    for k, start in first.items():
        for y in range(start, 2001):
            found = [v for kk, yy, v in data if kk == k and yy == y]
            expected += [(k, y, v) for v in found] or [(k, y, 0)]
    got = rows(zero_filled_from_first(df, ["k"], "v", 1990, 2000))
    assert got == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_top1_keeps_one_row_per_key_and_groups_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "b"), (None, 1, "p"), (None, 2, "q")],
        "k string, score int, code string",
    )
    best = top1_per_group(df, ["k"], [F.desc("score"), F.asc_nulls_last("code")])
    assert rows(best) == [("a", 3, "b"), (None, 2, "q")]


def test_top1_is_limited_before_the_shuffle(spark, capsys):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    top1_per_group(df, ["k"], [F.asc("id")]).explain()
    plan = capsys.readouterr().out
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")
