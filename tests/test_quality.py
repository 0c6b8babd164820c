import pytest

from regista.fixed_values import REGISTER_PATTERNS
from regista.operators import aggregate, quality
from regista.operators.project import common_columns, mart_rows, not_matching
from regista.operators.sets import set_difference, union_all, union_diagonal


def test_distinct_preserved_counts_null_as_an_id(spark):
    before = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    after = spark.createDataFrame([("a",), ("b",)], "sid string")
    row = quality.distinct_preserved(before, "id", after, "sid").first()
    assert tuple(row) == (2, 2, True)
    with pytest.raises(quality.DataQualityError):
        quality.require_distinct_preserved(before, "id", after.limit(0), "sid")


def test_row_rules(spark):
    assert tuple(quality.row_count_status(spark.range(0)).first()) == (0, "error")
    assert tuple(quality.row_count_status(spark.range(99)).first()) == (99, "warn")
    assert tuple(quality.row_count_status(spark.range(100)).first()) == (100, "ok")
    quality.require_rows(spark.range(1))
    with pytest.raises(quality.DataQualityError, match="marts has no rows"):
        quality.require_rows(spark.range(0), "marts")


def test_pattern_profile_ignores_nulls(spark, rows):
    df = spark.createDataFrame(
        [("S00001", "2007-02-07", "35", "08001", "P00120012"), ("S1", None, "7", "08820", "null")],
        "registre string, inscripcio string, capacitat string, cp string, nif string",
    )
    profile = aggregate.all_match(df, REGISTER_PATTERNS)
    assert rows(profile, "column_name", "matches") == [
        ("capacitat", True), ("cp", True), ("inscripcio", True), ("nif", True), ("registre", False),
    ]
    assert rows(not_matching(df, "registre", REGISTER_PATTERNS["registre"]), "registre") == [("S1",)]
    assert not_matching(df, "inscripcio", "^x").count() == 1
    for empty in (df.limit(0), df.selectExpr("CAST(NULL AS STRING) AS registre")):
        assert [r.matches for r in aggregate.all_match(empty, {"registre": "x"}).collect()] == [True]


def test_too_many_values_to_list(spark):
    df = spark.range(20).selectExpr("id % 11 AS v")
    assert aggregate.distinct_list(df, "v", 11).first()["values"] == list(range(11))
    with pytest.raises(Exception, match="v has more than 10 distinct values: 11"):
        aggregate.distinct_list(df, "v", 10).collect()


def test_missing_members(spark, rows):
    expected = spark.createDataFrame([(2000,), (2011,), (2021,)], "year int")
    landed = spark.createDataFrame([(2011,)], "year int")
    assert rows(quality.missing_members(expected, landed, "year")) == [(2000,), (2021,)]


def test_missing_members_joins_distinct_landed_values(spark, rows):
    expected = spark.createDataFrame([(2000,), (2011,), (None,)], "year int")
    landed = spark.range(1000).selectExpr("IF(id % 2 = 0, 2011, NULL) AS year")
    missing = quality.missing_members(expected, landed, "year")
    assert rows(missing) == [(2000,), (None,)]
    # both sides are reduced to their members before the join
    assert missing._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2


def test_mart_filter_drops_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "RES-003"), (0, "RES-003"), (None, "RES-003"), (5, None), (5, "BAS-001")],
        "capacity int, service_type_id string",
    )
    assert rows(mart_rows(df)) == [(1, "RES-003")]


def test_unions_and_differences(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, c int")
    assert union_all([a, a]).count() == 4
    assert rows(union_diagonal([a, b])) == [(1, "x", None), (1, "x", None), (None, "y", 2)]
    assert common_columns(a, b).columns == ["b"]
    left = spark.createDataFrame([("x",), ("x",), ("z",), (None,)], "b string")
    assert rows(set_difference(left, a, "b")) == [("z",)]


@pytest.mark.parametrize("dense", [True, False])
def test_distinct_ids_are_counted_exactly(spark, monkeypatch, dense):
    """Register numbers by bitmaps, scattered ids as they are: the same figures."""
    monkeypatch.setattr(quality, "_DENSE", 1 if dense else 10**9)
    ids = [f"S{i:05d}" for i in range(40_000)] + [f"S{i:06d}" for i in range(500)] + ["7", "07", "007", "0", "", "abc", "x1y", None, None]
    ids += [f"T{i}" for i in range(300)] + ["9" * 18, "9" * 19, "9" * 25, "1" + "9" * 25] + ["S00001"] * 1000
    before = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    after = before.where("id IS NULL OR id <> 'S00001'")
    row = quality.distinct_preserved(before, "id", after, "id").first()
    assert (row["before_count"], row["after_count"], row["preserved"]) == (len(set(ids)), len(set(ids)) - 1, False)
    numbers = spark.range(-50, 70_000).unionAll(spark.range(100))
    row = quality.distinct_preserved(numbers, "id", numbers.distinct(), "id").first()
    assert (row["before_count"], row["after_count"], row["preserved"]) == (70_050, 70_050, True)
    none = before.limit(0)
    assert quality.distinct_preserved(none, "id", none, "id").first()["preserved"] is False


def test_dense_ids_do_not_travel(spark):
    ids = spark.range(200_000).selectExpr("concat('S', lpad(CAST(id AS STRING), 8, '0')) AS id")
    counted = quality.distinct_preserved(ids, "id", ids, "id")
    assert counted.first()["before_count"] == 200_000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan
