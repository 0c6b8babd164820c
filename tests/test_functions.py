import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from regista.functions import document, scalar, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())
    df = spark.createDataFrame([tuple(values.values()) or (None,)], schema or "x string")
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, expected", [
    ("Prat de Llobregat, el", ["prat", "de", "llobregat", "el"]),
    ("L'Ametlla de Mar", ["ametlla", "de", "mar"]),
    ("Sant Julià del Llor i Bonmatí", ["sant", "julia", "del", "llor", "bonmati"]),
    ("Barcelona 08001", ["barcelona"]),
    ("ç a Ï", ["ç", "ï"]),
    ("Vallès · Oriental", ["valles", "oriental"]),
    ("col·lectiu", ["col", "lectiu"]),
    ("a b c", []),
    ("a b cd e", ["cd"]),
    ("  Lleida\tcapital\n", ["lleida", "capital"]),
    ("Besalú-Ñuño", ["besalu", "ñuño"]),
    ("ÀÉÍÒÚ Büch", ["aeiou", "büch"]),
    ("", []),
    ("123 ...", []),
])
def test_name_tokens(spark, raw, expected):
    assert one(spark, text.name_tokens(F.col("s")), s=raw) == expected
    assert one(spark, text.normalize_name(F.col("s")), s=raw) == " ".join(expected)


def test_null_names(spark):
    df = spark.createDataFrame([(None, "Reus")], "a string, b string")
    row = df.select(
        text.name_tokens(F.col("a")).alias("tokens"),
        text.token_key(F.col("a")).alias("key"),
        text.token_similarity(F.col("a"), F.col("b")).alias("shared"),
    ).first()
    assert tuple(row) == (None, "", 0)


def test_token_similarity_counts_a_set(spark):
    shared = text.token_similarity(F.col("a"), F.col("b"))
    assert one(spark, shared, a="Sant Sant Pere", b="Sant Pere Sant") == 2
    assert one(spark, shared, a="Reus", b="Lleida") == 0


def test_token_key_ignores_order_and_repeats(spark):
    key = text.token_key(F.col("s"))
    assert one(spark, key, s="Prat de Llobregat, el") == one(spark, key, s="El Prat de Llobregat el")


def test_null_text_and_recode(spark):
    assert one(spark, scalar.null_text_to_null(F.col("s")), s="null") is None
    assert one(spark, scalar.null_text_to_null(F.col("s")), s="nulls") == "nulls"
    recode = scalar.recode_value(F.col("s"), {"Val d'Aran": "Aran"})
    assert one(spark, recode, s="Val d'Aran") == "Aran"
    assert one(spark, recode, s="Osona") == "Osona"
    assert one(spark, recode, s=None) is None
    assert one(spark, text.strip_quotes(F.col("s")), s='"a"b') == "ab"


def test_dates(spark):
    strict = scalar.parse_date_strict(F.col("s"))
    assert one(spark, strict, s="2007-02-07") == datetime.date(2007, 2, 7)
    assert one(spark, strict, s=None) is None
    with pytest.raises(Exception, match="not a yyyy-MM-dd date: 07/02/2007"):
        one(spark, strict, s="07/02/2007")
    assert one(spark, scalar.parse_date_lenient(F.col("s")), s="2007-02-31") is None


def test_casts(spark):
    assert one(spark, scalar.int_lenient(F.col("s")), s="35") == 35
    assert one(spark, scalar.int_lenient(F.col("s")), s="abc") is None
    assert one(spark, scalar.int_lenient(F.col("s")), s="99999999999") is None
    assert one(spark, scalar.trunc_to_long(F.col("x")), x=-2.9) == -2
    assert one(spark, scalar.trunc_to_long(F.col("x")), x=2.9) == 2


@pytest.mark.parametrize("x, expected", [(2.5, 3), (-2.5, -2), (-2.51, -3), (0.49, 0)])
def test_round_half_up(spark, x, expected):
    assert one(spark, scalar.round_half_up(F.col("x")), x=x) == expected


@pytest.mark.parametrize("x, expected", [(1.005, 1.0), (0.125, 0.13), (-0.125, -0.13), (2.0, 2.0)])
def test_round_places(spark, x, expected):
    assert one(spark, scalar.round_places(F.col("x"), 2), x=x) == expected


def test_ratios_with_zero(spark):
    assert one(spark, scalar.percent_ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None
    assert one(spark, scalar.percent_ratio(F.col("a"), F.col("b")), a=1.0, b=3.0) == 33.33
    assert one(spark, scalar.one_decimal_percent(F.col("a"), F.col("b")), a=1.0, b=8.0) == 12.5
    assert one(spark, scalar.one_decimal_percent(F.col("a"), F.col("b")), a=1.0, b=0.0) is None


def test_deficit_and_sign(spark):
    assert one(spark, scalar.bed_deficit(F.col("a"), F.col("b")), a=1000.0, b=30.0) == 11
    label = scalar.deficit_label(F.col("x"))
    assert [one(spark, label, x=v) for v in (1.0, 0.0, -1.0)] == ["Dèficit", "Superàvit", "Superàvit"]
    assert one(spark, scalar.plus_sign(F.col("a"), F.col("b")), a=2.0, b=1.0) == "+"
    assert one(spark, scalar.plus_sign(F.col("a"), F.col("b")), a=1.0, b=1.0) == ""


@pytest.mark.parametrize("x, expected", [(2.9, 0), (3.0, 1), (4.11, 2), (6.0, 3), (7.0, 4)])
def test_threshold_class(spark, x, expected):
    assert one(spark, scalar.threshold_class(F.col("x"), (3, 4.11, 5, 7)), x=x) == expected


def test_threshold_class_of_null_and_limits_around(spark):
    df = spark.createDataFrame([(None, 18)], "x double, c bigint")
    limits = scalar.thresholds_around(F.col("c"))
    row = df.select(
        scalar.threshold_class(F.col("x"), limits).alias("unknown"), F.array(*limits).alias("limits")
    ).first()
    assert row["unknown"] is None
    assert row["limits"] == [11, 13, 15, 17, 19, 21, 23, 25]


def test_documents(spark):
    assert one(spark, document.json_path(F.col("s"), "$.a.b", "int"), s='{"a": {"b": 7}}') == 7
    assert one(spark, document.json_path(F.col("s"), "$.a", "int"), s='{"a": null}') is None
    assert one(spark, document.json_path(F.col("s"), "$.a", "int"), s='{}') is None
    assert one(spark, document.json_path(F.col("s"), "$.a", "double"), s='{"a": 1.5}') == 1.5
    assert one(spark, document.json_path(F.col("s"), "$.a", "double"), s='{"a": 2}') == 2.0
    assert one(spark, document.json_path(F.col("s"), "$.a"), s='{"a": "x"}') == "x"
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for value, kind in (('"x"', "int"), ('"5"', "int"), ("[1]", "string"), ("5", "string"), ("1.5", "int"), ("true", "int")):
                with pytest.raises(Exception, match=f"is no {kind}"):
                    one(spark, document.json_path(F.col("s"), "$.a", kind), s=f'{{"a": {value}}}')
            with pytest.raises(Exception):
                one(spark, document.json_path(F.col("s"), "$.a", "int"), s="no json")
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
    assert one(spark, document.member_codes(F.col("s")), s='["b", "a"]') == ["b", "a"]
    assert one(spark, document.member_codes(F.col("s")), s='{"a": 1, "b": 0}') == ["b", "a"]
    assert one(spark, document.array_product(F.array(F.lit(2), F.lit(3), F.lit(5)))) == 30
    values = F.array(*[F.lit(i) for i in (10, 11, 20, 21)])
    assert one(spark, document.stride_pick(values, 2, 1)) == [11, 21]
    for offset, name in ((0, "00000000"), (2000, "00002000"), (99999000, "99999000"), (100000000, "100000000"),
                         (123456000, "123456000"), (1234567000, "1234567000")):
        assert one(spark, document.page_file_name(F.lit(offset))) == f"{name}.json"
    path = document.switch_layer(F.lit("landing/x/landing.json"), "landing", "staging")
    assert one(spark, path) == "staging/x/landing.json"
    zipped = document.zip_fields(F.array(F.lit("A"), F.lit("B")), F.array(F.lit("1"), F.lit("2")))
    assert one(spark, zipped) == {"A": "1", "B": "2"}


@pytest.mark.parametrize("raw", ["2007", "2007-02", "2007-2-7", " 2007-02-07", "2007-02-07x", "2007-02-07\n", "", "abc"])
def test_other_date_texts_are_null(spark, raw):
    assert one(spark, scalar.parse_date_lenient(F.col("s")), s=raw) is None


def plain_tokens(text_value):
    folds = str.maketrans("áàéèíìóòúù", "aaeeiioouu")
    letters = "".join(c if c.isalpha() else " " for c in text_value.lower().translate(folds))
    return [t for t in letters.split() if len(t.encode()) > 1]


def test_normalisation_of_random_texts(spark):
    rng = random.Random(7)
    alphabet = "aabbcdeéèàÀÉçÇïüñzZ  ..,'·-\t\n 0179ßжЖ中ª"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(
        "s", text.normalize_name(F.col("s")).alias("n"), text.name_tokens(F.col("s")).alias("t")
    )
    for row in df.collect():
        expected = plain_tokens(row["s"])
        assert row["t"] == expected, repr(row["s"])
        assert row["n"] == " ".join(expected)


@pytest.mark.parametrize("value", [9.3e16, 1e17, 1e18, -1e18, 2.0**53, 1e300, float("inf"), float("-inf")])
def test_large_values_are_not_rounded_away(spark, value):
    assert one(spark, scalar.round_places(F.lit(value))) == value
    assert one(spark, scalar.percent_ratio(F.lit(value / 100), F.lit(1))) == value / 100 * 100.0
    assert one(spark, scalar.one_decimal_percent(F.lit(value), F.lit(1000))) == value * 1000.0 / 1000.0 / 10.0


def test_values_without_a_rounding(spark):
    assert math.isnan(one(spark, scalar.round_places(F.lit(float("nan")))))
    assert one(spark, scalar.round_places(F.lit(None).cast("double"))) is None
    assert one(spark, scalar.round_half_up(F.lit(None).cast("double"))) is None
    assert one(spark, scalar.round_half_up(F.lit(float(2**60 + 2**10)))) == 2**60 + 2**10
    for value in (1e19, float("inf"), float("nan")):
        with pytest.raises(Exception, match="no 64-bit integer"):
            one(spark, scalar.round_half_up(F.lit(value)))
