import datetime

import pytest
from pyspark.sql import functions as F

from regista import schemas
from regista.plans import indicators, maps
from regista.plans.marts import capacity_mart
from regista.plans.serving import (
    active_service_panel,
    comarca_coverage,
    comarca_population,
    municipal_coverage,
    serving_tables,
)

D = datetime.date


@pytest.fixture(scope="module")
def staging(spark):
    return spark.createDataFrame([
        ("S1", D(1960, 3, 1), 90, "RES-003", "PUB-001", "m1", "c1"),   # before the calendar
        ("S2", D(1980, 3, 1), 10, "RES-003", "PUB-001", "m1", "c1"),
        ("S3", D(1980, 3, 9), 5, "RES-003", "PUB-001", "m1", "c1"),
        ("S4", D(1980, 7, 1), 1, "RES-003", "PUB-001", "m1", "c1"),
        ("S5", D(1982, 1, 1), 4, "RES-003", "PRV-001", "m1", "c1"),
        ("S6", D(1982, 1, 1), 3, "RES-003", None, "m1", "c1"),         # no qualification
        ("S7", D(1983, 1, 1), 7, "RES-003", "PUB-001", "m2", "c1"),
        ("S8", D(1983, 1, 1), 8, "DAY-001", "PUB-001", "m2", "c1"),
        ("S9", D(1983, 1, 1), 0, "DAY-001", "PUB-001", "m2", "c1"),    # no capacity
        ("S10", D(1983, 1, 1), 9, "BAS-001", "PUB-001", "m2", "c1"),   # not a mart type
        ("S11", D(1984, 1, 1), 6, "RES-003", "PUB-001", None, None),   # place unknown
        ("S12", D(1984, 1, 1), 2, "RES-003", "PUB-001", "m4", "c2"),   # no census
    ], schemas.STAGING_REGISTER)


@pytest.fixture(scope="module")
def municipals(spark):
    return spark.createDataFrame(
        [("m1", "Un", "c1", "Primera"), ("m2", "Dos", "c1", "Primera"),
         ("m3", "Tres", "c2", "Segona"), ("m4", "Quatre", "c2", "Segona")],
        "codi string, nom string, codi_comarca string, nom_comarca string",
    )


@pytest.fixture(scope="module")
def population(spark):
    return spark.createDataFrame([
        ("m1", 100, 1000, 1981), ("m2", 50, 500, 1981), ("m3", 30, 100, 1981),
        ("m1", 200, 1000, 1983), ("m2", None, 500, 1983), ("m3", 40, 100, 1983),
        ("zz", 1, 1, 1983),                                             # not in the catalog
    ], schemas.POPULATION)


@pytest.fixture(scope="module")
def mart(staging):
    return capacity_mart(staging).cache()


def test_mart(mart, rows):
    assert mart.schema.simpleString() == schemas.CAPACITY_MART.simpleString()
    assert rows(mart, "municipal_id", "service_type_id", "service_qualification_id", "year", "month",
                "total_capacit") == [
        ("m1", "RES-003", "PRV-001", 1982, 1, 4),
        ("m1", "RES-003", "PUB-001", 1960, 3, 90),
        ("m1", "RES-003", "PUB-001", 1980, 3, 15),
        ("m1", "RES-003", "PUB-001", 1980, 7, 1),
        ("m1", "RES-003", None, 1982, 1, 3),
        ("m2", "DAY-001", "PUB-001", 1983, 1, 8),
        ("m2", "RES-003", "PUB-001", 1983, 1, 7),
        ("m4", "RES-003", "PUB-001", 1984, 1, 2),
        (None, "RES-003", "PUB-001", 1984, 1, 6),
    ]


def test_active_panel(mart, municipals, rows):
    panel = active_service_panel(mart, municipals, 1975, 1984)
    assert panel.schema["total_capacit"].dataType.simpleString() == "int"
    m1_public = panel.where("municipal_id = 'm1' and service_qualification_id = 'PUB-001'")
    assert rows(m1_public, "year", "total_capacit", "comarca_id") == [
        (1980, 1, "c1"), (1980, 15, "c1"), (1981, 0, "c1"), (1982, 0, "c1"), (1983, 0, "c1"),
        (1984, 0, "c1"),
    ]
    assert panel.where("service_qualification_id is null or municipal_id is null").count() == 0
    assert rows(panel.where("municipal_id = 'm4'"), "year", "total_capacit") == [(1984, 2)]


def test_municipal_coverage(mart, municipals, population, rows):
    out = municipal_coverage(population, mart, municipals, 1975, 1984)
    assert rows(out.where("municipal_id = 'm1'"), "year", "total_capacit", "population_ge65",
                "coverage_ratio") == [
        (1980, 16, None, None), (1981, 16, 100, 16.0), (1982, 23, 100, 23.0), (1983, 23, 200, 11.5),
        (1984, 23, 200, 11.5),
    ]
    # an unknown census value keeps the earlier one
    assert rows(out.where("municipal_id = 'm2'"), "year", "total_capacit", "population_ge65") == [
        (1983, 7, 50), (1984, 7, 50),
    ]
    assert rows(out.where("municipal_id = 'm4'"), "year", "coverage_ratio") == [(1984, None)]
    assert {r["municipal_id"] for r in out.collect()} == {"m1", "m2", "m4"}


def test_county_tables(mart, municipals, population, rows):
    counties = comarca_population(population, municipals)
    assert rows(counties) == [
        ("c1", 150, 1981, 1500, 0.1), ("c1", 200, 1983, 1500, 0.13),
        ("c2", 30, 1981, 100, 0.3), ("c2", 40, 1983, 100, 0.4),
    ]
    cover = comarca_coverage(counties, mart, municipals, 1975, 1984)
    assert rows(cover.where("comarca_id = 'c1'"), "year", "total_capacit", "population_ge65",
                "coverage_ratio") == [
        (1980, 16, None, None), (1981, 16, 150, 10.67), (1982, 23, 150, 15.33),
        (1983, 30, 200, 15.0), (1984, 30, 200, 15.0),
    ]
    accumulated = [r["total_capacit"] for r in cover.where("comarca_id = 'c1'").orderBy("year").collect()]
    assert accumulated == sorted(accumulated)


@pytest.fixture(scope="module")
def tables(mart, municipals, population):
    counties = comarca_population(population, municipals).cache()
    panel = active_service_panel(mart, municipals, 1975, 1984).cache()
    cover = comarca_coverage(counties, mart, municipals, 1975, 1984).cache()
    towns = municipal_coverage(population, mart, municipals, 1975, 1984).cache()
    return counties, panel, cover, towns


def test_headline(tables):
    counties, panel, cover, _ = tables
    row = indicators.headline_indicators(counties, panel, cover).first().asDict()
    assert row == {
        "census_latest_year": 1983, "reference_year": 1983, "coverage_latest_year": 1984,
        "total_population_latest_year": 1600, "elderly_population_latest_year": 240,
        "total_population_reference_year": 1600, "elderly_population_reference_year": 240,
        "residence_places": 16 + 4 + 7 + 2, "latest_elderly_pct": 15.0,
        "latest_elderly_pct_rounded": 15, "reference_elderly_pct": 15.0,
        "residence_coverage_pct": 12.1, "bed_deficit": -19,
        "elderly_thresholds": [8, 10, 12, 14, 16, 18, 20, 22],
        "reference_sign": "", "deficit_label": "Superàvit",
    }


def test_reference_year_prefers_the_earlier_on_a_tie(spark):
    years = spark.createDataFrame([(1998,), (2002,), (2010,)], "year int")
    row = spark.range(1).select(
        indicators.reference_year(years).alias("r"), indicators.latest_year(years).alias("l")
    ).first()
    assert tuple(row) == (1998, 2010)


def test_county_and_town_figures(tables, population, rows):
    counties, _, cover, towns = tables
    assert rows(indicators.county_attention(counties, cover), "comarca_id", "year", "deficit_411") == [
        ("c1", 1983, -22),
    ]
    by_county = indicators.county_indicators(counties, cover)
    assert rows(by_county, "comarca_id", "latest_value", "variation", "population", "coverage_ratio") == [
        ("c1", 13.3, 0.0, 1500, 15.0), ("c2", 40.0, 0.0, 100, None),
    ]
    by_town = indicators.municipal_indicators(population, towns, counties)
    assert rows(by_town, "municipal_id", "population", "elderly_pct", "total_capacit") == [
        ("m1", 1000, 20.0, 23), ("m2", 500, None, 7), ("m3", 100, 40.0, None), ("zz", 1, 100.0, None),
    ]


def test_trends_and_choices(spark, tables, mart, municipals, rows):
    counties, panel, _, _ = tables
    trend = indicators.county_service_trend(panel)
    assert rows(trend.where("service_type_id = 'RES-003' and comarca_id = 'c1'"), "year",
                "accumulated_places") == [(1980, 16), (1981, 16), (1982, 20), (1983, 27), (1984, 27)]
    residence = panel.where("service_type_id = 'RES-003'")
    by_owner = indicators.county_service_trend(residence, "service_qualification_id")
    assert rows(by_owner.where("comarca_id = 'c1' and year = 1984"), "service_qualification_id",
                "accumulated_places") == [("PRV-001", 4), ("PUB-001", 23)]
    assert rows(indicators.county_population_trend(counties, panel), "comarca_id", "year") == [
        ("c1", 1981), ("c1", 1983),
    ]
    types = spark.createDataFrame([("RES-003", "Residence")], "service_type_id string, service_type_description string")
    services = indicators.available_services(mart, municipals, types)
    assert rows(services, "comarca_id", "service_type_id", "service_type_description") == [
        ("c1", "DAY-001", None), ("c1", "RES-003", "Residence"), ("c2", "RES-003", "Residence"),
    ]
    owners = spark.createDataFrame(
        [("PUB-001", "Public"), ("PRV-001", "Private")],
        "service_qualification_id string, service_qualification_description string")
    initiatives = indicators.available_initiatives(mart, municipals, owners)
    assert rows(initiatives, "comarca_id", "service_type_id", "service_qualification_description") == [
        ("c1", "DAY-001", "Public"), ("c1", "RES-003", "Private"), ("c1", "RES-003", "Public"),
        ("c2", "RES-003", "Public"),
    ]
    # the same as what the panel shows, without building it
    shown = panel.where("total_capacit > 0").select("comarca_id", "service_type_id").distinct()
    assert rows(shown) == rows(services, "comarca_id", "service_type_id")
    shown = panel.select("comarca_id", "service_type_id", "service_qualification_id").distinct()
    assert rows(shown) == rows(initiatives, "comarca_id", "service_type_id", "service_qualification_id")


def test_maps(spark, tables, municipals, population, rows):
    counties, panel, cover, towns = tables
    center = F.lit(15)
    features = spark.createDataFrame([("c1",), ("c2",), ("c9",)], "comarca_id string")
    table = maps.county_map(features, indicators.county_indicators(counties, cover), municipals, center)
    assert rows(table, "comarca_id", "label", "elderly_class", "coverage_class", "variation_shown") == [
        ("c1", "Primera", 3, 4, 0), ("c2", "Segona", 8, None, 0), ("c9", None, None, None, None),
    ]
    features = spark.createDataFrame([("m1",), ("m4",)], "municipal_id string")
    by_town = indicators.municipal_indicators(population, towns, counties)
    table = maps.municipal_map(features, by_town, municipals, center)
    assert rows(table, "municipal_id", "label", "elderly_class", "coverage_class") == [
        ("m1", "Un", 7, 4), ("m4", "Quatre", None, None),
    ]


def test_eight_serving_tables(mart, municipals, population, spark):
    empty = spark.createDataFrame([], "id string")
    out = serving_tables(population, mart, municipals, empty, empty)
    assert sorted(out) == [
        "comarca_coverage", "comarca_population", "municipal", "municipal_coverage", "population",
        "service_qualification", "service_type", "social_services_empty_last_year",
    ]
    assert out["population"].dtypes[1:] == [
        ("population_ge65", "int"), ("population", "int"), ("year", "int")]


def test_totals_beyond_32_bits_fail_or_widen(spark, municipals):
    big = spark.createDataFrame([("m1", 1, 3_000_000_000, 1981)], schemas.POPULATION)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        comarca_population(big, municipals).collect()
    assert comarca_population(big, municipals, "bigint").first()["population"] == 3_000_000_000
