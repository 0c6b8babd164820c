import json

import pytest

from regista import schemas
from regista.operators.quality import DataQualityError
from regista.plans import jobs
from regista.plans.staging import build_catalogs
from regista.sources.tables import SERVING_ORDER, in_serving_order, read_serving_json, read_table

RESIDENCE = "Servei de residència assistida per a gent gran de caràcter temporal o permanent"
PUBLIC = "Entitat d'iniciativa pública"


def land(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(content, ensure_ascii=False), encoding="utf-8")


def record(registre, inscripcio, capacitat, municipi, comarca):
    return {"registre": registre, "tipologia": RESIDENCE, "inscripcio": inscripcio,
            "capacitat": capacitat, "municipi": municipi, "comarca": comarca, "qualificacio": PUBLIC}


def test_landing_to_serving(spark, tmp_path, rows):
    base, catalogs = str(tmp_path / "data"), str(tmp_path / "catalogs")
    landing = tmp_path / "data" / "landing"
    records = spark.createDataFrame(
        [("080193", "Barcelona", "13", "Barcelonès"), ("252430", "Vielha e Mijaran", "39", "Aran")],
        "codi string, nom string, codi_comarca string, nom_comarca string",
    )
    build_catalogs(records, catalogs, "20250809_000000")

    with pytest.raises(Exception):
        jobs.stage_register(spark, base, catalogs, "20250801")
    for date, page in (
        ("20250801", [record("S00001", "2010-01-01", "10", "Barcelona", "Barcelonès")]),
        ("20250808", [record("S00001", "2010-01-01", "10", "Barcelona", "Barcelonès"),
                      record("S00001", "2010-01-01", "10", "Barcelona", "Barcelonès"),
                      record("S00002", "2012-06-01", "5", "Barcelona", "Barcelonès"),
                      record("S00003", "2012-06-01", "4", "Vielha", "Val d'Aran")]),
    ):
        land(landing / jobs.REGISTER / f"downloaded_date={date}", "00000000.json", page)
        jobs.stage_register(spark, base, catalogs, date)
        jobs.stage_register(spark, base, catalogs, date)
    staged = read_table(spark, f"{base}/staging/{jobs.REGISTER}")
    assert staged.groupBy("downloaded_date").count().count() == 2
    assert staged.count() == 4

    jobs.build_capacity_mart(spark, base, "20250808")
    assert rows(read_table(spark, f"{base}/marts/{jobs.CAPACITY}"), "municipal_id", "year", "total_capacit") == [
        ("080193", 2010, 10), ("080193", 2012, 5), ("252430", 2012, 4),
    ]

    for year, old in (("2011", 100), ("2021", 200)):
        land(landing / jobs.CENSUS, f"{year}.json", {
            "size": [1, 3, 2], "value": [old, 1000, 10, 50, old + 10, 1050],
            "dimension": {"YEAR": {"category": {"index": [year]}},
                          "MUN": {"category": {"index": ["080193", "252430", "T"]}}},
        })
    jobs.build_population(spark, base)
    assert read_table(spark, f"{base}/marts/{jobs.CENSUS}").count() == 4

    audit = spark.read.parquet(f"{base}/audit").orderBy("processed_at")
    assert [tuple(r) for r in audit.select("dataset", "row_count").collect()] == [
        (f"{jobs.REGISTER}/20250801", 1), (f"{jobs.REGISTER}/20250801", 1),
        (f"{jobs.REGISTER}/20250808", 3), (f"{jobs.REGISTER}/20250808", 3),
        (jobs.CAPACITY, 3), (jobs.CENSUS, 4),
    ]

    jobs.build_serving(spark, base, catalogs)
    cover = read_serving_json(spark, f"{base}/serving", "comarca_coverage")
    assert rows(cover.where("year in (2010, 2011, 2012, 2025)"), "comarca_id", "year", "coverage_ratio") == [
        ("13", 2010, None), ("13", 2011, 10.0), ("13", 2012, 15.0), ("13", 2025, 7.5),
        ("39", 2012, 40.0), ("39", 2025, 40.0),
    ]
    served = read_serving_json(spark, f"{base}/serving", "municipal", schemas.MUNICIPALS)
    assert rows(served, "codi", "nom") == [("080193", "Barcelona"), ("252430", "Vielha e Mijaran")]
    panel = read_serving_json(spark, f"{base}/serving", "social_services_empty_last_year")
    order = SERVING_ORDER["social_services_empty_last_year"]
    in_order = [tuple(r[c] for c in order)
                for r in in_serving_order("social_services_empty_last_year", panel).collect()]
    assert in_order == sorted(in_order) and len(in_order) == 16 + 14


def test_empty_landing_folder_stops_the_job(spark, tmp_path):
    folder = tmp_path / "landing" / jobs.REGISTER / "downloaded_date=20250801"
    land(folder, "notes.json", [])
    with pytest.raises(DataQualityError, match="has no rows"):
        jobs.stage_register(spark, str(tmp_path), "unused", "20250801")


def test_boundaries(spark, tmp_path, rows):
    shapes = spark.createDataFrame(
        [(0, 1, [0], [(500000.0, 0.0)], ["CODICOMAR", "CODIMUNI"], ["13", "080193"])], schemas.SHAPES
    )
    jobs.build_boundaries({"comarques": shapes, "municipis": shapes}, str(tmp_path))
    for level, name, value in (("comarques", "comarca_id", "13"), ("municipis", "municipal_id", "080193")):
        out = read_table(spark, f"{tmp_path}/marts/{jobs.BOUNDARIES}/{level}")
        assert json.loads(out.first()["feature"]) == {
            "id": "0", "type": "Feature", "properties": {name: value},
            "geometry": {"type": "Point", "coordinates": [3.0, 0.0]},
        }
    with pytest.raises(ValueError):
        jobs.build_boundaries({"vegueries": shapes}, str(tmp_path))


def test_a_failed_check_leaves_the_old_partition(spark, tmp_path, rows, monkeypatch):
    base, catalogs = str(tmp_path / "data"), str(tmp_path / "catalogs")
    records = spark.createDataFrame(
        [("080193", "Barcelona", "13", "Barcelonès")], "codi string, nom string, codi_comarca string, nom_comarca string")
    build_catalogs(records, catalogs, "20250809_000000")
    folder = tmp_path / "data" / "landing" / jobs.REGISTER / "downloaded_date=20250801"
    land(folder, "00000000.json", [record("S00001", "2010-01-01", "10", "Barcelona", "Barcelonès")])
    jobs.stage_register(spark, base, catalogs, "20250801")
    target = f"{base}/staging/{jobs.REGISTER}"
    before = rows(read_table(spark, target))
    land(folder, "00001000.json", [record("S00002", "2011-01-01", "20", "Barcelona", "Barcelonès")])
    whole = jobs.staging_register
    monkeypatch.setattr(jobs, "staging_register", lambda *args: whole(*args).where("capacity < 15"))
    with pytest.raises(DataQualityError, match="distinct ids before 2, after 1"):
        jobs.stage_register(spark, base, catalogs, "20250801")
    assert rows(read_table(spark, target)) == before
    monkeypatch.undo()
    land(folder, "00002000.json", [{**record("S00003", "2011-01-01", "20", "Barcelona", "Barcelonès"), "tipologia": f"unknown {i}"}
                                   for i in range(30)])
    with pytest.raises(DataQualityError, match="30 unmapped values, all of them in") as error:
        jobs.stage_register(spark, base, catalogs, "20250801")
    path = str(error.value).split("all of them in ")[1].split(": (")[0]
    assert spark.read.parquet(path).count() == 30
    assert rows(read_table(spark, target)) == before


def test_announced_years_must_land(spark, tmp_path):
    land(tmp_path / "landing" / jobs.CENSUS, "2011.json", {
        "size": [1, 2, 2], "value": [1, 10, 1, 10],
        "dimension": {"YEAR": {"category": {"index": ["2011"]}}, "MUN": {"category": {"index": ["080193", "T"]}}}})
    jobs.build_population(spark, str(tmp_path), announced=[2011])
    with pytest.raises(DataQualityError, match="1 values of year did not land, 2021 to 2021"):
        jobs.build_population(spark, str(tmp_path), announced=[2011, 2021])
    assert read_table(spark, f"{tmp_path}/marts/{jobs.CENSUS}").count() == 1


def test_empty_catalog_stops_before_any_snapshot(spark, tmp_path):
    records = spark.createDataFrame([], "codi string, nom string, codi_comarca string, nom_comarca string")
    with pytest.raises(DataQualityError, match="catalog municipals has no rows"):
        build_catalogs(records, str(tmp_path / "catalogs"), "20250809_000000")
    assert not (tmp_path / "catalogs").exists()


def test_years_outside_the_calendar(spark, tmp_path, rows):
    base, catalogs = str(tmp_path / "data"), str(tmp_path / "catalogs")
    records = spark.createDataFrame(
        [("080193", "Barcelona", "13", "Barcelonès")], "codi string, nom string, codi_comarca string, nom_comarca string")
    build_catalogs(records, catalogs, "20250809_000000")
    mart = [("PUB-001", "RES-003", "13", "080193", y, 1, n) for y, n in ((1970, 4), (2000, 2), (2026, 7))]
    spark.createDataFrame(mart, schemas.CAPACITY_MART).write.parquet(f"{base}/marts/{jobs.CAPACITY}")
    spark.createDataFrame([("080193", 100, 1000, 2001)], schemas.POPULATION).write.parquet(f"{base}/marts/{jobs.CENSUS}")
    jobs.build_serving(spark, base, catalogs, measure_type="bigint")
    cover = read_serving_json(spark, f"{base}/serving", "municipal_coverage")
    assert rows(cover.where("year in (2000, 2025, 2026)"), "year", "total_capacit") == [(2000, 2), (2025, 2), (2026, 9)]
    outside = spark.read.parquet(f"{base}/audit_outside_calendar")
    assert rows(outside, "dataset", "year", "row_count") == [("mart", 1970, 1)]
    jobs.build_serving(spark, base, catalogs, first=1970, last=2026)
    cover = read_serving_json(spark, f"{base}/serving", "municipal_coverage")
    assert rows(cover.where("year in (1970, 2026)"), "year", "total_capacit") == [(1970, 4), (2026, 13)]
    assert spark.read.parquet(f"{base}/audit_outside_calendar").count() == 1


def test_jobs_leave_no_settled_table(spark, tmp_path):
    from regista.workspace import scratch, settle

    with scratch(spark):
        kept = settle(spark.range(3))
        path = kept.inputFiles()[0]
    import os
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
