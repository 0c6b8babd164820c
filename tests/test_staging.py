import datetime
import json

import pytest
from pyspark.sql import functions as F

from regista import fixed_values, schemas
from regista.operators import quality
from regista.operators.cube import census_rows
from regista.operators.project import clean_register
from regista.plans.staging import build_catalogs, staging_population, staging_register
from regista.sources.catalogs import literal_catalog, read_latest_snapshot
from regista.sources.landing import count_per_file, read_census_cubes, read_landing_json

DAY = "Servei de centre de dia per a gent gran de caràcter temporal o permanent"
ADDICTION = "Servei de centre de dia per a persones amb addiccions"
PUBLIC = "Entitat d'iniciativa pública"
PRIVATE = "Entitat privada d'iniciativa mercantil"

MUNICIPALS = [
    ("080193", "Barcelona", "13", "Barcelonès"),
    ("081691", "Prat de Llobregat, el", "11", "Baix Llobregat"),
    ("080734", "Cornellà de Llobregat", "11", "Baix Llobregat"),
    ("252430", "Vielha e Mijaran", "39", "Aran"),
    ("250250", "Bausen", "39", "Aran"),
]


def record(registre, tipologia, inscripcio, capacitat, municipi, comarca, qualificacio="null", **extra):
    return dict(registre=registre, tipologia=tipologia, inscripcio=inscripcio, capacitat=capacitat,
                municipi=municipi, comarca=comarca, qualificacio=qualificacio, nom="x", cp="08001",
                nif="A0000000", **extra)


PAGE_1 = [
    record("S00000", DAY, "2007-02-07", "35", "Barcelona", "Barcelonès", PRIVATE, districte="7"),
    record("S00001", ADDICTION, "1989-11-22", "7", "El Prat de Llobregat", "Baix Llobregat", PUBLIC),
    record("S00002", DAY, "2005-05-18", "abc", "Vielha", "Val d'Aran"),
]
PAGE_2 = [
    PAGE_1[0],
    record("S00000", DAY, "2007-02-07", "35", "Badalona", "Barcelonès", PRIVATE),
    record("S00003", DAY, "2005-05-18", "12", "Vic", "Osona", PUBLIC),
]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "social_services" / "downloaded_date=20250809"
    folder.mkdir(parents=True)
    (folder / "00000000.json").write_text(json.dumps(PAGE_1, ensure_ascii=False), encoding="utf-8")
    (folder / "00001000.json").write_text(json.dumps(PAGE_2, ensure_ascii=False), encoding="utf-8")
    (folder / "summary.json").write_text('{"registre": "S99999"}')
    return str(tmp_path / "social_services")


@pytest.fixture
def catalogs(spark):
    types = literal_catalog(
        spark, fixed_values.SERVICE_TYPES, "service_type_id", "service_type_description"
    )
    qualifications = literal_catalog(
        spark, fixed_values.SERVICE_QUALIFICATIONS,
        "service_qualification_id", "service_qualification_description",
    )
    municipals = spark.createDataFrame(
        MUNICIPALS, "codi string, nom string, codi_comarca string, nom_comarca string"
    )
    return municipals, types, qualifications


def test_landing_reads_only_numbered_pages(spark, landing, rows):
    raw = read_landing_json(spark, landing)
    assert raw.columns == list(schemas.REGISTER_COLUMNS)
    assert raw.count() == 6
    assert rows(count_per_file(raw)) == [("00000000.json", 3), ("00001000.json", 3)]


def test_register_staging(spark, landing, catalogs, rows):
    staged = staging_register(read_landing_json(spark, landing), *catalogs)
    assert staged.schema.simpleString() == schemas.STAGING_REGISTER.simpleString()
    date = datetime.date
    assert rows(staged) == [
        ("S00000", date(2007, 2, 7), 35, "DAY-001", "PRV-001", "080193", "13"),
        ("S00000", date(2007, 2, 7), 35, "DAY-001", "PRV-001", "080193", "13"),
        ("S00001", date(1989, 11, 22), 7, "DAY-021", "PUB-001", "081691", "11"),
        ("S00002", date(2005, 5, 18), None, "DAY-001", None, "252430", "39"),
        ("S00003", date(2005, 5, 18), 12, "DAY-001", "PUB-001", None, None),
    ]
    quality.require_distinct_preserved(
        read_landing_json(spark, landing), "registre", staged, "social_service_register_id"
    )


def test_unknown_values_stop_the_run(spark, catalogs, rows):
    municipals, types, qualifications = catalogs
    raw = spark.createDataFrame(
        [("S1", "Unknown service", "2020-01-01", "1", "Barcelona", "Barcelonès", "Unknown owner"),
         ("S2", None, "2020-01-01", "1", "Barcelona", "Barcelonès", "null"),
         ("S3", f'"{DAY}"', "2020-01-01", "1", "Barcelona", "Barcelonès", None)],
        schemas.REGISTER_LANDING,
    )
    found = quality.mapping_violations(clean_register(raw), types, qualifications)
    assert rows(found) == [
        ("service_qualification", "Unknown owner"), ("service_type", "Unknown service"),
        ("service_type", None),
    ]
    with pytest.raises(quality.DataQualityError, match="^3 unmapped values"):
        staging_register(raw, municipals, types, qualifications)
    quoted = staging_register(raw.where("registre = 'S3'"), municipals, types, qualifications)
    assert quoted.first()["service_type_id"] == "DAY-001"


def test_bad_date_stops_the_run(spark, catalogs):
    raw = spark.createDataFrame(
        [("S1", DAY, "07/02/2007", "1", "Barcelona", "Barcelonès", None)], schemas.REGISTER_LANDING
    )
    with pytest.raises(Exception, match="not a yyyy-MM-dd date"):
        staging_register(raw, *catalogs).collect()


def test_catalog_snapshots(spark, tmp_path, rows):
    records = spark.createDataFrame(
        [("080193", "Barcelona", "13", "Barcelonès", "x")],
        "codi string, nom string, codi_comarca string, nom_comarca string, other string",
    )
    build_catalogs(records.withColumn("nom", F.lit("old")), str(tmp_path), "20240101_000000", "then")
    build_catalogs(records, str(tmp_path), "20250101_000000", "now")
    latest = read_latest_snapshot(spark, f"{tmp_path}/municipals", schemas.MUNICIPALS)
    assert rows(latest) == [("080193", "Barcelona", "13", "Barcelonès", "now")]
    types = read_latest_snapshot(spark, f"{tmp_path}/service_type", schemas.SERVICE_TYPE)
    assert types.count() == 66
    owners = read_latest_snapshot(
        spark, f"{tmp_path}/service_qualification", schemas.SERVICE_QUALIFICATION
    )
    assert owners.count() == 3


def cube(index, values, years=("2011",), territories=3):
    return {
        "size": [1, territories, 2], "value": values, "label": "ignored",
        "dimension": {
            "YEAR": {"category": {"index": list(years)}}, "MUN": {"category": {"index": index}},
            "AGE": {"category": {"index": ["65", "T"]}},
        },
    }


def test_census_cubes(spark, tmp_path, rows):
    folder = tmp_path / "census"
    folder.mkdir()
    (folder / "2011.json").write_text(json.dumps(cube(["080193", "081691", "T"], [5, 20.9, None, 8, 5, 28])))
    (folder / "2021.json").write_text(json.dumps(
        cube({"T": 2, "081691": 1, "080193": 0}, [6, 21, 3, 9, 9, 30], ["2021"])))
    (folder / "index.json").write_text("{}")
    population = staging_population(read_census_cubes(spark, str(folder)))
    assert population.schema.simpleString() == schemas.POPULATION.simpleString()
    assert rows(population) == [
        ("080193", 5, 20, 2011), ("080193", 6, 21, 2021), ("081691", 3, 9, 2021),
        ("081691", None, 8, 2011),
    ]


@pytest.mark.parametrize("change", [
    {"value": [5, 20, 8]}, {"size": [1, 2, 2]}, {"size": [1, 3, 1], "value": [1, 2, 3]},
    {"value": [1, 2, 3, 4, 5, 6, 7]}, {"size": [1, 3, 3]},
])
def test_cube_of_other_lengths_fails(spark, tmp_path, change):
    path = tmp_path / "2011.json"
    path.write_text(json.dumps({**cube(["080193", "081691", "T"], [5, 20, 3, 8, 5, 28]), **change}))
    with pytest.raises(Exception, match="cube of sizes"):
        census_rows(read_census_cubes(spark, str(path))).collect()


def test_cube_with_a_third_measure(spark, tmp_path, rows):
    path = tmp_path / "2011.json"
    path.write_text(json.dumps({**cube(["080193", "T"], [5, 20, 99, 6, 21, 98], territories=2), "size": [1, 2, 3]}))
    assert rows(census_rows(read_census_cubes(spark, str(path))), "municipal_code", "population_ge65", "population") == [("080193", 5, 20)]


def test_cube_with_two_years_fails(spark, tmp_path):
    path = tmp_path / "2011.json"
    path.write_text(json.dumps(cube(["a", "b", "T"], [1, 2, 3, 4, 5, 6], ["2011", "2021"])))
    cubes = read_census_cubes(spark, str(path))
    assert quality.multi_member_dimensions(cubes).first()["member_count"] == 2
    with pytest.raises(Exception, match="expected one YEAR member, got 2"):
        census_rows(cubes).collect()
