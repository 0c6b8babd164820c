import json
import math

import pytest
from pyspark.sql import functions as F

from regista import schemas
from regista.functions import geodesy
from regista.operators import geometry

N = geodesy.FLATTENING / (2 - geodesy.FLATTENING)
ALPHA = (
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140,
    49561 * N**4 / 161280,
)


def forward(lon, lat):
    """Degrees to metres by the forward series, independent of the code under test."""
    phi, lam = math.radians(lat), math.radians(lon - geodesy.CENTRAL_MERIDIAN)
    e = math.sqrt(geodesy.FLATTENING * (2 - geodesy.FLATTENING))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi0, eta0 = math.atan2(t, math.cos(lam)), math.asinh(math.sin(lam) / math.hypot(t, math.cos(lam)))
    xi = xi0 + sum(a * math.sin(2 * j * xi0) * math.cosh(2 * j * eta0) for j, a in enumerate(ALPHA, 1))
    eta = eta0 + sum(a * math.cos(2 * j * xi0) * math.sinh(2 * j * eta0) for j, a in enumerate(ALPHA, 1))
    k = geodesy.SCALE_FACTOR * geodesy.RECTIFYING_RADIUS
    return geodesy.FALSE_EASTING + k * eta, k * xi


def test_round_trip_over_the_region(spark):
    degrees = [(0.1 + 0.33 * i, 40.4 + 0.25 * j) for i in range(11) for j in range(11)]
    metres = [(*forward(*d), *d) for d in degrees]
    df = spark.createDataFrame(metres, "x double, y double, lon0 double, lat0 double")
    error = geometry.reproject_rows(df).select(
        F.max(F.abs(F.col("lon") - F.col("lon0"))).alias("lon"),
        F.max(F.abs(F.col("lat") - F.col("lat0"))).alias("lat"),
    ).first()
    assert error["lon"] < 1e-9 and error["lat"] < 1e-9
    nested = df.select(geodesy.reproject_point(F.col("x"), F.col("y")).alias("p"), "lon0", "lat0")
    assert nested.where((F.abs(F.col("p.x") - F.col("lon0")) > 1e-9)
                        | (F.abs(F.col("p.y") - F.col("lat0")) > 1e-9)).count() == 0


def test_origin_of_the_zone(spark):
    p = spark.range(1).select(geodesy.reproject_point(F.lit(500000.0), F.lit(0.0)).alias("p")).first()["p"]
    assert (p["x"], p["y"]) == (3.0, 0.0)


@pytest.mark.parametrize("code, name", [
    (1, "Point"), (11, "Point"), (21, "Point"), (3, "LineString"), (13, "LineString"),
    (23, "LineString"), (5, "Polygon"), (15, "Polygon"), (25, "Polygon"), (8, "MultiPoint"),
    (999, "Polygon"), (None, "Polygon"),
])
def test_shape_type_names(spark, code, name):
    df = spark.createDataFrame([(code,)], "code int")
    assert df.select(geometry.shape_type_name(F.col("code"))).first()[0] == name


def shapes(spark, *records):
    return spark.createDataFrame(list(records), schemas.SHAPES)


FIELDS = ["CODICOMAR", "NOMCOMAR", "CODIMUNI"]


def test_rings_are_cut_at_the_parts(spark):
    points = [(float(i), float(i)) for i in range(7)]
    df = shapes(spark, (0, 5, [0, 5], points, FIELDS, ["01", "n", "m"]),
                (1, 5, [0], points, FIELDS, ["01", "n", "m"]))
    rings = [r[0] for r in df.orderBy("record_no").select(
        geometry.parts_to_rings(F.col("parts"), F.col("points"))).collect()]
    assert [len(r) for r in rings[0]] == [5, 2]
    assert [tuple(p) for p in rings[0][1]] == [(5.0, 5.0), (6.0, 6.0)]
    assert [len(r) for r in rings[1]] == [7]


def test_features(spark):
    ring = [forward(2.0, 41.0), forward(2.1, 41.0), forward(2.0, 41.1)]
    df = shapes(
        spark,
        (40, 5, [0], ring, FIELDS, ["01", "A", "080193"]),
        (7, 3, [0, 2], ring, FIELDS, ["02", "B", "081691"]),
        (90000, 1, [0], ring[:1], FIELDS, ["03", "C", "252430"]),
        (90001, 8, [0], ring, FIELDS, ["04", "D", "250250"]),
    )
    got = {r["comarca_id"]: json.loads(r["feature"])
           for r in geometry.boundary_features(df, "comarques", digits=6).collect()}
    assert [got[c]["id"] for c in ("02", "01", "03", "04")] == ["0", "1", "2", "3"]
    assert got["01"] == {
        "id": "1", "type": "Feature", "properties": {"comarca_id": "01"},
        "geometry": {"type": "Polygon",
                     "coordinates": [[[2.0, 41.0], [2.1, 41.0], [2.0, 41.1]]]},
    }
    assert got["02"]["geometry"] == {
        "type": "LineString", "coordinates": [[[2.0, 41.0], [2.1, 41.0]], [[2.0, 41.1]]]}
    assert got["03"]["geometry"] == {"type": "Point", "coordinates": [2.0, 41.0]}
    assert got["04"]["geometry"] == {"type": "MultiPoint", "coordinates": []}
    towns = geometry.boundary_features(df, "municipis").collect()
    assert sorted(r["municipal_id"] for r in towns) == ["080193", "081691", "250250", "252430"]


def test_running_id_over_many_blocks(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "record_no")
    out = geometry.running_id(df, "record_no")
    assert out.where(F.col("id") != F.col("record_no") / 3).count() == 0
    assert out.count() == 1000


def test_running_id_over_sparse_numbers(spark, monkeypatch):
    """Numbers all over 64 bits: what goes through the one window stays as small as the partitions are few."""
    written = []
    settle = geometry.settle
    monkeypatch.setattr(geometry, "settle", lambda df: written.append(settle(df)) or written[-1])
    df = spark.range(20000).select(F.xxhash64("id").alias("record_no"), F.lit("x").alias("wide"))
    out = geometry.running_id(df, "record_no").orderBy("record_no").collect()
    assert [r["id"] for r in out] == list(range(20000))
    assert written[0].columns == ["__key", "__range"]
    assert written[0].select("__range").distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("numbers, message", [([1, None, 2], "record_no is NULL"), ([1, 2, 2], "record_no is repeated: 2")])
def test_running_id_loses_no_row(spark, numbers, message):
    df = spark.createDataFrame([(n,) for n in numbers], "record_no bigint")
    with pytest.raises(Exception, match=message):
        geometry.running_id(df, "record_no").collect()


def snyder(x, y):
    """Metres to degrees by the footpoint series of the US Geological Survey's manual, with GRS80 written out."""
    a, e2, k0 = 6378137.0, 0.00669438002290, 0.9996
    ep2, m = e2 / (1 - e2), y / k0
    mu = m / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    p = (mu + (3 * e1 / 2 - 27 * e1**3 / 32) * math.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * math.sin(4 * mu)
         + 151 * e1**3 / 96 * math.sin(6 * mu) + 1097 * e1**4 / 512 * math.sin(8 * mu))
    c, t = ep2 * math.cos(p)**2, math.tan(p)**2
    n, r = a / math.sqrt(1 - e2 * math.sin(p)**2), a * (1 - e2) / (1 - e2 * math.sin(p)**2)**1.5
    d = (x - 500000.0) / (n * k0)
    lat = p - n * math.tan(p) / r * (
        d**2 / 2 - (5 + 3 * t + 10 * c - 4 * c**2 - 9 * ep2) * d**4 / 24
        + (61 + 90 * t + 298 * c + 45 * t**2 - 252 * ep2 - 3 * c**2) * d**6 / 720)
    lon = (d - (1 + 2 * t + c) * d**3 / 6
           + (5 - 2 * c + 28 * t - 3 * c**2 + 8 * ep2 + 24 * t**2) * d**5 / 120) / math.cos(p)
    return 3.0 + math.degrees(lon), math.degrees(lat)


def test_agrees_with_another_method(spark):
    points = [(260000.0 + 27000 * i, 4480000.0 + 27000 * j) for i in range(11) for j in range(11)]
    df = spark.createDataFrame([(*p, *snyder(*p)) for p in points], "x double, y double, lon0 double, lat0 double")
    error = geometry.reproject_rows(df).select(
        F.max(F.abs(F.col("lon") - F.col("lon0"))).alias("lon"), F.max(F.abs(F.col("lat") - F.col("lat0"))).alias("lat")).first()
    assert error["lon"] < 1e-7 and error["lat"] < 1e-7


def test_published_lengths_of_the_meridian(spark):
    """GRS80: 10,001,965.729 m from the equator to the pole, 4,984,944.378 m to 45 degrees."""
    rows = [(500000.0, 0.9996 * 10001965.7293, 90.0), (500000.0, 0.9996 * 4984944.378, 45.0)]
    df = spark.createDataFrame(rows, "x double, y double, lat0 double")
    for r in geometry.reproject_rows(df).collect():
        assert abs(r["lat"] - r["lat0"]) < 2e-8
