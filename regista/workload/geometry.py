"""Rings, reprojection and features, on vectors read as 32 points in metres."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.functions.scalar import round_places
from regista.operators import geometry
from regista.operators.joins import members_only
from regista.operators.project import where_equals
from regista.sources.tables import publish_mart, read_table, write_parquet_snappy
from regista.workload.registry import Tables, query
from regista.workspace import run_folder

_CODES = (1, 3, 5, 8, 25, 99)


def _shapes(t: Tables) -> DataFrame:
    v = F.transform("embedding", lambda e: e.cast("double"))
    indexed = t.embeddings.select("vec_id", "label", v.alias("v"))
    points = F.transform(
        F.sequence(F.lit(0), (F.array_size("v") / 2).cast("int") - 1),
        lambda i: F.struct(
            (F.lit(430000.0) + F.get("v", i * 2) * F.lit(200000.0)).alias("x"),
            (F.lit(4620000.0) + F.get("v", i * 2 + 1) * F.lit(200000.0)).alias("y"),
        ),
    )
    code = F.element_at(F.array(*map(F.lit, _CODES)), (F.col("vec_id") % len(_CODES) + 1).cast("int"))
    return indexed.select(
        F.col("vec_id").alias("record_no"),
        code.alias("shape_type"),
        F.array(F.lit(0), F.lit(20)).alias("parts"),
        points.alias("points"),
        F.array(*map(F.lit, ("CODICOMAR", "CODIMUNI"))).alias("field_names"),
        F.array(F.col("label").cast("string"), F.col("vec_id").cast("string")).alias("record"),
    )


def _x_sql(i: str) -> str:
    return f"430000.0::DOUBLE + embedding[2 * {i} + 1]::DOUBLE * 200000.0::DOUBLE"


def _y_sql(i: str) -> str:
    return f"4620000.0::DOUBLE + embedding[2 * {i} + 2]::DOUBLE * 200000.0::DOUBLE"


@query(f"""
SELECT vec_id AS record_no, ring, stop - start + 1 AS points,
       {_x_sql("start")} AS first_x, {_y_sql("stop")} AS last_y
FROM embeddings, (VALUES (0, 0, 19), (1, 20, 31)) r(ring, start, stop)""")
def parts_to_rings(t: Tables) -> DataFrame:
    rings = geometry.parts_to_rings(F.col("parts"), F.col("points"))
    return _shapes(t).select("record_no", F.posexplode(rings).alias("ring", "ring_points")).select(
        "record_no", "ring",
        F.array_size("ring_points").alias("points"),
        F.element_at("ring_points", 1)["x"].alias("first_x"),
        F.element_at("ring_points", -1)["y"].alias("last_y"),
    )


@query("""
SELECT vec_id AS record_no,
       CASE vec_id % 6 WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' WHEN 2 THEN 'Polygon'
            WHEN 3 THEN 'MultiPoint' ELSE 'Polygon' END AS geometry_type
FROM embeddings""")
def shape_type_name(t: Tables) -> DataFrame:
    return _shapes(t).select(
        "record_no", geometry.shape_type_name(F.col("shape_type")).alias("geometry_type")
    )


# --- Fixed values: metres of a radian on the grid (UTM scale times the GRS80 rectifying radius), and
# --- the Krüger series for GRS80, written out so that the SQL does not follow the code it checks ---
LONLAT_SQL = f"""metres AS (
  SELECT vec_id, CAST(i AS INTEGER) AS point_no, {_x_sql("i")} AS x, {_y_sql("i")} AS y
  FROM embeddings, generate_series(0, 31) g(i)),
grid AS (
  SELECT *, y / 6364902.16611274::DOUBLE AS xi, (x - 500000.0::DOUBLE) / 6364902.16611274::DOUBLE AS eta
  FROM metres),
straight AS (
  SELECT *,
    xi - 0.000837732168164144::DOUBLE * sin(2.0 * xi) * cosh(2.0 * eta)
       - 5.905869626082731e-08::DOUBLE * sin(4.0 * xi) * cosh(4.0 * eta)
       - 1.6734889049883464e-10::DOUBLE * sin(6.0 * xi) * cosh(6.0 * eta)
       - 2.1677378055967573e-13::DOUBLE * sin(8.0 * xi) * cosh(8.0 * eta) AS xi2,
    eta - 0.000837732168164144::DOUBLE * cos(2.0 * xi) * sinh(2.0 * eta)
        - 5.905869626082731e-08::DOUBLE * cos(4.0 * xi) * sinh(4.0 * eta)
        - 1.6734889049883464e-10::DOUBLE * cos(6.0 * xi) * sinh(6.0 * eta)
        - 2.1677378055967573e-13::DOUBLE * cos(8.0 * xi) * sinh(8.0 * eta) AS eta2
  FROM grid),
sphere AS (
  SELECT *, asin(sin(xi2) / cosh(eta2)) AS chi, atan2(sinh(eta2), cos(xi2)) AS dlon FROM straight),
lonlat AS (
  SELECT vec_id, point_no, round(3.0 + degrees(dlon), 6) AS lon,
    round(degrees(chi + 0.0033565514855966932::DOUBLE * sin(2.0 * chi)
                      + 6.571873148458866e-06::DOUBLE * sin(4.0 * chi)
                      + 1.7646564264542834e-08::DOUBLE * sin(6.0 * chi)
                      + 5.400482187759887e-11::DOUBLE * sin(8.0 * chi)), 6) AS lat
  FROM sphere)"""


@query("WITH " + LONLAT_SQL + "\nSELECT * FROM lonlat")
def reproject_utm(t: Tables) -> DataFrame:
    points = _shapes(t).select(
        F.col("record_no").alias("vec_id"), F.posexplode("points").alias("point_no", "p")
    ).select("vec_id", "point_no", "p.x", "p.y")
    return geometry.reproject_rows(points).select(
        "vec_id", "point_no",
        round_places(F.col("lon"), 6).alias("lon"), round_places(F.col("lat"), 6).alias("lat"),
    )


def _features_sql(field: str, name: str) -> str:
    return f"""WITH {LONLAT_SQL},
paired AS (SELECT vec_id, point_no, '[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']' AS pair FROM lonlat),
rings AS (
  SELECT vec_id, point_no < 20 AS first_ring, '[' || string_agg(pair, ',' ORDER BY point_no) || ']' AS ring
  FROM paired GROUP BY 1, 2),
coordinates AS (
  SELECT vec_id, '[' || string_agg(ring, ',' ORDER BY first_ring DESC) || ']' AS ringed
  FROM rings GROUP BY 1),
shapes AS (
  SELECT e.vec_id, {field} AS code, CAST(row_number() OVER (ORDER BY e.vec_id) - 1 AS VARCHAR) AS id,
         CASE e.vec_id % 6 WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' WHEN 3 THEN 'MultiPoint'
              ELSE 'Polygon' END AS geometry_type,
         CASE e.vec_id % 6 WHEN 0 THEN pair WHEN 1 THEN ringed WHEN 2 THEN ringed WHEN 4 THEN ringed
              ELSE '[]' END AS coordinates
  FROM embeddings e JOIN coordinates c ON c.vec_id = e.vec_id
  JOIN paired p ON p.vec_id = e.vec_id AND p.point_no = 0)
SELECT id, code AS {name}, geometry_type,
       '{{"id":"' || id || '","type":"Feature","properties":{{"{name}":"' || code
       || '"}},"geometry":{{"type":"' || geometry_type || '","coordinates":' || coordinates || '}}}}'
       AS feature
FROM shapes"""


@query(_features_sql("CAST(label AS VARCHAR)", "comarca_id"))
def feature_emit(t: Tables) -> DataFrame:
    return geometry.boundary_features(_shapes(t), "comarques", digits=6)


@query(_features_sql("CAST(e.vec_id AS VARCHAR)", "municipal_id"))
def municipal_features(t: Tables) -> DataFrame:
    return geometry.boundary_features(_shapes(t), "municipis", digits=6)


@query(_features_sql("CAST(e.vec_id AS VARCHAR)", "municipal_id") + """
WHERE municipal_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier
  JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2)""")
def feature_filter(t: Tables) -> DataFrame:
    """The features of the municipalities of one area."""
    features = geometry.boundary_features(_shapes(t), "municipis", digits=6)
    counties = where_equals(t.nation, n_regionkey=2)
    towns = members_only(t.supplier, "s_nationkey", counties, "n_nationkey").select(
        F.col("s_suppkey").cast("string").alias("codi")
    )
    return members_only(features, "municipal_id", towns, "codi")


@query(_features_sql("CAST(label AS VARCHAR)", "comarca_id"))
def boundary_publish(t: Tables) -> DataFrame:
    """C14: features staged as text rows and published unchanged."""
    folder = run_folder(t.spark, "boundaries")
    features = geometry.boundary_features(_shapes(t), "comarques", digits=6)
    write_parquet_snappy(features, f"{folder}/staging")
    publish_mart(t.spark, f"{folder}/staging", f"{folder}/marts")
    return read_table(t.spark, f"{folder}/marts")
