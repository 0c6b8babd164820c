"""Boundary shapes to GeoJSON features."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regista.fixed_values import BOUNDARY_LEVELS, DEFAULT_SHAPE_TYPE, SHAPE_TYPES
from regista.functions.document import zip_fields
from regista.functions.geodesy import STEPS, reproject_points
from regista.functions.scalar import round_places
from regista.workspace import settle

def parts_to_rings(parts: Column, points: Column) -> Column:
    """The flat point array cut at the part offsets; the last part runs to the end."""
    ends = F.concat(F.slice(parts, 2, F.array_size(parts)), F.array(F.array_size(points)))
    return F.transform(
        F.arrays_zip(parts.alias("start"), ends.alias("stop")),
        lambda p: F.slice(points, p["start"] + 1, p["stop"] - p["start"]),
    )


def shape_type_name(code: Column) -> Column:
    """GeoJSON geometry type of a shape code."""
    name = F.lit(DEFAULT_SHAPE_TYPE)
    for geo_type, codes in SHAPE_TYPES.items():
        name = F.when(code.isin(*codes), F.lit(geo_type)).otherwise(name)
    return name


def lonlat_pairs(points: Column, digits: int | None = None) -> Column:
    """Points in metres as array of [lon, lat]; ``digits`` rounds the degrees."""
    def pair(p: Column) -> Column:
        if digits is None:
            return F.array(p["x"], p["y"])
        return F.array(round_places(p["x"], digits), round_places(p["y"], digits))

    return F.transform(reproject_points(points), pair)


def by_geometry(code: Column, rings: Column, point: Column, none: Column) -> Column:
    """``rings`` for polygons and lines, ``point`` for points, ``none`` for every other code."""
    ringed = code.isin(*SHAPE_TYPES["Polygon"], *SHAPE_TYPES["LineString"])
    return F.when(ringed, rings).when(code.isin(*SHAPE_TYPES["Point"]), point).otherwise(none)


def reproject_rows(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """A table of points in metres with ``lon`` and ``lat`` added; all in generated code."""
    out = df.withColumns({"lon": F.col(x), "lat": F.col(y)})
    for step in STEPS:
        a, b = step(F.col("lon"), F.col("lat"))
        out = out.withColumns({"lon": a, "lat": b})
    return out


def numbered_keys(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """(key, name): the integer keys of ``df`` numbered 0, 1, 2, … in their order.

    Only the keys are sorted, by range, and written with the number of their range partition; a
    partition's rows are then numbered by themselves, and the rows before it come from one count
    for each partition. Equal keys are numbered in any order; a NULL key fails the job.
    """
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} is NULL")).cast("bigint")).otherwise(F.col(key))
    ranged = settle(
        df.select(checked.alias("__key")).repartitionByRange("__key").select(
            "__key", F.spark_partition_id().alias("__range"))
    )
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy("__key"))
    return ranged.withColumn("__row", inside).join(offsets, "__range").select(
        "__key", (F.col("__before") + F.col("__row") - 1).alias(name)
    )


def running_id(df: DataFrame, record_no: str, name: str = "id") -> DataFrame:
    """0, 1, 2, … in the order of the unique integer ``record_no``, as one global sequence.

    The rows themselves move once, to meet their number by ``record_no``. NULL or repeated record
    numbers fail the job.
    """
    numbers = numbered_keys(df, record_no, name)
    once = numbers.groupBy("__key").agg(F.min(name).alias(name), F.count("*").alias("__times"))
    repeated = F.raise_error(F.concat(F.lit(f"{record_no} is repeated: "), F.col("__key").cast("string"))).cast("bigint")
    single = once.select("__key", F.when(F.col("__times") == 1, F.col(name)).otherwise(repeated).alias(name))
    return df.join(single, F.col(record_no) == F.col("__key")).drop("__key")


def boundary_features(shapes: DataFrame, level: str, digits: int | None = None) -> DataFrame:
    """Shape records to features: (id, <id property>, geometry_type, feature).

    ``level`` selects which source field becomes the one property. ``feature`` is the GeoJSON
    text; its coordinates are a list of rings for polygons and lines, one pair for points and an
    empty list otherwise.
    """
    field, name = BOUNDARY_LEVELS[level]
    code = F.col("shape_type")
    numbered = running_id(shapes, "record_no").select(
        F.col("id").cast("string").alias("id"),
        zip_fields(F.col("field_names"), F.col("record"))[field].alias(name),
        code,
        shape_type_name(code).alias("geometry_type"),
        "parts",
        lonlat_pairs(F.col("points"), digits).alias("pairs"),
    )

    def feature(coordinates: Column) -> Column:
        return F.to_json(F.struct(
            "id",
            F.lit("Feature").alias("type"),
            F.struct(name).alias("properties"),
            F.struct(F.col("geometry_type").alias("type"), coordinates.alias("coordinates"))
            .alias("geometry"),
        ), {"ignoreNullFields": "false"})

    text = by_geometry(
        code,
        feature(parts_to_rings(F.col("parts"), F.col("pairs"))),
        feature(F.get("pairs", F.lit(0))),
        feature(F.array().cast("array<double>")),
    )
    return numbered.select("id", name, "geometry_type", text.alias("feature"))
