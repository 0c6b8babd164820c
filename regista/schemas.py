"""Explicit schemas: every reader names its columns, nothing is inferred."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


#: the register columns that are used; every landing value is text
REGISTER_COLUMNS = (
    "registre", "tipologia", "inscripcio", "capacitat", "municipi", "comarca", "qualificacio",
)
REGISTER_LANDING = T.StructType(_strings(*REGISTER_COLUMNS))

MUNICIPALS = T.StructType(_strings("codi", "nom", "codi_comarca", "nom_comarca", "created_at"))
SERVICE_TYPE = T.StructType(
    _strings("service_type_id", "service_type_description", "created_at")
)
SERVICE_QUALIFICATION = T.StructType(
    _strings("service_qualification_id", "service_qualification_description", "created_at")
)

#: ``index`` is kept as raw JSON text: it may be an array of codes or a code -> position object
_MEMBERS = T.StructType(
    [T.StructField("category", T.StructType([T.StructField("index", T.StringType())]))]
)
CENSUS_CUBE = T.StructType([
    T.StructField("size", T.ArrayType(T.LongType())),
    T.StructField("dimension", T.StructType([
        T.StructField("YEAR", _MEMBERS),
        T.StructField("MUN", _MEMBERS),
    ])),
    T.StructField("value", T.ArrayType(T.DoubleType())),
])

STAGING_REGISTER = T.StructType([
    T.StructField("social_service_register_id", T.StringType()),
    T.StructField("inscription_date", T.DateType()),
    T.StructField("capacity", T.IntegerType()),
    *_strings("service_type_id", "service_qualification_id", "municipal_id", "comarca_id"),
])

POPULATION = T.StructType([
    T.StructField("municipal_code", T.StringType()),
    T.StructField("population_ge65", T.LongType()),
    T.StructField("population", T.LongType()),
    T.StructField("year", T.LongType()),
])

CAPACITY_MART = T.StructType([
    *_strings("service_qualification_id", "service_type_id", "comarca_id", "municipal_id"),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("total_capacit", T.LongType()),
])

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
SHAPES = T.StructType([
    T.StructField("record_no", T.LongType()),
    T.StructField("shape_type", T.IntegerType()),
    T.StructField("parts", T.ArrayType(T.IntegerType())),
    T.StructField("points", T.ArrayType(POINT)),
    T.StructField("field_names", T.ArrayType(T.StringType())),
    T.StructField("record", T.ArrayType(T.StringType())),
])
