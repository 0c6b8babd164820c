"""JSON values, flat arrays and cubes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.functions.document import array_product as product
from regista.functions.document import json_path, stride_pick
from regista.operators.cube import census_rows
from regista.workload.registry import Tables, query


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_field_extract(t: Tables) -> DataFrame:
    return t.events.select("event_id", json_path(F.col("props"), "$.k", "int").alias("k"))


def census_cubes(t: Tables, second_year_for_label: int | None = None) -> DataFrame:
    """Each vector as a census cube of one year: 32 members (the last is the total) by 2 measures.

    Odd vectors write their member index as an object instead of an array.
    """
    pairs = (F.array_size("embedding") / 2).cast("int")
    members = F.transform(
        F.sequence(F.lit(0), pairs - 1),
        lambda i: F.concat(F.col("vec_id").cast("string"), F.lit("-"), i.cast("string")),
    )
    positions = F.map_from_arrays(members, F.sequence(F.lit(0), F.array_size(members) - 1))
    index = F.when(F.col("vec_id") % 2 == 1, F.to_json(positions)).otherwise(F.to_json(members))
    year = (F.col("label") + 2000).cast("string")
    years = F.array(year)
    if second_year_for_label is not None:
        years = F.when(
            F.col("label") == second_year_for_label, F.array(year, F.lit("1999"))
        ).otherwise(years)

    def members_struct(text):
        return F.struct(F.struct(text.alias("index")).alias("category"))

    return t.embeddings.select(
        "vec_id",
        F.array(F.lit(1).cast("bigint"), pairs.cast("bigint"), F.lit(2).cast("bigint")).alias("size"),
        F.struct(
            members_struct(F.to_json(years)).alias("YEAR"), members_struct(index).alias("MUN")
        ).alias("dimension"),
        F.transform("embedding", lambda v: v.cast("double") * 100000).alias("value"),
    )


CUBE_SQL = """
SELECT vec_id || '-' || CAST(i AS VARCHAR) AS municipal_code,
       CAST(trunc(embedding[2 * i + 1]::DOUBLE * 100000) AS BIGINT) AS population_ge65,
       CAST(trunc(embedding[2 * i + 2]::DOUBLE * 100000) AS BIGINT) AS population,
       CAST(label + 2000 AS BIGINT) AS year
FROM embeddings, generate_series(0, 30) g(i)"""


@query(CUBE_SQL)
def cube_decode(t: Tables) -> DataFrame:
    return census_rows(census_cubes(t))


@query("""
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS item_count FROM embeddings""")
def array_product(t: Tables) -> DataFrame:
    return census_cubes(t).select("vec_id", product(F.col("size")).alias("item_count"))


@query("""
SELECT vec_id, len(embedding) // 2 AS picked,
       CAST(list_sum(list_transform(range(32), lambda i: CAST(trunc(embedding[2 * i + 2]::DOUBLE * 100000) AS BIGINT)))
            AS BIGINT) AS odd_sum
FROM embeddings""")
def stride_sum(t: Tables) -> DataFrame:
    odd = F.transform(
        stride_pick(F.col("embedding"), 2, 1),
        lambda v: (v.cast("double") * 100000).cast("bigint"),
    )
    return t.embeddings.select(
        "vec_id",
        F.array_size(odd).cast("bigint").alias("picked"),
        F.aggregate(odd, F.lit(0).cast("bigint"), lambda acc, v: acc + v).alias("odd_sum"),
    )
