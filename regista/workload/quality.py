"""Data-quality reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.functions.scalar import null_text_to_null
from regista.operators import quality
from regista.operators.aggregate import all_match
from regista.operators.sets import union_all
from regista.workload import roles
from regista.workload.documents import census_cubes
from regista.workload.registry import Tables, query
from regista.operators.project import mart_rows


@query("""
SELECT 'service_type' AS mapping, p_type AS value FROM part WHERE p_type IN ('PROMO', 'LARGE')
UNION
SELECT 'service_qualification', p_brand FROM part
WHERE p_brand <> 'Brand#7' AND p_brand NOT LIKE '%5'""")
def mapping_violations(t: Tables) -> DataFrame:
    register = t.part.select(
        F.concat(F.lit('"'), "p_type", F.lit('"')).alias("tipologia"),
        null_text_to_null(F.col("p_brand"), "Brand#7").alias("qualificacio"),
    )
    # every part names a type and a brand of the catalogs, some under another spelling
    types = t.part.select(
        F.when(F.col("p_type").isin("PROMO", "LARGE"), F.lower("p_type")).otherwise(F.col("p_type"))
        .alias("service_type_description")
    )
    brands = t.part.select(
        F.when(F.col("p_brand").endswith("5"), F.col("p_brand")).otherwise(F.lower("p_brand"))
        .alias("service_qualification_description")
    )
    return quality.mapping_violations(register, types.distinct(), brands.distinct())


@query("""
SELECT b AS before_count, a AS after_count, b = a AND a > 0 AS preserved
FROM (SELECT COUNT(DISTINCT l_orderkey) AS b FROM lineitem),
     (SELECT COUNT(DISTINCT l_orderkey) AS a FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_quantity > 0 AND p_type <> 'PROMO')""")
def distinct_preserved(t: Tables) -> DataFrame:
    counted = mart_rows(roles.staging(t), roles.MART_TYPES)
    return quality.distinct_preserved(
        t.lineitem, "l_orderkey", counted, "social_service_register_id"
    )


@query("""
SELECT dataset, row_count,
       CASE WHEN row_count = 0 THEN 'error' WHEN row_count < 100 THEN 'warn' ELSE 'ok' END AS status
FROM (SELECT 'lineitem' AS dataset, COUNT(*) AS row_count FROM lineitem
      UNION ALL SELECT 'nation', COUNT(*) FROM nation
      UNION ALL SELECT 'unpriced parts', COUNT(*) FROM part WHERE p_retailprice < 0)""")
def min_rows_check(t: Tables) -> DataFrame:
    datasets = {
        "lineitem": t.lineitem,
        "nation": t.nation,
        "unpriced parts": t.part.where(F.col("p_retailprice") < 0),
    }
    return union_all([
        quality.row_count_status(df).select(F.lit(name).alias("dataset"), "row_count", "status")
        for name, df in datasets.items()
    ])


@query(r"""
SELECT 'url' AS column_name, 'https?://' AS pattern,
       coalesce(bool_and(regexp_matches(url, 'https?://')), true) AS matches FROM pages
UNION ALL SELECT 'html', '<(main|article)', bool_and(regexp_matches(html, '<(main|article)'))
FROM pages""")
def pattern_profile(t: Tables) -> DataFrame:
    return all_match(t.pages, {"url": "https?://", "html": "<(main|article)"})


@query(r"""
SELECT 'l_orderkey' AS column_name, '\d{1,3}' AS pattern,
       bool_and(regexp_matches(CAST(l_orderkey AS VARCHAR), '\d{1,3}')) AS matches FROM lineitem
UNION ALL SELECT 'l_shipdate', '[1-9]\d{3}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])',
  bool_and(regexp_matches(CAST(l_shipdate AS VARCHAR),
           '[1-9]\d{3}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])')) FROM lineitem
UNION ALL SELECT 'l_returnflag', 'S\d{5}',
  bool_and(regexp_matches(l_returnflag, 'S\d{5}')) FROM lineitem""")
def register_format_profile(t: Tables) -> DataFrame:
    from regista.fixed_values import REGISTER_PATTERNS as known

    text = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"),
        "l_returnflag",
    )
    return all_match(text, {
        "l_orderkey": known["capacitat"],
        "l_shipdate": known["inscripcio"],
        "l_returnflag": known["registre"],
    })


@query("""
SELECT vec_id, 2 AS member_count FROM embeddings WHERE label = 0""")
def single_member_dimension(t: Tables) -> DataFrame:
    cubes = census_cubes(t, second_year_for_label=0)
    return quality.multi_member_dimensions(cubes).select("vec_id", "member_count")


@query("""
SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem
WHERE year(l_shipdate) NOT IN (SELECT 2 * (year(o_orderdate) // 2) FROM orders)""")
def expected_members_complete(t: Tables) -> DataFrame:
    expected = t.lineitem.select(F.year("l_shipdate").alias("year"))
    landed = t.orders.select((F.floor(F.year("o_orderdate") / 2) * 2).alias("year"))
    return quality.missing_members(expected, landed, "year")
