"""Casts, rounding and labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.functions import scalar
from regista.functions.document import page_file_name, switch_layer, zip_fields
from regista.workload.registry import Tables, query


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS strict_date,
       TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'unknown'
                     ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS lenient_date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
                     ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS capacity,
       CAST(trunc(o_totalprice - 200000) AS BIGINT) AS truncated
FROM orders""")
def strict_lenient_casts(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date").cast("string")
    doubtful = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(day)
    number = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(
        F.col("o_custkey").cast("string")
    )
    strict = scalar.parse_date_strict(day)
    return t.orders.select(
        "o_orderkey",
        strict.alias("strict_date"),
        scalar.parse_date_lenient(doubtful).alias("lenient_date"),
        F.year(strict).alias("year"),
        F.month(strict).alias("month"),
        scalar.int_lenient(number).alias("capacity"),
        scalar.trunc_to_long(F.col("o_totalprice") - 200000).alias("truncated"),
    )


@query("""
SELECT c_custkey, CAST(floor((c_custkey - 700) / 2.0 + 0.5) AS BIGINT) AS rounded,
       floor(c_custkey * 1000.0 / nullif(c_nationkey, 0) + 0.5) / 10.0 AS one_decimal,
       round(c_acctbal * 100.0 / nullif(c_nationkey, 0), 2) AS ratio,
       (c_custkey * 1e15::DOUBLE) * 100.0::DOUBLE AS large_ratio
FROM customer""")
def js_round_percent(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        scalar.round_half_up((F.col("c_custkey") - 700) / F.lit(2.0)).alias("rounded"),
        scalar.one_decimal_percent(F.col("c_custkey"), F.col("c_nationkey")).alias("one_decimal"),
        scalar.percent_ratio(F.col("c_acctbal"), F.col("c_nationkey")).alias("ratio"),
        scalar.percent_ratio(F.col("c_custkey") * F.lit(1e15), F.lit(1)).alias("large_ratio"),
    )


@query("""
SELECT s_suppkey, abs(s_acctbal) AS size,
       CASE WHEN s_acctbal > 4000 THEN '+' ELSE '' END AS sign,
       CAST(floor(0.0411::DOUBLE * (s_suppkey * 1000)::DOUBLE - s_acctbal + 0.5) AS BIGINT) AS deficit,
       CASE WHEN floor(0.0411::DOUBLE * (s_suppkey * 1000)::DOUBLE - s_acctbal + 0.5) > 0
            THEN 'Dèficit' ELSE 'Superàvit' END AS label
FROM supplier""")
def sign_and_deficit(t: Tables) -> DataFrame:
    deficit = scalar.bed_deficit(F.col("s_suppkey") * 1000, F.col("s_acctbal"))
    return t.supplier.select(
        "s_suppkey",
        F.abs("s_acctbal").alias("size"),
        scalar.plus_sign(F.col("s_acctbal"), F.lit(4000)).alias("sign"),
        deficit.alias("deficit"),
        scalar.deficit_label(deficit).alias("label"),
    )


@query("""
SELECT 'staging/orders/' || repeat('0', greatest(0, 8 - length(o))) || o || '.json' AS path,
       COUNT(*) AS row_count
FROM (SELECT CAST((o_orderkey // 10) * 1000000 AS VARCHAR) AS o FROM orders) GROUP BY 1""")
def landing_page_paths(t: Tables) -> DataFrame:
    offset = F.floor(F.col("o_orderkey") / 10) * 1000000
    landing = F.concat(F.lit("landing/orders/"), page_file_name(offset))
    return t.orders.groupBy(switch_layer(landing, "landing", "staging").alias("path")).agg(
        F.count("*").alias("row_count")
    )


@query("""
SELECT s_suppkey, s_name AS nom, CAST(s_nationkey AS VARCHAR) AS codi_comarca FROM supplier""")
def record_fields(t: Tables) -> DataFrame:
    names = F.array(*map(F.lit, ("CODI", "NOM", "COMARCA")))
    values = F.array(
        F.col("s_suppkey").cast("string"), F.col("s_name"), F.col("s_nationkey").cast("string")
    )
    record = zip_fields(names, values)
    return t.supplier.select(
        "s_suppkey", record["NOM"].alias("nom"), record["COMARCA"].alias("codi_comarca")
    )
