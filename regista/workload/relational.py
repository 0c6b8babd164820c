"""Projections, joins, aggregates, unions and sorts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regista.functions.scalar import null_text_to_null, recode_value
from regista.functions.text import strip_quotes
from regista.operators import project, sets
from regista.operators.aggregate import (
    bounds,
    distinct_list,
    nearest_year,
    series_sum,
    sum_ratio,
)
from regista.operators.joins import (
    attach_to_features,
    lookup,
    members_only,
    unmapped_values,
    value_difference,
)
from regista.operators.project import not_matching, rename_project, where_equals
from regista.workload import roles
from regista.workload.registry import Tables, query
from regista.workload.roles import MART_SQL, POPULATION_SQL, with_ctes
from regista.workspace import settle


@query(with_ctes(MART_SQL, select="SELECT * FROM mart"))
def capacity_mart(t: Tables) -> DataFrame:
    return roles.mart(t)


@query("""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE o_orderstatus END AS status,
       nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, o_orderkey AS register_id
FROM orders""")
def recode_and_nullif(t: Tables) -> DataFrame:
    cleaned = t.orders.select(
        "o_orderkey",
        recode_value(F.col("o_orderstatus"), {"P": "PENDING"}).alias("o_orderstatus"),
        null_text_to_null(F.col("o_orderpriority"), "4-NOT SPECIFIED").alias("o_orderpriority"),
    )
    return rename_project(
        cleaned,
        {"status": "o_orderstatus", "priority": "o_orderpriority", "register_id": "o_orderkey"},
    )


@query("SELECT event_id, replace(props, '\"', '') AS props FROM events")
def quotes_stripped(t: Tables) -> DataFrame:
    return t.events.select("event_id", strip_quotes(F.col("props")).alias("props"))


@query("""
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7""")
def filter_by_parameters(t: Tables) -> DataFrame:
    return where_equals(t.customer, c_mktsegment="BUILDING", c_nationkey=7).select(
        "c_custkey", "c_name", "c_acctbal"
    )


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_labels(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()


@query(r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '/[a-z]{2}/[0-9]+$')")
def not_matching_filter(t: Tables) -> DataFrame:
    return not_matching(t.pages.select("page_id", "url"), "url", "/[a-z]{2}/[0-9]+$")


def _customers(t: Tables) -> DataFrame:
    return rename_project(t.customer, {
        "party_key": "c_custkey", "name": "c_name", "nation": "c_nationkey",
        "balance": "c_acctbal", "segment": "c_mktsegment",
    })


def _suppliers(t: Tables) -> DataFrame:
    return rename_project(t.supplier, {
        "balance": "s_acctbal", "party_key": "s_suppkey", "name": "s_name", "nation": "s_nationkey",
    })


@query("""
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance
FROM customer""")
def common_columns(t: Tables) -> DataFrame:
    return project.common_columns(_customers(t), _suppliers(t))


@query("""
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance
FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def union_all(t: Tables) -> DataFrame:
    return sets.union_all([project.common_columns(_customers(t), _suppliers(t)), _suppliers(t)])


@query("""
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_diagonal(t: Tables) -> DataFrame:
    return sets.union_diagonal([_customers(t), _suppliers(t)])


@query("""
SELECT DISTINCT c_custkey AS customer_key FROM customer
WHERE c_custkey NOT IN (SELECT 2 * o_custkey FROM orders)""")
def set_difference(t: Tables) -> DataFrame:
    return sets.set_difference(
        t.customer.select(F.col("c_custkey").alias("customer_key")),
        t.orders.select((F.col("o_custkey") * 2).alias("customer_key")),
        "customer_key",
    )


@query("""
SELECT p_type AS service_type, COUNT(*) AS row_count,
       CAST(SUM(l_quantity) AS BIGINT) AS capacity
FROM lineitem LEFT JOIN part ON l_partkey = 2 * p_partkey
GROUP BY 1""")
def dimension_left_join(t: Tables) -> DataFrame:
    # doubled keys leave every other line without a part
    spread = t.part.select((F.col("p_partkey") * 2).alias("p_partkey"), "p_type")
    rows = lookup(
        t.lineitem.select("l_partkey", "l_quantity"), spread, "l_partkey", "p_partkey",
        {"service_type": "p_type"},
    )
    return rows.groupBy("service_type").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("capacity"),
    )


@query("""
SELECT n_name AS county, s_suppkey AS codi, s_name AS nom
FROM nation LEFT JOIN supplier ON n_nationkey = 2 * (s_nationkey // 2)""")
def county_fanout(t: Tables) -> DataFrame:
    # odd nations have no supplier under the halved key
    paired = t.supplier.select(
        (F.floor(F.col("s_nationkey") / 2) * 2).alias("s_nationkey"), "s_suppkey", "s_name")
    rows = lookup(t.nation, paired, "n_nationkey", "s_nationkey", {"codi": "s_suppkey", "nom": "s_name"})
    return rows.select(F.col("n_name").alias("county"), "codi", "nom")


@query(with_ctes(MART_SQL, POPULATION_SQL, select="""
SELECT m.municipal_id, m.year, m.capacity, p.population
FROM (SELECT municipal_id, year, CAST(SUM(total_capacit) AS BIGINT) AS capacity
      FROM mart GROUP BY 1, 2) m
JOIN population p ON p.municipal_code = m.municipal_id AND p.year = m.year"""))
def inner_join_using(t: Tables) -> DataFrame:
    yearly = series_sum(roles.town_mart(t), ["municipal_id"], "year", "total_capacit")
    census = roles.population(t).select(
        F.col("municipal_code").alias("municipal_id"), "year", "population"
    )
    return yearly.withColumnRenamed("total_capacit", "capacity").join(
        census, ["municipal_id", "year"]
    )


@query("""
SELECT o.o_orderstatus AS status, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(SUM(l.l_quantity) AS BIGINT) AS quantity,
       CAST(SUM(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END) AS BIGINT) AS returned,
       round(SUM(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END)
             / SUM(l.l_quantity), 2) AS returned_share
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""")
def inner_join_sum_ratio(t: Tables) -> DataFrame:
    orders = t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year")
    )
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)
    rows = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "status", "year", F.col("l_quantity").alias("quantity"), returned.alias("returned")
    )
    return sum_ratio(rows, ["status", "year"], "returned", "quantity", "returned_share")


@query("""
SELECT DISTINCT l_partkey AS value FROM lineitem
WHERE l_partkey NOT IN (SELECT 2 * p_partkey FROM part)""")
def anti_join_unmapped(t: Tables) -> DataFrame:
    doubled = t.part.select((F.col("p_partkey") * 2).alias("p_partkey"))
    return unmapped_values(t.lineitem, "l_partkey", doubled, "p_partkey")


@query("""
SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN
  (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""")
def semi_join_members(t: Tables) -> DataFrame:
    asia = t.nation.join(
        t.region.where(F.col("r_name") == "ASIA"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return members_only(t.supplier, "s_nationkey", asia, "n_nationkey").select("s_suppkey", "s_name")


@query("""
SELECT s_suppkey, s_name, n_name AS county_label
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def label_lookup(t: Tables) -> DataFrame:
    labels = t.nation.select("n_nationkey", "n_name").distinct()
    return lookup(
        t.supplier.select("s_suppkey", "s_name", "s_nationkey"), labels,
        "s_nationkey", "n_nationkey", {"county_label": "n_name"},
    ).drop("s_nationkey")


@query("""
SELECT n_nationkey AS feature_id, n_name AS feature_name, wealthy, top_balance
FROM nation LEFT JOIN (
  SELECT 2 * s_nationkey AS s_nationkey, COUNT(*) AS wealthy, MAX(s_acctbal) AS top_balance
  FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey""")
def attribute_to_feature(t: Tables) -> DataFrame:
    features = rename_project(t.nation, {"feature_id": "n_nationkey", "feature_name": "n_name"})
    stats = t.supplier.groupBy((F.col("s_nationkey") * 2).alias("s_nationkey")).agg(
        F.count("*").alias("wealthy"), F.max("s_acctbal").alias("top_balance")
    )
    return attach_to_features(features, "feature_id", stats, "s_nationkey", ["wealthy", "top_balance"])


@query("""
SELECT o_custkey, MAX(CASE WHEN y = 2000 THEN total END) AS latest_value,
       MAX(CASE WHEN y = 1996 THEN total END) AS reference_value,
       MAX(CASE WHEN y = 2000 THEN total END) - MAX(CASE WHEN y = 1996 THEN total END) AS variation
FROM (SELECT o_custkey, year(o_orderdate) AS y, COUNT(*) AS total FROM orders GROUP BY 1, 2)
GROUP BY 1""")
def self_difference(t: Tables) -> DataFrame:
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("total")
    )
    return value_difference(yearly, "o_custkey", "year", "total", F.lit(2000), F.lit(1996))


@query("""
SELECT CAST(SUM(l_quantity) AS BIGINT) AS total_quantity, COUNT(*) AS row_count FROM lineitem""")
def global_totals(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity"),
        F.count("*").alias("row_count"),
    )


@query("""
SELECT CAST(MIN(year(l_shipdate)) AS INTEGER) AS min_year,
       CAST(MAX(year(l_shipdate)) AS INTEGER) AS max_year FROM lineitem""")
def year_bounds(t: Tables) -> DataFrame:
    return bounds(t.lineitem.select(F.year("l_shipdate").alias("year")), "year")


@query("""
SELECT CAST(2 * (year(o_orderdate) // 2) AS INTEGER) AS nearest_year FROM orders
ORDER BY abs(2 * (year(o_orderdate) // 2) - 1999), 2 * (year(o_orderdate) // 2) LIMIT 1""")
def nearest_census_year(t: Tables) -> DataFrame:
    # even years only, so two of them are equally near
    years = t.orders.select((F.floor(F.year("o_orderdate") / 2) * 2).cast("int").alias("year"))
    return nearest_year(years, "year", 1999)


@query("""
SELECT string_agg(y, ',' ORDER BY y) AS years
FROM (SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) AS y FROM lineitem)""")
def distinct_year_list(t: Tables) -> DataFrame:
    years = distinct_list(t.lineitem.select(F.year("l_shipdate").alias("year")), "year")
    return years.select(F.array_join(F.transform("values", lambda y: y.cast("string")), ",").alias("years"))


@query("""
SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS row_count FROM events GROUP BY 1, 2""")
def row_counts(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("row_count")
    )


@query(with_ctes(MART_SQL, select="""
SELECT service_type_id, year, CAST(SUM(total_capacit) AS BIGINT) AS total_capacit
FROM mart GROUP BY 1, 2"""))
def group_sum_series(t: Tables) -> DataFrame:
    return series_sum(roles.town_mart(t), ["service_type_id"], "year", "total_capacit")


def _with_neighbour(df: DataFrame, column: str) -> DataFrame:
    """Sorted rows written and read back in the order of their files, each with the one after it.

    Range partitions are written in order, so file and place in the file give the sorted order
    that a reader meets; the neighbour makes it part of the result.
    """
    written = settle(df.select(
        F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"), "*"))
    # neighbours are looked up by place, the last row of a part by the first of the next part with any
    ends = written.groupBy("__part").agg(F.min_by(column, "__at").alias("head"))
    following = Window.orderBy("__part")       # one row for each partition of the sort
    ends = ends.select("__part", F.lead("head").over(following).alias("__head"))
    inside = F.lead(column).over(Window.partitionBy("__part").orderBy("__at"))
    return written.withColumn("__next", inside).join(ends, "__part").select(
        *df.columns, F.coalesce("__next", "__head").alias("next_key"))


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice,
       lead(o_orderkey) OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS next_key
FROM orders""")
def sort_multi_direction(t: Tables) -> DataFrame:
    """The order shows in the result as the key of the row that follows."""
    ordered = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")
    )
    return _with_neighbour(ordered, "o_orderkey")


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 3""")
def sort_limit_sample(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.desc("o_totalprice"), F.asc("o_orderkey")
    ).limit(3)
