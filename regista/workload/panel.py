"""Calendars, carried values and the serving tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.functions.scalar import zero_if_null
from regista.operators import aggregate
from regista.operators.dedupe import top1_per_group as keep_best
from regista.operators.panel import calendar_grid, densify, hold_until_next, running_sum
from regista.workload import roles
from regista.workload.registry import Tables, query
from regista.workload.roles import (
    COUNTY_COVERAGE_SQL,
    COUNTY_POPULATION_SQL,
    FIRST,
    LAST,
    MART_SQL,
    MUNICIPALS_SQL,
    PANEL_SQL,
    POPULATION_SQL,
    TOWN_COVERAGE_SQL,
    with_ctes,
)


def _customer_years(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("order_count")
    )


def _customer_grid(t: Tables) -> DataFrame:
    return calendar_grid(t.customer.select(F.col("c_custkey").alias("o_custkey")), FIRST, LAST)


_GRID_SQL = f"""grid AS (
  SELECT c_custkey AS o_custkey, CAST(y AS INTEGER) AS year
  FROM customer, generate_series({FIRST}, {LAST}) g(y)),
yearly AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS order_count
  FROM orders GROUP BY 1, 2)"""


@query(with_ctes(_GRID_SQL, select="""
SELECT o_custkey, year, coalesce(order_count, 0) AS order_count
FROM grid LEFT JOIN yearly USING (o_custkey, year)"""))
def calendar_densify(t: Tables) -> DataFrame:
    return densify(
        _customer_grid(t), _customer_years(t), ["o_custkey", "year"], {"order_count": 0}
    )


@query(with_ctes(_GRID_SQL, select="""
SELECT o_custkey, year, last_value(order_count IGNORE NULLS) OVER (
  PARTITION BY o_custkey ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  AS order_count
FROM grid LEFT JOIN yearly USING (o_custkey, year)"""))
def forward_fill(t: Tables) -> DataFrame:
    """Years before a customer's first order are empty, so a NULL row stands for them."""
    sparse = _customer_years(t).where(F.col("year") <= LAST)
    started = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.lit(FIRST).alias("year"), F.lit(None).cast("bigint").alias("order_count"))
    # the years up to FIRST are one row, that of the last of them
    rows = sparse.select("o_custkey", F.greatest("year", F.lit(FIRST)).alias("year"), "order_count", F.col("year").alias("of"))
    rows = rows.unionByName(started.withColumn("of", F.lit(None).cast("int"))).groupBy("o_custkey", "year").agg(
        F.max_by("order_count", "of").alias("order_count"))
    known = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return hold_until_next(rows.join(known, "o_custkey", "left_semi"), ["o_custkey"], LAST)


@query(f"""
WITH grid AS (
  SELECT s_suppkey, CAST(y AS INTEGER) AS year FROM supplier, generate_series({FIRST}, {LAST}) g(y)),
yearly AS (
  SELECT l_suppkey AS s_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
         SUM(l_quantity) AS added FROM lineitem GROUP BY 1, 2)
SELECT * FROM (
  SELECT s_suppkey, year, CAST(SUM(added) OVER (
    PARTITION BY s_suppkey ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS BIGINT) AS total_capacity
  FROM grid LEFT JOIN yearly USING (s_suppkey, year)) WHERE total_capacity IS NOT NULL""")
def cumulative_capacity(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("total_capacity"),
    )
    yearly = aggregate.series_sum(rows, ["s_suppkey"], "year", "total_capacity")
    known = yearly.where(F.col("year").between(FIRST, LAST)).join(t.supplier, "s_suppkey", "left_semi")
    total = known.withColumn("total_capacity", running_sum(F.col("total_capacity"), ["s_suppkey"]))
    return hold_until_next(total, ["s_suppkey"], LAST)


@query("""
SELECT c_custkey, CAST(coalesce(n, 0) AS BIGINT) AS order_count
FROM customer LEFT JOIN (SELECT 2 * o_custkey AS o_custkey, COUNT(*) AS n FROM orders
                         GROUP BY 1) ON c_custkey = o_custkey""")
def zero_for_missing(t: Tables) -> DataFrame:
    counts = t.orders.groupBy((F.col("o_custkey") * 2).alias("o_custkey")).agg(F.count("*").alias("n"))
    joined = t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", zero_if_null(F.col("n")).alias("order_count"))


@query("""
SELECT l_suppkey, l_returnflag, CAST(MIN(year(l_shipdate)) AS INTEGER) AS first_year
FROM lineitem WHERE l_quantity > 30 GROUP BY 1, 2""")
def first_active_year(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_suppkey", "l_returnflag", F.year("l_shipdate").alias("year"),
        (F.col("l_quantity") - 30).alias("above"),
    )
    return aggregate.first_active_year(rows, ["l_suppkey", "l_returnflag"], "year", "above")


_BEST = """l_quantity DESC, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus"""


@query(f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY {_BEST}) = 1""")
def top1_per_group(t: Tables) -> DataFrame:
    order = [
        F.desc("l_quantity"),
        *[F.asc(c) for c in (
            "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        )],
    ]
    return keep_best(t.lineitem, ["l_suppkey"], order).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, PANEL_SQL, select="SELECT * FROM panel"))
def active_service_panel(t: Tables) -> DataFrame:
    return roles.panel(t, roles.town_mart(t))


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, POPULATION_SQL, TOWN_COVERAGE_SQL,
                 select="SELECT * FROM town_coverage"))
def coverage_by_municipality(t: Tables) -> DataFrame:
    return roles.town_coverage(t, roles.population(t), roles.town_mart(t))


@query(with_ctes(MUNICIPALS_SQL, POPULATION_SQL, COUNTY_POPULATION_SQL,
                 select="SELECT * FROM county_population"))
def county_population(t: Tables) -> DataFrame:
    return roles.county_population(t, roles.population(t))


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, POPULATION_SQL, COUNTY_POPULATION_SQL,
                 COUNTY_COVERAGE_SQL, select="SELECT * FROM county_coverage"))
def coverage_by_county(t: Tables) -> DataFrame:
    by_county = roles.county_population(t, roles.population(t))
    return roles.county_coverage(t, by_county, roles.mart(t))
