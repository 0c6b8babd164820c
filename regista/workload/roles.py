"""The test tables in their roles, as DataFrames and as SQL common table expressions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.operators.aggregate import CAPACITY_KEYS
from regista.operators.joins import lookup
from regista.operators.project import where_equals
from regista.plans.marts import capacity_mart
from regista.plans.serving import (
    active_service_panel,
    comarca_coverage,
    comarca_population,
    municipal_coverage,
)
from regista.schemas import CAPACITY_MART
from regista.workload.registry import Tables
from regista.workspace import settle

MART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
RESIDENCE = "STANDARD"
FIRST, LAST = 1994, 2002
WIDE = "bigint"


def municipals(t: Tables) -> DataFrame:
    """Suppliers as municipalities, nations as counties."""
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("codi"),
        F.col("s_name").alias("nom"),
        F.col("s_nationkey").alias("codi_comarca"),
        F.col("n_name").alias("nom_comarca"),
    )


def staging(t: Tables) -> DataFrame:
    """Line items as register rows; the county is looked up later, on the mart."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("social_service_register_id"),
        F.col("l_shipdate").cast("date").alias("inscription_date"),
        F.col("l_quantity").cast("int").alias("capacity"),
        F.col("p_type").alias("service_type_id"),
        F.col("l_returnflag").alias("service_qualification_id"),
        F.col("l_suppkey").alias("municipal_id"),
    )


def town_mart(t: Tables) -> DataFrame:
    """The capacity mart without its county column, for tables by municipality."""
    keys = [k for k in CAPACITY_KEYS if k != "comarca_id"]
    return capacity_mart(staging(t), MART_TYPES, keys)


def mart(t: Tables) -> DataFrame:
    """The capacity mart; each municipality lies in one county."""
    placed = lookup(
        town_mart(t), t.supplier, "municipal_id", "s_suppkey", {"comarca_id": "s_nationkey"}
    )
    return placed.select(*[f.name for f in CAPACITY_MART.fields])


def population(t: Tables) -> DataFrame:
    """Quantities ordered per supplier and census; urgent ones are 65+.

    A census is held in every even year and counts the orders of its own and the next year.
    """
    quantity = F.col("l_quantity").cast("bigint")
    census = t.orders.withColumn("year", (F.floor(F.year("o_orderdate") / 2) * 2).cast("int"))
    return (
        t.lineitem.join(census, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_suppkey").alias("municipal_code"), "year")
        .agg(
            F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", quantity).otherwise(0))
            .alias("population_ge65"),
            F.sum(quantity).alias("population"),
        )
    )


def panel(t: Tables, of_mart: DataFrame) -> DataFrame:
    return active_service_panel(of_mart, municipals(t), FIRST, LAST, WIDE)


def county_population(t: Tables, census: DataFrame) -> DataFrame:
    return comarca_population(census, municipals(t), WIDE)


def county_coverage(t: Tables, by_county: DataFrame, of_mart: DataFrame) -> DataFrame:
    return comarca_coverage(by_county, of_mart, municipals(t), FIRST, LAST, RESIDENCE, WIDE)


def town_coverage(t: Tables, census: DataFrame, of_mart: DataFrame) -> DataFrame:
    return municipal_coverage(census, of_mart, municipals(t), FIRST, LAST, RESIDENCE, WIDE)


def settled_residence_mart(t: Tables) -> DataFrame:
    """The mart's residence rows written once; the filter reaches the scan of the service types."""
    return settle(where_equals(mart(t), service_type_id=RESIDENCE))


def settled_county_population(t: Tables) -> DataFrame:
    return settle(county_population(t, population(t)))


STAGING_SQL = """staging AS (
  SELECT l_orderkey AS social_service_register_id, CAST(l_shipdate AS DATE) AS inscription_date,
         CAST(l_quantity AS INTEGER) AS capacity, p_type AS service_type_id,
         l_returnflag AS service_qualification_id, l_suppkey AS municipal_id,
         s_nationkey AS comarca_id
  FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey)"""

MART_SQL = STAGING_SQL + """, mart AS (
  SELECT service_qualification_id, service_type_id, comarca_id, municipal_id,
         CAST(year(inscription_date) AS INTEGER) AS year,
         CAST(month(inscription_date) AS INTEGER) AS month,
         CAST(SUM(capacity) AS BIGINT) AS total_capacit
  FROM staging
  WHERE capacity > 0 AND service_type_id <> 'PROMO'
  GROUP BY ALL)"""

MUNICIPALS_SQL = """municipals AS (
  SELECT s_suppkey AS codi, s_name AS nom, s_nationkey AS codi_comarca, n_name AS nom_comarca
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

POPULATION_SQL = """population AS (
  SELECT l_suppkey AS municipal_code, CAST(2 * (year(o_orderdate) // 2) AS INTEGER) AS year,
         CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN l_quantity ELSE 0 END) AS BIGINT)
           AS population_ge65,
         CAST(SUM(l_quantity) AS BIGINT) AS population
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2)"""

COUNTY_POPULATION_SQL = """county_population AS (
  SELECT codi_comarca AS comarca_id, CAST(SUM(population_ge65) AS BIGINT) AS population_ge65, year,
         CAST(SUM(population) AS BIGINT) AS population,
         round(SUM(population_ge65)::DOUBLE / SUM(population)::DOUBLE, 2) AS elderly_fraction
  FROM population JOIN municipals ON municipal_code = codi GROUP BY 1, 3)"""


def coverage_sql(name: str, key: str, places: str, census: str, census_key: str) -> str:
    """Coverage on a dense calendar: every place in every year, then windows over the grid."""
    return f"""{name}_grid AS (
  SELECT place, CAST(y AS INTEGER) AS year
  FROM (SELECT DISTINCT {places} AS place FROM municipals), generate_series({FIRST}, {LAST}) g(y)),
{name}_yearly AS (
  SELECT {key} AS place, year, SUM(total_capacit) AS added
  FROM mart WHERE service_type_id = '{RESIDENCE}' GROUP BY 1, 2),
{name}_filled AS (
  SELECT g.place, g.year,
         last_value(c.population_ge65 IGNORE NULLS) OVER w AS elderly,
         SUM(s.added) OVER w AS places
  FROM {name}_grid g
  LEFT JOIN {census} c ON c.{census_key} = g.place AND c.year = g.year
  LEFT JOIN {name}_yearly s ON s.place = g.place AND s.year = g.year
  WINDOW w AS (PARTITION BY g.place ORDER BY g.year
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (
  SELECT place AS {key}, year, CAST(places AS BIGINT) AS total_capacit,
         CAST(elderly AS BIGINT) AS population_ge65,
         round(places::DOUBLE * 100.0 / nullif(elderly, 0)::DOUBLE, 2) AS coverage_ratio
  FROM {name}_filled WHERE places IS NOT NULL)"""


PANEL_SQL = f"""started AS (
  SELECT municipal_id, service_type_id, service_qualification_id, MIN(year) AS first_year
  FROM mart WHERE total_capacit > 0 AND year BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2, 3),
panel AS (
  SELECT s.municipal_id, s.service_type_id, s.service_qualification_id,
         m.codi_comarca AS comarca_id, CAST(y AS INTEGER) AS year,
         CAST(coalesce(f.total_capacit, 0) AS BIGINT) AS total_capacit
  FROM started s
  JOIN (SELECT DISTINCT codi, codi_comarca FROM municipals) m ON m.codi = s.municipal_id
  JOIN generate_series({FIRST}, {LAST}) g(y) ON y >= s.first_year
  LEFT JOIN mart f ON f.municipal_id = s.municipal_id AND f.service_type_id = s.service_type_id
    AND f.service_qualification_id = s.service_qualification_id AND f.year = y)"""

TOWN_COVERAGE_SQL = coverage_sql(
    "town_coverage", "municipal_id", "codi", "population", "municipal_code"
)
COUNTY_COVERAGE_SQL = coverage_sql(
    "county_coverage", "comarca_id", "codi_comarca", "county_population", "comarca_id"
)


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
