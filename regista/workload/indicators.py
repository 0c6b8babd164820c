"""Dashboard figures and map tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.functions.scalar import threshold_class as class_of
from regista.operators.project import where_equals
from regista.plans import indicators, maps
from regista.workload import roles
from regista.workload.registry import Tables, query
from regista.workload.roles import (
    COUNTY_COVERAGE_SQL,
    COUNTY_POPULATION_SQL,
    MART_SQL,
    MUNICIPALS_SQL,
    PANEL_SQL,
    POPULATION_SQL,
    RESIDENCE,
    TOWN_COVERAGE_SQL,
    with_ctes,
)
from regista.workspace import settle

_COUNTY = (MUNICIPALS_SQL, POPULATION_SQL, COUNTY_POPULATION_SQL)

_YEARS_SQL = """years AS (
  SELECT MAX(year) AS latest, arg_min(year, abs(year - 2000) * 10000 + year) AS reference
  FROM county_population)"""

_SHARES_SQL = """shares AS (
  SELECT comarca_id, year, population, population_ge65,
         floor(population_ge65 * 1000.0 / population::DOUBLE + 0.5) / 10.0 AS elderly_pct
  FROM county_population)"""

_VARIATION_SQL = """variation AS (
  SELECT comarca_id, MAX(CASE WHEN year = latest THEN elderly_pct END) AS latest_value,
         MAX(CASE WHEN year = reference THEN elderly_pct END) AS reference_value,
         MAX(CASE WHEN year = latest THEN elderly_pct END)
           - MAX(CASE WHEN year = reference THEN elderly_pct END) AS variation
  FROM shares, years GROUP BY 1)"""

_HEADLINE_SQL = f"""yearly AS (
  SELECT year, SUM(population) AS p, SUM(population_ge65) AS e FROM county_population GROUP BY 1),
places AS (
  SELECT CAST(SUM(total_capacit) AS BIGINT) AS n FROM panel WHERE service_type_id = '{RESIDENCE}'),
base AS (
  SELECT latest AS census_latest_year, reference AS reference_year,
         CAST(l.p AS BIGINT) AS total_population_latest_year,
         CAST(l.e AS BIGINT) AS elderly_population_latest_year,
         CAST(r.p AS BIGINT) AS total_population_reference_year,
         CAST(r.e AS BIGINT) AS elderly_population_reference_year,
         (SELECT MAX(year) FROM county_coverage) AS coverage_latest_year,
         n AS residence_places,
         floor(l.e * 1000.0 / l.p::DOUBLE + 0.5) / 10.0 AS latest_elderly_pct,
         floor(r.e * 1000.0 / r.p::DOUBLE + 0.5) / 10.0 AS reference_elderly_pct,
         floor(n * 1000.0 / l.e::DOUBLE + 0.5) / 10.0 AS residence_coverage_pct,
         CAST(floor(0.0411::DOUBLE * l.e::DOUBLE - n::DOUBLE + 0.5) AS BIGINT) AS bed_deficit
  FROM years JOIN yearly l ON l.year = latest JOIN yearly r ON r.year = reference, places),
headline AS (
  SELECT *, CAST(floor(latest_elderly_pct + 0.5) AS BIGINT) AS latest_elderly_pct_rounded,
         CASE WHEN floor(latest_elderly_pct + 0.5) > reference_elderly_pct THEN '+' ELSE '' END
           AS reference_sign,
         CASE WHEN bed_deficit > 0 THEN 'Dèficit' ELSE 'Superàvit' END AS deficit_label
  FROM base)"""


def _county_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    """County population, which is read several times and so settled, and county coverage."""
    by_county = roles.settled_county_population(t)
    return by_county, roles.county_coverage(t, by_county, roles.mart(t))


def _headline(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """County population, county coverage and the headline figures, all from residence rows."""
    by_county = roles.settled_county_population(t)
    residences = roles.settled_residence_mart(t)
    coverage = roles.county_coverage(t, by_county, residences)
    panel = roles.panel(t, residences)
    return by_county, coverage, indicators.headline_indicators(by_county, panel, coverage, RESIDENCE)


@query(with_ctes(MART_SQL, *_COUNTY, COUNTY_COVERAGE_SQL, PANEL_SQL, _YEARS_SQL, _HEADLINE_SQL,
                 select="""
SELECT *, array_to_string(list_transform(range(8), lambda i: CAST(latest_elderly_pct_rounded - 7 + 2 * i AS VARCHAR)), ',')
  AS elderly_thresholds FROM headline"""))
def headline_indicators(t: Tables) -> DataFrame:
    _, _, figures = _headline(t)
    limits = F.transform("elderly_thresholds", lambda v: v.cast("string"))
    return figures.withColumn("elderly_thresholds", F.array_join(limits, ","))


@query(with_ctes(*_COUNTY, _YEARS_SQL, _SHARES_SQL, _VARIATION_SQL, select="SELECT * FROM variation"))
def county_variation(t: Tables) -> DataFrame:
    return indicators.county_variation(roles.settled_county_population(t))


@query(with_ctes(MART_SQL, *_COUNTY, COUNTY_COVERAGE_SQL, _YEARS_SQL, select="""
SELECT c.*, CAST(floor(0.0411::DOUBLE * population_ge65::DOUBLE - total_capacit::DOUBLE + 0.5)
                 AS BIGINT) AS deficit_411
FROM county_coverage c JOIN years ON year = latest"""))
def county_attention(t: Tables) -> DataFrame:
    by_county, coverage = _county_tables(t)
    return indicators.county_attention(by_county, coverage)


_COUNTY_FIGURES_SQL = """county_figures AS (
  SELECT v.comarca_id, v.latest_value, v.reference_value, v.variation,
         p.population, p.population_ge65 AS census_ge65, c.total_capacit, c.coverage_ratio,
         CAST(floor(0.0411::DOUBLE * c.population_ge65::DOUBLE - c.total_capacit::DOUBLE + 0.5)
              AS BIGINT) AS deficit_411
  FROM variation v
  LEFT JOIN (SELECT x.* FROM county_population x JOIN years ON x.year = latest) p
    ON p.comarca_id = v.comarca_id
  LEFT JOIN (SELECT y.* FROM county_coverage y JOIN years ON y.year = latest) c
    ON c.comarca_id = v.comarca_id)"""


@query(with_ctes(MART_SQL, *_COUNTY, COUNTY_COVERAGE_SQL, _YEARS_SQL, _SHARES_SQL, _VARIATION_SQL,
                 _COUNTY_FIGURES_SQL, select="SELECT * FROM county_figures"))
def county_indicators(t: Tables) -> DataFrame:
    by_county, coverage = _county_tables(t)
    return indicators.county_indicators(by_county, coverage)


_TOWN_FIGURES_SQL = """town_figures AS (
  SELECT coalesce(p.municipal_code, c.municipal_id) AS municipal_id, p.population,
         p.population_ge65,
         floor(p.population_ge65 * 1000.0 / p.population::DOUBLE + 0.5) / 10.0 AS elderly_pct,
         c.total_capacit, c.coverage_ratio
  FROM (SELECT x.* FROM population x JOIN years ON x.year = latest) p
  FULL JOIN (SELECT y.* FROM town_coverage y JOIN years ON y.year = latest) c
    ON p.municipal_code = c.municipal_id)"""


def _town_indicators(t: Tables) -> DataFrame:
    census = settle(roles.population(t))
    by_county = settle(roles.county_population(t, census))
    coverage = roles.town_coverage(t, census, roles.town_mart(t))
    return indicators.municipal_indicators(census, coverage, by_county)


@query(with_ctes(MART_SQL, *_COUNTY, TOWN_COVERAGE_SQL, _YEARS_SQL, _TOWN_FIGURES_SQL,
                 select="SELECT * FROM town_figures"))
def municipal_indicators(t: Tables) -> DataFrame:
    return _town_indicators(t)


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, PANEL_SQL, select="""
SELECT comarca_id, service_type_id, year, CAST(SUM(s) OVER (
  PARTITION BY comarca_id, service_type_id ORDER BY year) AS BIGINT) AS accumulated_places
FROM (SELECT comarca_id, service_type_id, year, SUM(total_capacit) AS s FROM panel GROUP BY 1, 2, 3)"""))
def series_cumsum(t: Tables) -> DataFrame:
    return indicators.county_service_trend(roles.panel(t, roles.town_mart(t)))


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, PANEL_SQL, select=f"""
SELECT comarca_id, service_qualification_id, year, CAST(SUM(s) OVER (
  PARTITION BY comarca_id, service_qualification_id ORDER BY year) AS BIGINT) AS accumulated_places
FROM (SELECT comarca_id, service_qualification_id, year, SUM(total_capacit) AS s FROM panel
      WHERE service_type_id = '{RESIDENCE}' GROUP BY 1, 2, 3)"""))
def initiative_trend(t: Tables) -> DataFrame:
    of_service = where_equals(roles.panel(t, roles.town_mart(t)), service_type_id=RESIDENCE)
    return indicators.county_service_trend(of_service, "service_qualification_id")


@query(with_ctes(MART_SQL, *_COUNTY, PANEL_SQL, select="""
SELECT p.* FROM county_population p
JOIN (SELECT comarca_id, MIN(year) AS y FROM panel GROUP BY 1) f ON f.comarca_id = p.comarca_id
WHERE p.year >= f.y"""))
def county_population_trend(t: Tables) -> DataFrame:
    by_county = roles.county_population(t, roles.population(t))
    return indicators.county_population_trend(by_county, roles.panel(t, roles.town_mart(t)))


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, PANEL_SQL, select="""
SELECT DISTINCT comarca_id, service_type_id,
       CASE WHEN service_type_id <> 'SMALL' THEN 'Type ' || service_type_id END AS service_type_description
FROM panel WHERE total_capacit > 0"""))
def available_services(t: Tables) -> DataFrame:
    """With labels; the catalog lacks one type."""
    types = t.part.select(
        F.when(F.col("p_type") == "SMALL", F.lower("p_type")).otherwise(F.col("p_type")).alias("service_type_id"),
        F.concat(F.lit("Type "), "p_type").alias("service_type_description"),
    ).distinct()
    return indicators.available_services(roles.town_mart(t), roles.municipals(t), types, roles.FIRST, roles.LAST)


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, PANEL_SQL, select="""
SELECT DISTINCT comarca_id, service_type_id, service_qualification_id,
       'Flag ' || service_qualification_id AS service_qualification_description
FROM panel"""))
def available_initiatives(t: Tables) -> DataFrame:
    flags = t.lineitem.select(F.col("l_returnflag").alias("service_qualification_id")).distinct().select(
        "service_qualification_id",
        F.concat(F.lit("Flag "), "service_qualification_id").alias("service_qualification_description"),
    )
    return indicators.available_initiatives(roles.town_mart(t), roles.municipals(t), flags, roles.FIRST, roles.LAST)


def _center(figures: DataFrame) -> Column:
    return figures.select("latest_elderly_pct_rounded").scalar()


_CLASS_SQL = """(CASE WHEN {0} IS NOT NULL THEN
    ({0} >= {1} - 7)::INTEGER + ({0} >= {1} - 5)::INTEGER + ({0} >= {1} - 3)::INTEGER
  + ({0} >= {1} - 1)::INTEGER + ({0} >= {1} + 1)::INTEGER + ({0} >= {1} + 3)::INTEGER
  + ({0} >= {1} + 5)::INTEGER + ({0} >= {1} + 7)::INTEGER END)"""
_COVERAGE_CLASS_SQL = """(CASE WHEN coverage_ratio IS NOT NULL THEN
    (coverage_ratio >= 3)::INTEGER + (coverage_ratio >= 4.11::DOUBLE)::INTEGER
  + (coverage_ratio >= 5)::INTEGER + (coverage_ratio >= 7)::INTEGER END)"""


@query(with_ctes(MART_SQL, *_COUNTY, COUNTY_COVERAGE_SQL, PANEL_SQL, _YEARS_SQL, _HEADLINE_SQL,
                 _SHARES_SQL, _VARIATION_SQL, _COUNTY_FIGURES_SQL, select=f"""
SELECT n_nationkey AS comarca_id, population, census_ge65, latest_value AS elderly_pct, variation,
       total_capacit, coverage_ratio, nom_comarca AS label,
       {_CLASS_SQL.format("latest_value", "latest_elderly_pct_rounded")} AS elderly_class,
       {_COVERAGE_CLASS_SQL} AS coverage_class,
       CAST(floor(variation + 0.5) AS BIGINT) AS variation_shown
FROM nation LEFT JOIN county_figures ON n_nationkey = comarca_id
LEFT JOIN (SELECT DISTINCT codi_comarca, nom_comarca FROM municipals) ON codi_comarca = n_nationkey,
headline"""))
def choropleth_table(t: Tables) -> DataFrame:
    by_county, coverage, figures = _headline(t)
    features = t.nation.select(F.col("n_nationkey").alias("comarca_id"))
    by_id = indicators.county_indicators(by_county, coverage)
    return maps.county_map(features, by_id, roles.municipals(t), _center(figures))


@query(with_ctes(MART_SQL, *_COUNTY, COUNTY_COVERAGE_SQL, TOWN_COVERAGE_SQL, PANEL_SQL, _YEARS_SQL,
                 _HEADLINE_SQL, _TOWN_FIGURES_SQL, select=f"""
SELECT codi AS municipal_id, population, population_ge65, elderly_pct, total_capacit,
       coverage_ratio, nom AS label,
       {_CLASS_SQL.format("elderly_pct", "latest_elderly_pct_rounded")} AS elderly_class,
       {_COVERAGE_CLASS_SQL} AS coverage_class
FROM municipals LEFT JOIN town_figures ON codi = municipal_id, headline"""))
def municipal_choropleth(t: Tables) -> DataFrame:
    census = settle(roles.population(t))
    by_county = settle(roles.county_population(t, census))
    residences = roles.settled_residence_mart(t)
    by_town = roles.town_coverage(t, census, residences)
    coverage = roles.county_coverage(t, by_county, residences)
    panel = roles.panel(t, residences)
    figures = indicators.headline_indicators(by_county, panel, coverage, RESIDENCE)
    features = roles.municipals(t).select(F.col("codi").alias("municipal_id"))
    by_id = indicators.municipal_indicators(census, by_town, by_county)
    return maps.municipal_map(features, by_id, roles.municipals(t), _center(figures))


@query("""
SELECT c_custkey, CAST((c_acctbal >= 0)::INTEGER + (c_acctbal >= 2500.5)::INTEGER
       + (c_acctbal >= 5000)::INTEGER + (c_acctbal >= 9000)::INTEGER AS INTEGER) AS balance_class
FROM customer""")
def threshold_class(t: Tables) -> DataFrame:
    limits = (0, 2500.5, 5000, 9000)
    return t.customer.select("c_custkey", class_of(F.col("c_acctbal"), limits).alias("balance_class"))
