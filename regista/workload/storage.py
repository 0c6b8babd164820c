"""Sources and sinks: tables written to the shared folder and read back."""

import functools
from collections.abc import Iterable

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regista.fixed_values import SERVICE_TYPES
from regista.functions.document import member_codes, page_file_name
from regista.functions.scalar import recode_value
from regista.llm.shipping import ship
from regista.operators.joins import lookup
from regista.operators.sets import union_all
from regista.plans.jobs import read_catalogs
from regista.plans.serving import serving_tables
from regista.plans.staging import build_catalogs, staging_population
from regista.schemas import CAPACITY_MART, CENSUS_CUBE
from regista.sources import catalogs, tables
from regista.sources.landing import PARTITION, read_landing_json, read_landing_records
from regista.streaming.landing import follow_landing, landing_stream
from regista.workload import roles
from regista.workload.documents import CUBE_SQL, census_cubes
from regista.workload.registry import Tables, query
from regista.workload.roles import (
    COUNTY_COVERAGE_SQL,
    COUNTY_POPULATION_SQL,
    MART_SQL,
    MUNICIPALS_SQL,
    PANEL_SQL,
    POPULATION_SQL,
    TOWN_COVERAGE_SQL,
    with_ctes,
)
from regista.workspace import run_folder

_JSON_LINES = "part-*.json"
_HIVE_DEFAULT = "__HIVE_DEFAULT_PARTITION__"


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _landed_register(t: Tables, keys_per_page: int = 100_000) -> str:
    """Orders landed as a register is: JSON array pages of eight-digit names in dated folders.

    A page covers so many order keys, some megabytes; the pages are named by their offset.
    """
    folder = run_folder(t.spark, "landing")
    texts = {
        "registre": F.format_string("S%08d", F.col("o_orderkey")),
        "tipologia": F.col("o_orderpriority"),
        "inscripcio": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "capacitat": F.col("o_custkey").cast("string"),
        "municipi": F.concat(F.lit("Town "), F.col("o_custkey") % 97),
        "comarca": F.when(F.col("o_orderstatus") == "P", "Val d'Aran").otherwise(F.col("o_orderstatus")),
        "qualificacio": F.when(F.col("o_orderstatus") == "F", "null").otherwise(F.col("o_orderstatus")),
        "districte": F.col("o_orderstatus"),
    }
    records = t.orders.select(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        page_file_name(F.floor(F.col("o_orderkey") / keys_per_page) * keys_per_page).alias("page"),
        F.struct(*[c.alias(n) for n, c in texts.items()]).alias("record"),
    )
    pages = records.groupBy("year", "page").agg(F.to_json(F.collect_list("record")).alias("text"))
    # Spark names its files itself, a register's pages are named by their offset: each task writes its own pages
    landed = f"{folder}/landed"
    files = t.spark._jvm.org.apache.hadoop.fs
    files.Path(landed).getFileSystem(t.spark._jsc.hadoopConfiguration()).mkdirs(files.Path(landed))
    ship(t.spark)
    pages.foreachPartition(functools.partial(_land_pages, landed))
    return landed


def _land_pages(landed: str, pages: Iterable[Row]) -> None:
    """Writes each page as a text line to ``<landed>/downloaded_date=<year>0101/<page>``; no value: Spark's default."""
    system, root = pafs.FileSystem.from_uri(landed)
    made = set()
    for page in pages:
        year, name = (_HIVE_DEFAULT if v is None else v for v in (page["year"], page["page"]))
        day = f"{root}/{PARTITION}={year}0101"
        if day not in made:
            system.create_dir(day)
            made.add(day)
        with system.open_output_stream(f"{day}/{name}") as out:
            out.write(f"{page['text']}\n".encode())


_REGISTER_ROWS = """register AS (
  SELECT 'S' || repeat('0', greatest(0, 8 - length(CAST(o_orderkey AS VARCHAR)))) || o_orderkey AS registre,
         o_orderpriority AS tipologia, strftime(o_orderdate, '%Y-%m-%d') AS inscripcio,
         CAST(o_custkey AS VARCHAR) AS capacitat, 'Town ' || (o_custkey % 97) AS municipi,
         CASE WHEN o_orderstatus = 'P' THEN 'Val d''Aran' ELSE o_orderstatus END AS comarca,
         CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE o_orderstatus END AS qualificacio,
         strftime(o_orderdate, '%Y') || '0101' AS downloaded_date
  FROM orders)"""


@query(with_ctes(_REGISTER_ROWS, select="""
SELECT registre, tipologia, inscripcio, capacitat, municipi, comarca, qualificacio FROM register"""))
def landing_json_scan(t: Tables) -> DataFrame:
    """Array pages of eight-digit names, read with the defaults and pruned to the register's columns."""
    return read_landing_json(t.spark, _landed_register(t)).select(
        "registre", "tipologia", "inscripcio", "capacitat", "municipi", "comarca", "qualificacio"
    )


@query("""
SELECT strftime(o_orderdate, '%Y') AS year,
       CASE WHEN o_custkey % 10 = 0 THEN 'capacitat' WHEN o_custkey % 10 = 1 THEN 'record' END AS fault,
       COUNT(*) AS row_count, CAST(SUM(CASE WHEN o_custkey % 10 > 2 THEN o_custkey END) AS BIGINT) AS capacitat
FROM orders GROUP BY 1, 2""")
def landing_quarantine(t: Tables) -> DataFrame:
    """Array pages taken apart record by record; records of a wrong type are set aside, the others counted."""
    folder = run_folder(t.spark, "faulty")
    key, text = F.col("o_custkey"), F.col("o_custkey").cast("string")
    given = F.when(key % 10 == 0, F.lit('"n/a"')).when(key % 10 == 2, F.lit("null")).otherwise(text)
    record = F.when(key % 10 == 1, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        F.concat(F.lit('{"registre": "S'), F.col("o_orderkey").cast("string"), F.lit('", "capacitat": '), given, F.lit("}")))
    pages = t.orders.select(F.date_format("o_orderdate", "yyyy").alias("year"),
                            F.floor(F.col("o_orderkey") / 100_000).alias("page"), record.alias("record")).groupBy(
        "year", "page").agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("text"))
    pages.write.partitionBy("year", "page").text(folder)
    schema = T.StructType([T.StructField("registre", T.StringType()), T.StructField("capacitat", T.LongType())])
    return read_landing_records(t.spark, folder, schema, "part-*").groupBy(
        F.regexp_extract("_page", r"year=(\d+)", 1).alias("year"), F.col("_fault").alias("fault")).agg(
        F.count("*").alias("row_count"), F.sum("capacitat").alias("capacitat"))


@query(with_ctes(_REGISTER_ROWS, select="""
SELECT registre, municipi FROM register"""))
def record_pages(t: Tables) -> DataFrame:
    """The pages of all dated folders, each a path of its own, as one table of records."""
    landed = _landed_register(t)
    files = t.spark._jvm.org.apache.hadoop.fs
    system = files.Path(landed).getFileSystem(t.spark._jsc.hadoopConfiguration())
    paths = sorted(d.getPath().toString() for d in system.listStatus(files.Path(landed)))
    return catalogs.read_record_pages(t.spark, paths, _text_schema("registre", "municipi"))


@query("""
SELECT strftime(o_orderdate, '%Y') || '0101/' || repeat('0', greatest(0, 8 - length(o))) || o || '.json' AS page,
       COUNT(*) AS row_count
FROM (SELECT o_orderdate, CAST((o_orderkey // 1000) * 1000 AS VARCHAR) AS o FROM orders) GROUP BY 1""")
def landing_rows_per_file(t: Tables) -> DataFrame:
    """A10: rows of each landed file, told apart by folder and name."""
    landing = read_landing_json(t.spark, _landed_register(t, 1000))
    named = F.regexp_extract(F.col("_metadata.file_path"), rf"{PARTITION}=(\d+/\d+\.json)$", 1)
    return landing.groupBy(named.alias("page")).agg(F.count("*").alias("row_count"))


_MUNICIPALS = T.StructType([
    T.StructField("codi", T.LongType()),
    T.StructField("nom", T.StringType()),
    T.StructField("codi_comarca", T.IntegerType()),
    T.StructField("nom_comarca", T.StringType()),
])


def _two_snapshots(t: Tables) -> str:
    """A municipality catalog with an older snapshot that spells names in lower case."""
    folder = run_folder(t.spark, "municipals")
    current = roles.municipals(t)
    older = current.withColumn("nom", F.lower("nom"))
    catalogs.write_snapshot(older, folder, "20250101_000000")
    catalogs.write_snapshot(current, folder, "20250809_152821")
    return folder


@query(with_ctes(MUNICIPALS_SQL, select="SELECT * FROM municipals"))
def catalog_latest_snapshot(t: Tables) -> DataFrame:
    return catalogs.read_latest_snapshot(t.spark, _two_snapshots(t), _MUNICIPALS)


@query(with_ctes(MUNICIPALS_SQL, select="""
SELECT DISTINCT codi, nom FROM (
  SELECT codi, nom FROM municipals UNION ALL SELECT codi, lower(nom) FROM municipals)"""))
def catalog_all_snapshots(t: Tables) -> DataFrame:
    every = catalogs.read_all_snapshots(t.spark, _two_snapshots(t), _MUNICIPALS)
    return every.select("codi", "nom").distinct()


@query("""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS order_year, COUNT(*) AS row_count,
       CAST(SUM(CASE WHEN year(o_orderdate) = 1998 THEN -o_custkey ELSE o_custkey END) AS BIGINT)
         AS checksum
FROM orders GROUP BY 1""")
def partition_rewrite(t: Tables) -> DataFrame:
    """All partitions are written, then one of them again; the others must stay."""
    base = run_folder(t.spark, "orders")
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("order_year")
    )
    tables.write_partition(rows, base, "order_year")
    changed = rows.where("order_year = '1998'").withColumn("o_custkey", -F.col("o_custkey"))
    tables.write_partition(changed.drop("order_year"), base, "order_year", "1998")
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("order_year", T.StringType()),
    ])
    return tables.read_table(t.spark, base, schema, "order_year").groupBy("order_year").agg(
        F.count("*").alias("row_count"), F.sum("o_custkey").alias("checksum")
    )


@query("""
SELECT o_orderkey, '1998' AS order_year FROM orders WHERE year(o_orderdate) = 1998""")
def partition_read(t: Tables) -> DataFrame:
    """One partition by key and value, the key kept as text."""
    base = run_folder(t.spark, "orders")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").cast("string").alias("order_year"))
    tables.write_partition(rows, base, "order_year")
    return tables.read_partition(t.spark, base, "order_year", "1998")


_TYPE_CODES = {
    "STANDARD": "RES-003", "SMALL": "RES-001", "MEDIUM": "RES-002", "LARGE": "DAY-001",
    "ECONOMY": "TUT-001",
}


@query("""
-- fixed values: five entries of the service catalog
SELECT code AS service_type_id, description AS service_type_description, COUNT(*) AS parts
FROM part LEFT JOIN (VALUES
  ('STANDARD', 'RES-003', 'Servei de residència assistida per a gent gran de caràcter temporal o permanent'),
  ('SMALL', 'RES-001', 'Servei d'' habitatge tutelat per a gent gran de caràcter temporal o permanent'),
  ('MEDIUM', 'RES-002', 'Servei de llar residència per a gent gran de caràcter temporal o permanent'),
  ('LARGE', 'DAY-001', 'Servei de centre de dia per a gent gran de caràcter temporal o permanent'),
  ('ECONOMY', 'TUT-001', 'Servei de tutela per a gent gran')) c(type, code, description)
  ON p_type = type
GROUP BY 1, 2""")
def literal_catalog_lookup(t: Tables) -> DataFrame:
    """Parts described through the literal service catalog."""
    described = catalogs.literal_catalog(
        t.spark, SERVICE_TYPES, "service_type_id", "service_type_description"
    )
    coded = t.part.select(recode_value(F.col("p_type"), _TYPE_CODES).alias("code"))
    rows = lookup(coded, described, "code", "service_type_id", {
        "service_type_id": "service_type_id",
        "service_type_description": "service_type_description",
    })
    return rows.groupBy("service_type_id", "service_type_description").agg(
        F.count("*").alias("parts")
    )


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS codi, s_name AS nom, '2025-08-09T00:00:00' AS created_at
FROM supplier""")
def catalog_from_records(t: Tables) -> DataFrame:
    """Wanted columns the records lack (the county's) are left out."""
    records = t.supplier.select(
        F.col("s_acctbal").alias("saldo"), F.col("s_name").alias("nom"),
        F.col("s_suppkey").cast("string").alias("codi"),
    )
    return catalogs.catalog_from_records(records, created_at="2025-08-09T00:00:00")


@query("""
SELECT 'municipals' AS catalog, COUNT(*) AS row_count,
       CASE WHEN COUNT(*) = 0 THEN 'error' WHEN COUNT(*) < 100 THEN 'warn' ELSE 'ok' END AS status
FROM supplier
UNION ALL VALUES ('service_type', 66, 'warn'), ('service_qualification', 3, 'warn')""")
def catalog_build(t: Tables) -> DataFrame:
    """Snapshots of the three catalogs, with the row-count rule applied to each."""
    folder = run_folder(t.spark, "catalogs")
    records = roles.municipals(t).select(*[F.col(c).cast("string") for c in catalogs.MUNICIPAL_COLUMNS])
    status = build_catalogs(records, folder, "20250809_152821")
    read = zip(status.items(), read_catalogs(t.spark, folder))
    return union_all([
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("catalog"), "row_count", F.lit(rule).alias("status"))
        for (name, rule), df in read
    ])


@query(CUBE_SQL)
def census_landing(t: Tables) -> DataFrame:
    """Census cubes landed as JSON documents, read with their index as raw JSON and decoded."""
    folder = run_folder(t.spark, "census")
    cubes = census_cubes(t).drop("vec_id")
    as_arrays = {
        name: F.struct(F.struct(
            member_codes(F.col(f"dimension.{name}.category.index")).alias("index")
        ).alias("category")).alias(name)
        for name in ("YEAR", "MUN")
    }
    cubes.withColumn("dimension", F.struct(*as_arrays.values())).write.json(folder)
    landed = read_landing_json(t.spark, folder, CENSUS_CUBE, _JSON_LINES, json_lines=True)
    return staging_population(landed)


@query(with_ctes(MART_SQL, select="SELECT * FROM mart"))
def publish_mart(t: Tables) -> DataFrame:
    """The mart written to staging and promoted unchanged."""
    folder = run_folder(t.spark, "mart")
    tables.write_parquet_snappy(roles.mart(t), f"{folder}/staging")
    tables.publish_mart(t.spark, f"{folder}/staging", f"{folder}/marts")
    return tables.read_table(t.spark, f"{folder}/marts")


def _served(t: Tables, name: str) -> DataFrame:
    """One of the eight serving tables, exported as JSON rows and loaded again."""
    types = t.part.select(
        F.col("p_type").alias("service_type_id"), F.lower("p_type").alias("service_type_description")).distinct()
    flags = t.lineitem.select(F.col("l_returnflag").alias("service_qualification_id")).distinct()
    table = serving_tables(
        roles.population(t), roles.mart(t), roles.municipals(t), types, flags,
        first=roles.FIRST, last=roles.LAST, service_type=roles.RESIDENCE, measure_type=roles.WIDE,
    )[name]
    folder = run_folder(t.spark, "serving")
    tables.write_serving_json({name: table}, folder)
    return tables.read_serving_json(t.spark, folder, name, table.schema)


_CENSUS = (MUNICIPALS_SQL, POPULATION_SQL, COUNTY_POPULATION_SQL)


@query(with_ctes(*_CENSUS, select="SELECT * FROM county_population"))
def serving_json_roundtrip(t: Tables) -> DataFrame:
    return _served(t, "comarca_population")


@query(with_ctes(MART_SQL, MUNICIPALS_SQL, PANEL_SQL, select="SELECT * FROM panel"))
def served_panel(t: Tables) -> DataFrame:
    return _served(t, "social_services_empty_last_year")


@query(with_ctes(MART_SQL, *_CENSUS, TOWN_COVERAGE_SQL, select="SELECT * FROM town_coverage"))
def served_municipal_coverage(t: Tables) -> DataFrame:
    return _served(t, "municipal_coverage")


@query(with_ctes(MART_SQL, *_CENSUS, COUNTY_COVERAGE_SQL, select="SELECT * FROM county_coverage"))
def served_comarca_coverage(t: Tables) -> DataFrame:
    return _served(t, "comarca_coverage")


@query(with_ctes(MUNICIPALS_SQL, select="SELECT * FROM municipals"))
def served_municipal(t: Tables) -> DataFrame:
    return _served(t, "municipal")


@query("SELECT DISTINCT p_type AS service_type_id, lower(p_type) AS service_type_description FROM part")
def served_service_type(t: Tables) -> DataFrame:
    return _served(t, "service_type")


@query("SELECT DISTINCT l_returnflag AS service_qualification_id FROM lineitem")
def served_service_qualification(t: Tables) -> DataFrame:
    return _served(t, "service_qualification")


@query(with_ctes(POPULATION_SQL, select="SELECT * FROM population"))
def served_population(t: Tables) -> DataFrame:
    return _served(t, "population")


@query(with_ctes(MUNICIPALS_SQL, POPULATION_SQL, COUNTY_POPULATION_SQL,
                 select="SELECT * FROM county_population ORDER BY comarca_id, year"))
def serving_order(t: Tables) -> DataFrame:
    """O3: a serving table in its row order."""
    by_county = roles.county_population(t, roles.population(t))
    return tables.in_serving_order("comarca_population", by_county)


@query("SELECT DISTINCT p_name FROM part")
def csv_distinct_values(t: Tables) -> DataFrame:
    """Distinct values of a column as CSV."""
    path = run_folder(t.spark, "csv")
    tables.write_csv_distinct(t.part, "p_name", path)
    return t.spark.read.schema(_text_schema("p_name")).option("header", True).csv(path)


@query(with_ctes(MART_SQL, select="""
SELECT 'capacity_mart' AS dataset, COUNT(*) AS row_count,
       'service_qualification_id,service_type_id,comarca_id,municipal_id,year,month,total_capacit'
         AS columns FROM mart"""))
def sink_audit(t: Tables) -> DataFrame:
    """The audit row of a written mart, counted while it is written."""
    folder = run_folder(t.spark, "audit")
    names = [f.name for f in CAPACITY_MART.fields]
    tables.write_audited(
        roles.mart(t).select(*names), "capacity_mart", f"{folder}/audit",
        lambda df, seen: tables.replace_table(df, f"{folder}/mart", seen))
    return t.spark.read.parquet(f"{folder}/audit").select("dataset", "row_count", "columns")


@query(with_ctes(_REGISTER_ROWS, select="""
SELECT registre, tipologia, inscripcio, capacitat, municipi, nullif(qualificacio, 'null') AS qualificacio,
       CASE WHEN comarca = 'Val d''Aran' THEN 'Aran' ELSE comarca END AS comarca, downloaded_date
FROM register"""))
def incremental_landing(t: Tables) -> DataFrame:
    """Register pages land in two waves; the second wave also brings the first date's pages again."""
    landed = _landed_register(t)
    folder = run_folder(t.spark, "incremental")
    files = t.spark._jvm.org.apache.hadoop.fs
    configuration = t.spark._jsc.hadoopConfiguration()
    system = files.Path(landed).getFileSystem(configuration)
    system.mkdirs(files.Path(f"{folder}/landing"))
    days = sorted((d.getPath() for d in system.listStatus(files.Path(landed))), key=lambda p: p.getName())
    for wave in (days[::2], days[1::2]):
        for day in wave:
            system.rename(day, files.Path(f"{folder}/landing/{day.getName()}"))
        if wave and wave[0] != days[0]:
            again = files.Path(f"{folder}/landing/{days[0].getName()}")
            for page in system.listStatus(again):
                # pages are padded to eight digits only, so no page name of more digits starts with 0
                copy = files.Path(again, f"0{page.getPath().getName()}")
                files.FileUtil.copy(system, page.getPath(), system, copy, False, configuration)
        stream = landing_stream(t.spark, f"{folder}/landing")
        follow_landing(stream, f"{folder}/landing", f"{folder}/clean", f"{folder}/progress").awaitTermination()
    columns = ("registre", "tipologia", "inscripcio", "capacitat", "municipi", "comarca", "qualificacio")
    return tables.read_table(t.spark, f"{folder}/clean", _text_schema(*columns, PARTITION), PARTITION)
