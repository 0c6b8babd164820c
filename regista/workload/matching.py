"""Name normalisation, place matching and the staging register."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.fixed_values import COUNTY_RECODES
from regista.functions.scalar import recode_value
from regista.functions.text import name_tokens, normalize_name
from regista.functions.text import token_similarity as similarity
from regista.operators.matching import match_places
from regista.operators.quality import by_match_quality
from regista.operators.quality import unmatched_names as without_match
from regista.plans.staging import staging_register as build_staging
from regista.sources.catalogs import literal_catalog
from regista.workload.registry import Tables, query
from regista.workload.roles import with_ctes
from regista.workspace import settle


def tokens_sql(text: str) -> str:
    """Tokens of a name in SQL: fold, blank out non-letters, split, keep two bytes or more."""
    folded = f"translate(lower({text}), 'áàéèíìóòúù', 'aaeeiioouu')"
    letters = f"regexp_replace({folded}, '[^\\p{{L}}\\s]', ' ', 'g')"
    return f"list_filter(regexp_split_to_array({letters}, '\\s+'), lambda w: strlen(w) > 1)"


@query(f"""
SELECT doc_id, array_to_string(tokens, ' ') AS normalized,
       CAST(len(list_distinct(tokens)) AS INTEGER) AS token_count
FROM (SELECT doc_id, {tokens_sql("text")} AS tokens FROM documents)""")
def normalize_tokens(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        normalize_name(F.col("text")).alias("normalized"),
        F.array_size(F.array_distinct(name_tokens(F.col("text")))).alias("token_count"),
    )


@query(f"""
SELECT a.conv_id, a.turn, CAST(len(list_intersect({tokens_sql("a.text")}, {tokens_sql("b.text")}))
       AS INTEGER) AS shared
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def token_similarity(t: Tables) -> DataFrame:
    said = t.conversations.select("conv_id", "turn", "text")
    replied = t.conversations.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    return said.join(replied, ["conv_id", "turn"]).select(
        "conv_id", "turn", similarity(F.col("text"), F.col("reply")).alias("shared")
    )


def _register(t: Tables) -> DataFrame:
    """Line items as raw register text: the part names the place, its brand the county."""
    part = t.part.select(
        "p_partkey",
        F.col("p_type").alias("tipologia"),
        F.concat("p_name", F.lit(", el ("), F.lower("p_type"), F.lit(")")).alias("municipi"),
        F.when(F.col("p_brand") == "Brand#3", "Val d'Aran").otherwise(F.col("p_brand"))
        .alias("comarca"),
    )
    return t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.format_string("S%012d", F.col("l_orderkey")).alias("registre"),
        "tipologia",
        F.col("l_shipdate").cast("date").cast("string").alias("inscripcio"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("int").cast("string"))
        .otherwise("abc").alias("capacitat"),
        "municipi",
        "comarca",
        F.when(F.col("l_returnflag") == "N", "null").otherwise(F.col("l_returnflag"))
        .alias("qualificacio"),
    )


def _official_places(t: Tables) -> DataFrame:
    """Parts as official places, coded by part key.

    Those of Brand#25 lie in a county of another name, those of Brand#7 are spelt backwards.
    """
    county = F.when(F.col("p_brand") == "Brand#3", "Aran").when(
        F.col("p_brand") == "Brand#25", "elsewhere").otherwise(F.col("p_brand"))
    name = F.concat_ws(" ", "p_type", F.replace("p_name", F.lit(" "), F.lit(" d'")))
    return t.part.select(
        F.col("p_partkey").alias("codi"),
        F.when(F.col("p_brand") == "Brand#7", F.reverse(name)).otherwise(name).alias("nom"),
        F.concat(F.lit("C"), "p_brand").alias("codi_comarca"),
        county.alias("nom_comarca"),
    )


_REGISTER_SQL = """register AS (
  SELECT printf('S%012d', l_orderkey) AS registre, p_type AS tipologia,
         CAST(l_shipdate AS DATE) AS inscripcio,
         CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INTEGER) END AS capacitat,
         p_name || ', el (' || lower(p_type) || ')' AS municipi,
         CASE WHEN p_brand = 'Brand#3' THEN 'Aran' ELSE p_brand END AS comarca,
         nullif(l_returnflag, 'N') AS qualificacio
  FROM lineitem JOIN part ON l_partkey = p_partkey),
official AS (
  SELECT p_partkey AS codi,
         CASE WHEN p_brand = 'Brand#7' THEN reverse(p_type || ' ' || replace(p_name, ' ', ' d'''))
              ELSE p_type || ' ' || replace(p_name, ' ', ' d''') END AS nom,
         'C' || p_brand AS codi_comarca,
         CASE p_brand WHEN 'Brand#3' THEN 'Aran' WHEN 'Brand#25' THEN 'elsewhere' ELSE p_brand END AS nom_comarca
  FROM part)"""

_MATCH_SQL = f"""wanted AS (
  SELECT DISTINCT comarca, municipi, {tokens_sql("municipi")} AS tokens FROM register),
candidate AS (
  SELECT codi, codi_comarca, nom_comarca, {tokens_sql("nom")} AS tokens FROM official),
scored AS (
  SELECT w.comarca, w.municipi, c.codi, c.codi_comarca,
         CAST(len(list_intersect(w.tokens, c.tokens)) AS INTEGER) AS tokens_similar
  FROM wanted w JOIN candidate c ON c.nom_comarca = w.comarca),
matched AS (
  SELECT * FROM scored QUALIFY row_number() OVER (
    PARTITION BY comarca, municipi ORDER BY tokens_similar DESC, codi) = 1)"""

def _places(t: Tables) -> DataFrame:
    """The distinct place texts of the register, settled: the matching reads them several times."""
    county = recode_value(F.col("comarca"), COUNTY_RECODES)
    return settle(_register(t).select(county.alias("comarca"), "municipi").distinct())


@query(with_ctes(_REGISTER_SQL, _MATCH_SQL, select="""
SELECT comarca, municipi, codi, codi_comarca, tokens_similar
FROM matched"""))
def fanout_join_match(t: Tables) -> DataFrame:
    return match_places(_places(t), _official_places(t))


@query(with_ctes(_REGISTER_SQL, _MATCH_SQL, select="""
SELECT comarca, municipi, codi, codi_comarca, tokens_similar
FROM matched WHERE tokens_similar = 0"""))
def unmatched_names(t: Tables) -> DataFrame:
    return without_match(match_places(_places(t), _official_places(t)))


@query(with_ctes(_REGISTER_SQL, _MATCH_SQL, select="""
SELECT comarca, municipi, tokens_similar FROM matched"""))
def weakest_matches_first(t: Tables) -> DataFrame:
    matches = match_places(_places(t), _official_places(t)).select(
        "comarca", "municipi", "tokens_similar"
    )
    return by_match_quality(matches, "comarca", "municipi")


@query(with_ctes(_REGISTER_SQL, _MATCH_SQL, select="""
SELECT registre AS social_service_register_id, inscripcio AS inscription_date,
       capacitat AS capacity, 'T-' || tipologia AS service_type_id,
       'Q-' || qualificacio AS service_qualification_id,
       m.codi AS municipal_id, m.codi_comarca AS comarca_id
FROM (SELECT DISTINCT * FROM register) r
LEFT JOIN matched m ON m.comarca = r.comarca AND m.municipi = r.municipi"""))
def staging_register(t: Tables) -> DataFrame:
    types = t.part.select(F.col("p_type").alias("value")).distinct()
    flags = literal_catalog(
        t.spark, {"Q-A": "A", "Q-R": "R"},
        "service_qualification_id", "service_qualification_description",
    )
    described = types.select(
        F.concat(F.lit("T-"), "value").alias("service_type_id"),
        F.col("value").alias("service_type_description"),
    )
    return build_staging(_register(t), _official_places(t), described, flags)
