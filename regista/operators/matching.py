"""Free-text place names to official codes by token overlap within a county.

The best match of a name depends only on its county and its set of tokens, so rows are first reduced to
one for each county and set, on both sides; an official set keeps its smallest code.

No name is compared with all names of its county. A key is a few tokens of a set, taken in one order for
the county: rarest first. A key that at most a fixed number of official sets hold is rare. Names that
share it meet the sets behind it one by one. A key that more of them hold is frequent: it answers at once with
its number of tokens and the smallest code behind it, and grows by each later token of the sets that hold
it. What a name shares with its best match is either a frequent key, whose answer is then exact, or
begins with a rare key, over which the two meet. So the search is exact for any number and length of names,
and a name meets a bounded number of sets for each of its keys.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.functions.text import split_tokens, token_key
from regista.workspace import settle

#: official sets of tokens that may hold a key before it counts as frequent
FREQUENT = 32


def _by_rarity(sets: DataFrame) -> DataFrame:
    """``sets`` with ``ordered``: their tokens that official sets of the county hold, rarest first."""
    single = sets.select("county", "tokens", "official", "best", F.explode("tokens").alias("token"))
    spread = single.where("official").groupBy("county", "token").agg(F.count("*").alias("names"))
    return single.join(spread, ["county", "token"]).groupBy("county", "tokens", "official").agg(
        F.array_sort(F.collect_list(F.struct("names", "token"))).alias("known"), F.first("best").alias("best")).select(
        "county", "tokens", "official", "best", F.col("known.token").alias("ordered"))


def _first_keys(sets: DataFrame) -> DataFrame:
    """One row for each token of a set; ``last`` is the place of its key's last token in the order."""
    rest = ("county", "tokens", "official", "best", "ordered")
    return sets.select(*rest, F.posexplode("ordered").alias("last", "token")).select(*rest, "last", F.array("token").alias("key"))


def _grown(keys: DataFrame) -> DataFrame:
    """Each row once for each later token of its set, which the key takes in."""
    later = F.slice("ordered", F.col("last") + 2, F.greatest(F.size("ordered") - F.col("last") - 1, F.lit(0)))
    rest = ("county", "tokens", "official", "best", "ordered")
    return keys.select(*rest, "key", F.col("last").alias("at"), F.posexplode(later).alias("step", "token")).select(
        *rest, (F.col("at") + F.col("step") + 1).alias("last"), F.concat("key", F.array("token")).alias("key"))


def _counted(keys: DataFrame) -> DataFrame:
    """The rows of keys that both sides hold, with the official sets behind a key and the best of them."""
    behind = keys.groupBy("county", "key").agg(
        F.count_if("official").alias("names"), F.min(F.when(F.col("official"), F.col("best"))).alias("answer"),
        F.bool_or(~F.col("official")).alias("sought")).where("sought AND names > 0").drop("sought")
    return keys.join(behind, ["county", "key"])


def _best_by_keys(sets: DataFrame, frequent: int) -> DataFrame:
    """(county, tokens, top): for each sought set that shares a token with an official one, the best match.

    ``top`` is (minus the shared tokens, best). There are as many rounds as the longest frequent key has
    tokens, and one more; each is written once.
    """
    keys = _first_keys(_by_rarity(sets))
    found: list[DataFrame] = []
    while True:
        round_ = settle(_counted(keys))
        rare, often = round_.where(F.col("names") <= frequent), round_.where(F.col("names") > frequent)
        behind = rare.where("official").select("county", "key", F.col("tokens").alias("held"), "best")
        met = rare.where("NOT official").select("county", "tokens", "key").join(behind, ["county", "key"])
        found.append(met.select("county", "tokens", F.struct(
            (-F.size(F.array_intersect("tokens", "held"))).alias("rank"), "best").alias("top")))
        found.append(often.where("NOT official").select("county", "tokens", F.struct(
            (-F.size("key")).alias("rank"), F.col("answer").alias("best")).alias("top")))
        if often.isEmpty():
            break
        keys = _grown(often)
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every.groupBy("county", "tokens").agg(F.min("top").alias("top"))


def match_places(
    names: DataFrame,
    catalog: DataFrame,
    county: str = "comarca",
    place: str = "municipi",
    catalog_county: str = "nom_comarca",
    catalog_name: str = "nom",
    code: str = "codi",
    carry: Sequence[str] = ("codi_comarca",),
    frequent: int = FREQUENT,
) -> DataFrame:
    """(county, place, code, carried columns, tokens_similar), one row per distinct pair.

    The best match has the most shared tokens; ties go to the smallest code, NULL codes last. A
    NULL name shares nothing. Counties the catalog does not have give no row.
    """
    pairs = (
        names.where(F.col(county).isNotNull())
        .select(F.col(county).alias("county"), F.col(place).alias("place"))
        .distinct()
        .withColumn("tokens", split_tokens(token_key(F.col("place"))))
    )
    best = F.struct(
        F.col(code).isNull().alias("no_code"), F.col(code).alias("code"),
        *[F.col(c).alias(c) for c in carry],
    )
    official = settle(
        catalog.where(F.col(catalog_county).isNotNull())
        .select(F.col(catalog_county).alias("county"), split_tokens(token_key(F.col(catalog_name))).alias("tokens"), best.alias("best"))
        .groupBy("county", "tokens")
        .agg(F.min("best").alias("best"))
    )
    sought = pairs.select("county", "tokens", F.lit(None).cast(official.schema["best"].dataType).alias("best")).distinct()
    matched = _best_by_keys(
        official.withColumn("official", F.lit(True)).unionByName(sought.withColumn("official", F.lit(False))), frequent)

    # the smallest code of the county stands in for names that share nothing
    smallest = official.groupBy("county").agg(F.min("best").alias("smallest"))
    nothing = F.struct(F.lit(0).alias("rank"), F.col("smallest").alias("best"))
    top = pairs.join(smallest, "county").join(matched, ["county", "tokens"], "left").withColumn(
        "top", F.coalesce("top", nothing))
    return top.select(
        F.col("county").alias(county),
        F.col("place").alias(place),
        F.col("top.best.code").alias(code),
        *[F.col(f"top.best.{c}").alias(c) for c in carry],
        (-F.col("top.rank")).alias("tokens_similar"),
    )


def attach_places(
    rows: DataFrame, matches: DataFrame, county: str = "comarca", place: str = "municipi"
) -> DataFrame:
    """Rows with the columns of their match; NULL where the county is unknown.

    A row without a county has no match, a row without a place name has its county's.
    """
    side = matches.withColumnsRenamed({county: "__county", place: "__place"})
    same = (rows[county] == F.col("__county")) & rows[place].eqNullSafe(F.col("__place"))
    return rows.join(side, same, "left").drop("__county", "__place")
