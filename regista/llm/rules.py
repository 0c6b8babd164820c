"""Quality rules as a ledger of failure bits: measured once, judged by any number of policies.

:func:`ledger` measures every document and sets one bit for each rule it fails; :func:`open_ledger`
writes that once. Policies are masks over these bits, so a new policy, or the question what a rule
alone removes, reads the written ledger and not the texts. Everything is built-in functions; a
document never leaves its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.workspace import settle

_GAP = r"[ \t-\r]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: rule -> when a document fails it; a rule's bit is its place here, so rules are only ever appended
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}
#: policy version -> its rules
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(version: str) -> int:
    return sum(bit(rule) for rule in POLICIES[version])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words inside windows that occur twice or more: equal windows are neighbours once sorted.

    Only a text that holds equal windows at all is sorted.
    """
    hashes = _let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))

    def repeated(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]).eqNullSafe(F.lit(True))
                        | (F.get(ordered, k + 1)["h"] == x["h"]).eqNullSafe(F.lit(True)))

    def covered(windows: Column) -> Column:
        numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        places = F.sort_array(F.transform(_let(F.sort_array(numbered), repeated), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(places, start, lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"])

    count = _let(hashes, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(count).cast("bigint")


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, failures).

    One row for each row of ``docs``; null text counts as empty, which fails ``few_words`` only.
    Lines count if they hold a word, and as repeated if equal to an earlier one of the text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.col("__text"), f"{_GAP}+"), "")
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda x: F.regexp_replace(x, _GAP, "") != "")
    counted = F.struct(*[c for c in (
        _let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"),
                                       _repeated_words(w).alias("n_repeat_words"))).alias("words"),
        F.length(F.regexp_replace(F.col("__text"), _GAP, "")).cast("bigint").alias("word_chars"),
        (F.length(F.col("__text")) - F.length(F.regexp_replace(F.col("__text"), SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"),
                                       (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))).alias("lines"),
    )])
    measured = docs.select("doc_id", text.alias("__text")).select("doc_id", F.explode(F.array(counted)).alias("m")).select(
        "doc_id", "m.words.n_words", "m.word_chars", "m.n_symbols", "m.lines.n_lines", "m.lines.n_dup_lines",
        "m.words.n_repeat_words")
    failures = " + ".join(f"if({condition}, {bit(rule)}L, 0L)" for rule, condition in RULES.items())
    return measured.withColumn("failures", F.expr(failures))


def open_ledger(docs: DataFrame) -> DataFrame:
    """The ledger of ``docs``, written once: verdicts and ablations read it from there."""
    return settle(ledger(docs))


def judged(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """``entries`` with ``base_failed`` and ``kept`` under a policy version."""
    return (entries.withColumn("base_failed", F.col("failures").bitwiseAND(F.lit(mask("base"))) != 0)
            .withColumn("kept", _kept(version)))


def _kept(version: str) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask("base") | mask(version))) == 0


def verdicts(entries: DataFrame) -> DataFrame:
    """:func:`judged` under the current policy, with a column ``kept_<version>`` for every version.

    Null measurements do not occur in a ledger; equal rows are judged alike and all stay.
    """
    return judged(entries).select("*", *[_kept(version).alias(f"kept_{version}") for version in POLICIES])


def ablations(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """(rule, failed, failed_alone): what each rule of a policy removes, and removes as the only one.

    Counts come from one row for each pattern of failure bits, of which there are few.
    """
    patterns = _patterns(entries).select(F.col("failures").bitwiseAND(F.lit(mask(version))).alias("bits"), "rows")
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("bigint").alias("bit")) for r in POLICIES[version]])
    return patterns.select("bits", "rows", F.explode(rules).alias("r")).groupBy("r.rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("rows")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("rows")).otherwise(0)).alias("failed_alone"))


def _patterns(entries: DataFrame) -> DataFrame:
    """(failures, rows): at most one row for each set of rules."""
    return entries.groupBy("failures").agg(F.count("*").alias("rows"))


def policy_ablations(entries: DataFrame) -> DataFrame:
    """(version, rule, failed, failed_alone, kept, kept_without) for every rule of every policy.

    ``kept`` is what the policy keeps, ``kept_without`` what it would keep without the rule. All
    versions are judged from one pass over the ledger; an empty ledger gives no rows.
    """
    steps = F.array(*[F.struct(F.lit(version).alias("version"), F.lit(rule).alias("rule"),
                               F.lit(mask(version)).cast("bigint").alias("mask"), F.lit(bit(rule)).cast("bigint").alias("bit"))
                      for version, chosen in POLICIES.items() for rule in chosen])
    own = F.col("failures").bitwiseAND(F.col("s.mask"))

    def rows(when: Column) -> Column:
        return F.sum(F.when(when, F.col("rows")).otherwise(0))

    return _patterns(entries).select("failures", "rows", F.explode(steps).alias("s")).groupBy("s.version", "s.rule").agg(
        rows(own.bitwiseAND(F.col("s.bit")) != 0).alias("failed"), rows(own == F.col("s.bit")).alias("failed_alone"),
        rows(own == 0).alias("kept"), rows((own == 0) | (own == F.col("s.bit"))).alias("kept_without"))


def failed_anywhere(entries: DataFrame, *by: str) -> DataFrame:
    """For each group: the rules any of its documents fails, and those all of them fail, as bits."""
    return entries.groupBy(*by).agg(F.bit_or("failures").alias("any_failed"), F.bit_and("failures").alias("all_failed"),
                                    F.count("*").alias("rows"))


#: the measurements in DuckDB, window by window
_MEASURED = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
repeated AS (SELECT r, win FROM windows GROUP BY r, win HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT i + j) AS n
  FROM windows JOIN repeated USING (r, win), (SELECT unnest(range(0, 5)) AS j)
  GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (r))"""

#: the verdicts rule by rule, without masks
ORACLE = _MEASURED + r"""
, f AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         10 * n_symbols > n_words AS symbols,
         2 * (len(lines) - len(list_distinct(lines))) > len(lines)
           OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS shape
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT symbols AND NOT shape AS kept,
       CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
         + CASE WHEN symbols THEN 4 ELSE 0 END
         + CASE WHEN 2 * n_dup_lines > len(lines) THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
         + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failures,
       NOT base_failed AS kept_base, NOT base_failed AND NOT symbols AS kept_v1,
       NOT base_failed AND NOT symbols AND NOT shape AS kept_v2
FROM f"""

#: each rule on its own and each policy without it, from the measurements
ABLATIONS_ORACLE = _MEASURED + r"""
, t AS (
  SELECT n_words < 10 AS few_words, 100 * n_repeat_words > 20 * n_words AS repeated_words,
         10 * n_symbols > n_words AS many_symbols,
         2 * (len(lines) - len(list_distinct(lines))) > len(lines) AS repeated_lines,
         word_chars < 2 * n_words AS short_words, word_chars > 15 * n_words AS long_words
  FROM m),
u AS (UNPIVOT (SELECT row_number() OVER () AS id, * FROM t)
      ON few_words, repeated_words, many_symbols, repeated_lines, short_words, long_words INTO NAME rule VALUE fails),
p (version, rules) AS (
  VALUES ('base', ['few_words', 'repeated_words']), ('v1', ['few_words', 'repeated_words', 'many_symbols']),
         ('v2', ['few_words', 'repeated_words', 'many_symbols', 'repeated_lines', 'short_words', 'long_words'])),
x AS (
  SELECT version, rule, fails, sum(CASE WHEN fails THEN 1 ELSE 0 END) OVER (PARTITION BY version, id) AS n
  FROM u JOIN p ON list_contains(rules, rule))
SELECT version, rule, CAST(count(*) FILTER (fails) AS BIGINT) AS failed,
       CAST(count(*) FILTER (fails AND n = 1) AS BIGINT) AS failed_alone,
       CAST(count(*) FILTER (n = 0) AS BIGINT) AS kept,
       CAST(count(*) FILTER (n = 0 OR fails AND n = 1) AS BIGINT) AS kept_without
FROM x GROUP BY version, rule"""
