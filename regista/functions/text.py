"""Place-name normalisation and token overlap."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from regista.fixed_values import FOLDED_ACCENTS, FOLDED_TO


def strip_accents(c: Column) -> Column:
    """Folds the listed acute and grave vowels; ç, ñ, ï and ü stay.

    The look for any of them first is cheap, and spares most texts the character-wise mapping.
    """
    folded = F.translate(c, FOLDED_ACCENTS, FOLDED_TO)
    return F.when(c.rlike(f"[{FOLDED_ACCENTS}]"), folded).otherwise(c)


def non_letters_to_space(c: Column) -> Column:
    """Every run of characters that are not Unicode letters becomes one space."""
    return F.regexp_replace(c, r"\P{IsAlphabetic}++", " ")


def normalize_name(c: Column) -> Column:
    """Lower-case letter tokens joined by single spaces.

    Tokens of one byte are dropped. After lower-casing and keeping letters only, those are
    exactly the lone a-z, so a lone two-byte letter such as ``ç`` survives. One regex pass turns
    each gap, together with any lone letters in it, into one space; no array is built.
    """
    letter, other = r"[a-z\p{IsAlphabetic}]", r"[^a-z\p{IsAlphabetic}]"
    gap = f"(?:{other}++|^)(?:[a-z](?!{letter}){other}*+)*+"
    return F.trim(F.regexp_replace(strip_accents(F.lower(c)), gap, " "))


def split_tokens(name: Column) -> Column:
    """Tokens of a normalised name; an empty name has none, a NULL name stays NULL."""
    return F.array_remove(F.split(name, " "), F.lit(""))


def name_tokens(c: Column) -> Column:
    """Tokens of :func:`normalize_name`."""
    return split_tokens(normalize_name(c))


def token_key(c: Column) -> Column:
    """The token *set* as text: distinct tokens, sorted, joined by spaces; NULL gives ''.

    Two names have the same overlap with any third name when their keys are equal.
    """
    tokens = F.array_sort(F.array_distinct(name_tokens(c)))
    return F.coalesce(F.array_join(tokens, " "), F.lit(""))


def shared_token_count(tokens_a: Column, tokens_b: Column) -> Column:
    """Size of the intersection of two token sets; 0 when either is NULL."""
    return F.coalesce(F.array_size(F.array_intersect(tokens_a, tokens_b)), F.lit(0))


def token_similarity(a: Column, b: Column) -> Column:
    """Number of distinct tokens two names share; 0 when either is NULL."""
    return shared_token_count(name_tokens(a), name_tokens(b))


def strip_quotes(c: Column) -> Column:
    """Removes double quotes."""
    return F.replace(c, F.lit('"'), F.lit(""))
