"""Scalar functions on text, as Column expressions.

There are three ways of cleaning a text, for building a catalog, for pages and for repair;
they differ in entities and bullets and are kept apart.
"""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpot.functions.words import AMOUNT_PHRASES, DROPPED_WORDS, IRREGULAR, LEADING_WORDS, TAIL_VERBS

SPACE = r"(?U)[\s\x1c-\x1f]+"
_EDGE = " \t\r\n•▢"
TAIL = rf"(?i)\s+(?:{'|'.join(TAIL_VERBS)})\b.*$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used; keeps expression trees small."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def clean_page(text: Column) -> Column:
    """One blank for each run of white space, bullets cut off the ends; null gives the empty text."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), F.lit(_EDGE))


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape(text: Column) -> Column:
    """HTML entities as the characters they stand for; a text without & crosses into Python as null."""
    some = text.contains("&")
    return F.when(some, _unescape(F.when(some, text))).otherwise(text)


def clean_build(text: Column) -> Column:
    """clean_page after HTML entities are resolved. Rows pass through Python, so for texts that may hold any."""
    return clean_page(unescape(text))


def clean_repair(text: Column) -> Column:
    """White space alone; bullets stay, null gives the empty text."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))


def is_blank(text: Column) -> Column:
    return clean_repair(text) == ""


def normalize_name(text: Column) -> Column:
    """Lower case, without brackets and their content, letters a-z, digits, blanks, / and - alone."""
    plain = F.regexp_replace(F.lower(clean_page(text)), r"\([^)]*\)", "")
    plain = F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9\s/-]", ""), r"\s+", " ")
    return F.btrim(plain, F.lit(" -/"))


def slugify(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(clean_page(text)), "[^a-z0-9]+", "-"), F.lit("-"))


def title_case(text: Column) -> Column:
    """Each piece between blanks, _ and - with a capital and small letters after it; the separators stay."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\s_-]+|[^\s_-]+)"), 1)
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))), "")


def capitalize_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def title_of_slug(slug: Column) -> Column:
    """A title made of a slug: blanks for hyphens, a capital after anything that is no letter."""
    pieces = F.regexp_extract_all(F.lower(F.replace(slug, F.lit("-"), F.lit(" "))), F.lit("([a-z]+|[^a-z]+)"), 1)
    return F.array_join(F.transform(pieces, capitalize_first), "")


def singularize(token: Column) -> Column:
    """A word in the singular by ending; short words and those in ss, us, is and ds stay."""
    return let(token, _singularize)


def _singularize(token: Column) -> Column:
    ends = lambda *e: token.rlike(f"(?:{'|'.join(e)})$")
    cut = lambda n: F.substr(token, F.lit(1), F.length(token) - n)
    irregular = F.create_map(*(F.lit(x) for pair in IRREGULAR.items() for x in pair))[token]
    long = F.length(token) > 4
    rule = (
        F.when((F.length(token) <= 3) | ends("ss", "us", "is"), token)
        .when(ends("ies") & long, F.concat(cut(3), F.lit("y")))
        .when(ends("oes", "ses") & long, cut(2))
        .when(ends("s") & ~ends("ds"), cut(1))
        .otherwise(token)
    )
    return F.coalesce(irregular, rule)


def singularize_last(phrase: Column) -> Column:
    """The last word of a phrase in the singular."""
    return let(phrase, lambda p: F.concat(F.regexp_extract(p, r"^(.*?)\S*$", 1), singularize(F.regexp_extract(p, r"(\S*)$", 1))))


def core_name(text: Column) -> Column:
    """The name that identifies an ingredient: no amount, descriptors, preparation or plural."""
    name = F.regexp_replace(normalize_name(text), "^(?:a )?can of ", "canned ")
    name = F.regexp_replace(name, f"^(?:{'|'.join(AMOUNT_PHRASES)})", "")
    for tail in (r"\bfor boiling\b.*$", r"\bto taste\b.*$"):
        name = F.trim(F.regexp_replace(name, tail, ""))
    name = F.regexp_replace(name, rf"^(?:(?:{'|'.join(LEADING_WORDS)})(?:\s+|$))+", "")
    name = F.trim(F.regexp_replace(name, TAIL, ""))
    words = F.filter(F.split(name, r"\s+"), lambda w: (w != "") & ~w.isin(*DROPPED_WORDS))
    name = F.trim(F.regexp_replace(F.array_join(words, " "), r"\bof$", ""))
    return singularize_last(F.btrim(name, F.lit(" -/")))


def preparation_text(text: Column) -> Column:
    """A preparation as a name without the word optional; null if nothing is left."""
    plain = F.regexp_replace(F.trim(F.regexp_replace(normalize_name(text), r"\boptional\b", "")), r"\s+", " ")
    return empty_to_null(F.btrim(plain, F.lit(" -/")))


def singular_unit(unit: Column) -> Column:
    low = F.lower(unit)
    cut = lambda n: F.substr(low, F.lit(1), F.length(low) - n)
    return F.when(low.endswith("ves"), F.concat(cut(3), F.lit("f"))).when(low.endswith("ies"), F.concat(cut(3), F.lit("y"))).when(low.endswith("s") & ~low.endswith("ss"), cut(1)).otherwise(low)


def plural_unit(unit: Column) -> Column:
    low = F.lower(unit)
    cut = F.substr(low, F.lit(1), F.length(low) - 1)
    return F.when(low.endswith("f"), F.concat(cut, F.lit("ves"))).when(low.rlike("[^aeiou]y$"), F.concat(cut, F.lit("ies"))).when(low.endswith("s"), low).otherwise(F.concat(low, F.lit("s")))


def split_values(text: Column) -> Column:
    """The cleaned, non-empty parts of a text between commas and bars."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[,|]"), clean_page), lambda p: p != "")


def search_blob(*parts: Column) -> Column:
    """One lower-cased text to search in; null parts leave an empty place."""
    return F.lower(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))


def file_name_of_sequence(sequence: Column) -> Column:
    return F.concat(F.lpad(sequence.cast("string"), 10, "0"), F.lit(".json"))


def manifest_path_of_sequence(sequence: Column) -> Column:
    """The place of a manifest below the catalog's folder."""
    return F.concat(F.lit("manifests/"), file_name_of_sequence(sequence))


def asset_url(repository: str, branch: str, path: Column) -> Column:
    """The public address of a file in a repository."""
    return F.concat(F.lit(f"{repository.rstrip('/')}/raw/{branch}/"), F.ltrim(path, F.lit("/")))
