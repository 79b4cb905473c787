"""Problem 6: several values packed in one field, one row per value with its place.

Method. Quoted values are marked, the text is split on the marks, odd pieces are
literals and even pieces are split on delimiters; array functions reassemble the values
in order. All of it runs as SQL expressions inside the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.functions.text import let

# Punctuation and the joining word that part values.
MARKS = ",;/|&+•·\n\r\t"
JOINING = ("and",)
#: Codes that no text should hold mark a quoted value, a possible boundary and a joining word that joins within a name;
#: HIDDEN stand for MARKS and brackets within brackets. A text that holds such codes itself has them escaped by ESCAPE and a letter.
NONCHARACTERS = "".join(map(chr, range(0xFDD0, 0xFDF0)))
QUOTE, EDGE, WITHIN, ESCAPE, HIDDEN = *NONCHARACTERS[:4], NONCHARACTERS[4 : 10 + len(MARKS)]
BRACKETS = "()[]{}"
#: Names with a delimiter that one pattern can hold.
MOST_NAMES = 20_000

_MARK = "[" + re.escape(MARKS).replace("\\\n", "\\n").replace("\\\r", "\\r").replace("\\\t", "\\t") + "]"
_INNERMOST = r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}"
_SHALLOW = r"\((?:[^()]++|\((?:[^()]++|\([^()]*+\))*+\))*+\)|\[[^\[\]]*+\]|\{[^{}]*+\}"
#: Texts with more brackets than those that _SHALLOW is sure to hold whole.
_DEEP = r"(?:\([^(]*+){4}|(?:\[[^\[]*+){2}|(?:\{[^{]*+){2}"
_COUNT = "(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|a|an|[0-9]+)"
_NUMBERS = rf"\d+(?:[.,/]\d+)+|(?<!\w){_COUNT}\s+and\s+(?:(?:an?|one)\s+)?(?:half|third|quarter|\d+/\d+)(?!\w)"
_OPEN = rf"(?:^|(?<={_MARK})|(?<=\s))"
#: "2 packs of 8-oz each" after the name of a thing tells an amount of it and is no value.
_AMOUNT_VALUE = r"(?i)^\d+\s+\w+\s+of\s+\d[\d.,/]*\s*-?\s*\w+\.?\s+each\.?(?:\s*\(.*\))?$"


def _either(joining: tuple[str, ...]) -> str:
    return f"(?:{'|'.join(map(re.escape, joining))})"


def joined_names(names: DataFrame, column: str = "name", joining: tuple[str, ...] = JOINING) -> list[str]:
    """The reference names that hold a delimiter themselves, longest first.

    Only those come to the driver, as one pattern; a list with more than MOST_NAMES of them is an error.
    """
    some = names.where(F.col(column).rlike(rf"{_MARK}|(?i)\b{_either(joining)}\b")).select(F.lower(F.trim(column)).alias("n")).distinct().limit(MOST_NAMES + 1).collect()
    if len(some) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} reference names hold a delimiter")
    return sorted((r.n for r in some if r.n), key=lambda n: (-len(n), n))


def has_delimiter(text: Column, joining: tuple[str, ...] = JOINING) -> Column:
    return text.rlike(rf"{_MARK}|(?i)\s{_either(joining)}\s")


def _escaped(text: Column) -> Column:
    codes = F.array(*map(F.lit, (ESCAPE, *(c for c in NONCHARACTERS if c != ESCAPE))))
    letter = lambda c: F.char(F.lit(65) + F.instr(F.lit(NONCHARACTERS), c) - 1)
    return F.when(text.rlike(f"[{NONCHARACTERS}]"), F.aggregate(codes, text, lambda acc, c: F.replace(acc, c, F.concat(F.lit(ESCAPE), letter(c))))).otherwise(text)


def _unescaped(value: Column) -> Column:
    codes = F.array(*map(F.lit, (*(c for c in NONCHARACTERS if c != ESCAPE), ESCAPE)))
    letter = lambda c: F.char(F.lit(65) + F.instr(F.lit(NONCHARACTERS), c) - 1)
    return F.when(value.contains(ESCAPE), F.aggregate(codes, value, lambda acc, c: F.replace(acc, F.concat(F.lit(ESCAPE), letter(c)), c))).otherwise(value)


def _hidden(piece: Column, word: str) -> Column:
    """A piece with all delimiters within matched brackets hidden, however deep; the innermost pairs go first."""
    hide = lambda m: F.translate(F.regexp_replace(m, rf"(?i)(?<=\s){word}(?=\s)", f"{WITHIN}$0{WITHIN}"), MARKS + BRACKETS, HIDDEN)
    pairs = F.regexp_count(piece, F.lit(r"[\[({]"))
    step = lambda acc, _: F.aggregate(F.regexp_extract_all(acc, F.lit(_INNERMOST), 0), acc, lambda text, m: F.replace(text, m, hide(m)))
    return F.when(piece.rlike(_DEEP), F.aggregate(F.sequence(F.lit(1), pairs), piece, step)).otherwise(piece)


def _mistyped(piece: Column, cores: list[tuple[str, str]], word: str) -> Column:
    """A piece in which the joining word is marked where the words beside it are those of a name, but for an edit or two."""
    if not cores:
        return piece
    letter = rf"[^\s{re.escape(MARKS)}]"
    # a word is tried from its beginning alone, so that texts of any length are read once
    pattern = F.lit(rf"(?i)(?<!{letter})({letter}++)\s+{word}\s+(?=({letter}+))")
    every = lambda i: F.regexp_extract_all(piece, pattern, i)
    edits = lambda typed, name: F.levenshtein(F.lower(typed), F.lit(name), 1 if len(name) <= 4 else 2) >= 0
    any_of = lambda parts: reduce(lambda x, y: x | y, parts)
    of_name = lambda m: any_of(edits(m["before"], a) & edits(m["after"], b) for a, b in cores)
    marked = lambda m: F.concat(F.regexp_replace(m["all"], rf"(?i)(?<=\s){word}(?=\s+$)", f"{WITHIN}$0{WITHIN}"), m["after"])
    met = F.arrays_zip(every(0).alias("all"), every(1).alias("before"), every(2).alias("after"))
    fixed = F.aggregate(F.filter(met, of_name), piece, lambda acc, m: F.replace(acc, F.concat(m["all"], m["after"]), marked(m)))
    # most joining words follow no word that is like the first of a name
    like = F.exists(every(1), lambda w: any_of(edits(w, a) for a, _ in cores))
    return F.when(F.when(piece.rlike(rf"(?i)\s{word}\s"), like).otherwise(False), fixed).otherwise(piece)


def split_packed(text: Column, names: list[str] | None = None, joining: tuple[str, ...] = JOINING) -> Column:
    """The values of a packed text, in order, as an array; null for null, empty for a blank text.

    A value may be quoted by " or ', a doubled quote within it being one quote. Delimiters
    within quotes, matched brackets of any depth, numbers or one of names part nothing, nor
    does a joining word within a mistyped name. Empty values are dropped.
    """
    word = _either(joining)
    delimiter = rf"(?:\s*{_MARK}\s*(?:{word}\s+)?|\s+{word}\s+)"
    close = rf"(?=\s*(?:$|{_MARK}|{word}\s))"
    typed = [(n, re.search(rf"(\S+)\s+{word}\s+(\S+)", n)) for n in names or []]
    cores = list(dict.fromkeys((m[1], m[2]) for _, m in typed if m))
    patterns = dict.fromkeys(p for n, m in typed for p in _patterns(n, m))
    kept = "|".join([_SHALLOW, *(rf"(?<!\w){p}(?:e?s)?(?!\w)" for p in patterns), _NUMBERS])

    def literal(piece: Column) -> Column:
        # the first character tells which quote enclosed the value
        q = F.substring(piece, 1, 1)
        return F.array(F.replace(F.substr(piece, F.lit(2)), F.concat(q, q), q))

    def plain(piece: Column) -> Column:
        known = let(_hidden(piece, word), lambda p: _mistyped(p, cores, word))
        edges = F.regexp_replace(known, rf"(?i)({kept})|({delimiter})", f"$1{EDGE}$2")
        parts = F.split(edges, rf"(?i){EDGE}{delimiter}")
        shown = F.transform(parts, lambda p: F.regexp_replace(p, f"[{EDGE}{WITHIN}]", ""))
        return F.when(piece.rlike(_DEEP), F.transform(shown, lambda p: F.translate(p, HIDDEN, MARKS + BRACKETS))).otherwise(shown)

    marked = _escaped(text)
    for q in "\"'":
        body = rf"{_OPEN}{q}((?:[^{q}{QUOTE}]++|{q}{q})*+){q}{close}"
        marked = F.regexp_replace(marked, body, f"{QUOTE}{q}$1{QUOTE}")
    values = F.flatten(F.transform(F.split(marked, QUOTE), lambda p, i: F.when(i % 2 == 1, literal(p)).otherwise(plain(p))))
    trimmed = F.filter(F.transform(values, lambda v: F.regexp_replace(v, r"(?U)^\s+|\s+$", "")), lambda v: v != "")
    return let(trimmed, lambda vs: F.when(text.rlike(f"[{NONCHARACTERS}]"), F.transform(vs, _unescaped)).otherwise(vs))


#: Letters of the first Latin block by the plain letter they carry an accent on.
_ACCENTED: dict[str, str] = {}
for _c in map(chr, range(0xE0, 0x100)):
    if len(_d := unicodedata.normalize("NFD", _c)) > 1:
        _ACCENTED[_d[0]] = _ACCENTED.get(_d[0], "") + _c


def _patterns(name: str, core: re.Match | None) -> list[str]:
    """Patterns of a reference name as it may be typed, and of the two words that its joining word stands between."""
    letter = lambda c: r"[\s_-]+" if c.isspace() or c == "-" else f"[{c}{_ACCENTED[c]}]" if c in _ACCENTED else c if c.isalnum() else "\\" + c if c.isascii() else c
    return ["".join(map(letter, n)) for n in ([name, core[0]] if core else [name])]


def explode_packed(df: DataFrame, keys: list[str], fields: list[str], names: list[str] | None = None, order: str | None = None, joining: tuple[str, ...] = JOINING) -> DataFrame:
    """keys, field_name, item_no, item: one row per value of each field that holds two or more.

    Of rows that repeat the keys the last by the column order counts, of those at once the
    greatest by its fields. Null fields, blank ones and those with a single value give no rows.
    """
    # of a field without a delimiter nothing but its row is shuffled
    packed = {f: F.when(has_delimiter(F.col(f), joining), F.col(f)).alias(f) for f in fields}
    rows = df.select(*keys, *([F.col(order).alias("_at")] if order else []), *packed.values())
    if order:
        kept = rows
    else:
        kept = rows.where(" or ".join(f"`{f}` is not null" for f in fields)).withColumn("_at", F.lit(0))
    last = kept.groupBy(*keys).agg(F.max(F.struct("_at", *fields)).alias("_r")).select(*keys, *(F.col(f"_r.{f}").alias(f) for f in fields))
    each = F.filter(
        F.array(*(F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("field_name"), F.filter(split_packed(F.col(f), names, joining), lambda v: ~v.rlike(_AMOUNT_VALUE)).alias("items"))) for f in fields)),
        lambda x: x.isNotNull() & (F.size(x["items"]) > 1),
    )
    long = last.where(" or ".join(f"`{f}` is not null" for f in fields)).select(*keys, F.explode(each).alias("_f"))
    return long.select(*keys, F.col("_f.field_name").alias("field_name"), F.posexplode("_f.items").alias("_i", "item")).select(*keys, "field_name", (F.col("_i") + 1).cast("int").alias("item_no"), "item")
