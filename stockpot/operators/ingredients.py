"""Ingredient lines parsed, cleaned and made canonical, with a review of doubtful ones.

The steps are columns of one projection after another over flat lines, so Catalyst sees
plain expressions; nothing is shuffled until documents are put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.functions.ids import entity_id
from stockpot.functions.text import TAIL, clean_page, core_name, empty_to_null, let, normalize_name, preparation_text, unescape
from stockpot.functions.words import AMOUNT, AMOUNT_STEPS, BUILD_PREPARATIONS, COMPOUNDS, CONNECTOR, EXCLUDED, FRACTIONS, NOTE, NOTE_DIGITS, PAGE_UNITS, UNITS



def ingredient_text(text: Column) -> Column:
    """One way of writing amounts: ASCII fractions, spaced dashes, digits apart from letters."""
    # most names have neither a number nor a dash: one look spares them all steps
    some = f"[0-9⁄–—~≈{''.join(FRACTIONS)}]"
    return let(clean_page(text), lambda t: F.when(t.rlike(some), _with_plain_amounts(t)).otherwise(t))


def _with_plain_amounts(text: Column) -> Column:
    glyphs = "".join(FRACTIONS)
    table = F.map_entries(F.str_to_map(F.lit(";".join(f"{g}={to}" for g, to in FRACTIONS.items())), F.lit(";"), F.lit("=")))

    def plain(t: Column) -> Column:
        apart = F.regexp_replace(t, rf"(\d)(?=[{glyphs}])", "$1 ")
        return F.aggregate(table, apart, lambda acc, x: F.replace(acc, x["key"], x["value"]))

    t = let(F.replace(text, F.lit("⁄"), F.lit("/")), lambda v: F.when(v.rlike(f"[{glyphs}]"), plain(v)).otherwise(v))
    for pattern, to in AMOUNT_STEPS:
        t = F.regexp_replace(t, pattern, to)
    return F.trim(t)


def is_amount(token: Column) -> Column:
    """A number, fraction, decimal, fraction character, the word to, or a range of two of them."""
    plain = F.btrim(F.lower(F.btrim(token, F.lit("()[]{}.,:;"))), F.lit("-"))
    return plain.rlike(rf"^{AMOUNT}(?:-+{AMOUNT})?$")


def measured(text: Column, units: list[str]) -> Column:
    """quantity, unit and rest of an ingredient text: leading amounts, one unit, the word of."""
    def counted(tokens: Column) -> Column:
        first = F.array_position(F.transform(tokens, lambda t: ~((t == "-") | is_amount(t))), True).cast("int")
        return let(F.when(first > 0, first - 1).otherwise(F.size(tokens)), lambda n: parted(tokens, n))

    def parted(tokens: Column, n: Column) -> Column:
        quantity = empty_to_null(F.array_join(F.filter(F.slice(tokens, 1, n), lambda t: t != "-"), " "))
        return let(F.slice(tokens, n + 1, F.size(tokens)), lambda rest: let(unit_of(rest), lambda unit: named(quantity, unit, rest)))

    def unit_of(rest: Column) -> Column:
        return let(F.rtrim(F.get(rest, F.lit(0)), F.lit(".")), lambda head: F.when(F.lower(head).rlike(f"^(?:{'|'.join(units)})$"), head))

    def named(quantity: Column, unit: Column, rest: Column) -> Column:
        after = F.slice(rest, F.when(unit.isNotNull(), 2).otherwise(1), F.size(rest))
        name = let(after, lambda a: clean_page(F.array_join(F.slice(a, F.when(F.lower(F.get(a, F.lit(0))) == "of", 2).otherwise(1), F.size(a)), " ")))
        return F.struct(quantity.alias("quantity"), unit.alias("unit"), name.alias("rest"))

    return let(F.filter(F.split(ingredient_text(text), " "), lambda t: t != ""), counted)


def _turns(text: Column) -> Column:
    """As many entries as a text has opening brackets, one at least: no rule on brackets needs more turns until nothing changes."""
    return F.sequence(F.lit(1), F.greatest(_count(text, "("), F.lit(1)))


def _encloses(text: Column) -> Column:
    """Whether the bracket that a text begins with is closed by its last character."""
    inner = F.filter(F.split(F.regexp_replace(F.substr(text, F.lit(2), F.length(text) - 2), "[^()]", ""), ""), lambda c: c != "")
    depth = F.aggregate(inner, F.lit(0), lambda acc, c: F.when(acc < 0, acc).when(c == "(", acc + 1).otherwise(acc - 1))
    return text.startswith("(") & text.endswith(")") & (F.length(text) > 1) & (depth == 0)


def without_outer_brackets(text: Column) -> Column:
    """A text without brackets that enclose all of it."""
    peel = lambda t, _: F.when(_encloses(t), clean_page(F.substr(t, F.lit(2), F.length(t) - 2))).otherwise(t)
    return let(clean_page(text), lambda whole: F.when(whole.startswith("("), F.aggregate(_turns(whole), whole, peel)).otherwise(whole))


def without_notes(text: Column) -> Column:
    """A text without references to notes and, if there were any, the digits they leave at the end."""
    return let(clean_page(text), _without_notes)


def _without_notes(t: Column) -> Column:
    once = lambda acc, _: F.trim(F.regexp_replace(F.regexp_replace(acc, NOTE, ""), r"\s+", " "))
    return F.when(t.rlike(NOTE), let(F.aggregate(_turns(t), t, once), lambda c: F.when(c != t, _without_digits(c)).otherwise(t))).otherwise(t)


def _without_digits(cut: Column) -> Column:
    left = cut
    for pattern, to in NOTE_DIGITS:
        left = F.regexp_replace(left, pattern, to)
    return F.trim(left)


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _minus_closers(text: Column, most: Column) -> Column:
    """A text without at most so many closing brackets at its end."""
    return clean_page(F.regexp_replace(text, F.concat(F.lit(r"(?:\)\s*){0,"), F.greatest(most, F.lit(0)).cast("string"), F.lit("}$")), F.lit("")))


def balanced(name: Column, preparation: Column) -> Column:
    """name and preparation after closing brackets that the name lacks have come back to it."""
    p = empty_to_null(clean_page(preparation))
    return let(clean_page(name), lambda n: let(F.greatest(_count(n, "(") - _count(n, ")"), F.lit(0)), lambda missing: let(p, lambda q: _moved(n, q, missing))))


def _moved(n: Column, p: Column, missing: Column) -> Column:
    return F.struct(clean_page(F.concat(n, F.repeat(F.lit(")"), missing))).alias("name"), F.when(missing > 0, empty_to_null(_minus_closers(p, missing))).otherwise(p).alias("preparation"))


def without_excess_closers(text: Column) -> Column:
    fewer = lambda t: let(_count(t, ")") - _count(t, "("), lambda excess: F.when(excess > 0, empty_to_null(_minus_closers(t, excess))).otherwise(t))
    return let(empty_to_null(clean_page(text)), fewer)


def without_reference_digits(text: Column) -> Column:
    return empty_to_null(F.trim(F.regexp_replace(F.regexp_replace(empty_to_null(clean_page(text)), r"\s+\d+(?=\)|$)", ""), r"\s+", " ")))


def clean_name(text: Column, units: list[str] = UNITS, notes: bool = True) -> Column:
    """An ingredient's name without note references, outer brackets and measurement."""
    name = without_notes(text) if notes else clean_page(text)
    return let(name, lambda n: let(without_outer_brackets(n), lambda bare: F.coalesce(empty_to_null(measured(bare, units)["rest"]), empty_to_null(bare), n)))


def is_heading(text: Column) -> Column:
    """Whether a line is the heading of a section, such as ``>> For the sauce:``."""
    return let(clean_page(text), _is_heading)


def _is_heading(t: Column) -> Column:
    return t.startswith(">>") & F.trim(F.regexp_replace(t, "^>+", "")).endswith(":")


def is_excluded(text: Column) -> Column:
    """Whether a text is empty or names what is no ingredient."""
    return let(F.lower(clean_page(text)), lambda t: (t == "") | t.rlike("|".join(EXCLUDED)))


def parsed_text(text: Column, page: bool = False) -> Column:
    """quantity, unit, name and preparation of a free text, as a struct.

    What follows the first comma, else a spaced dash, is the preparation. page: as pages are
    read, without note references and without moving brackets. A null or empty text has an empty name.
    """
    units = PAGE_UNITS if page else UNITS

    def parted(o: Column) -> Column:
        separator = F.when(o.contains(","), ",").when(o.contains(" - "), " - ").when(o.contains(" – "), " – ")
        return let(F.coalesce(separator, F.lit("\x00")), lambda sep: let(F.instr(o, sep), lambda at: based(o, F.when(at > 0, F.substr(o, F.lit(1), at - 1)).otherwise(o), F.when(at > 0, clean_page(F.substr(o, at + F.length(sep)))))))

    def based(o: Column, base: Column, prep: Column) -> Column:
        return let(measured(without_outer_brackets(base), units), lambda m: let(prep, lambda p: named(o, m, p)))

    def named(o: Column, m: Column, prep: Column) -> Column:
        name = F.coalesce(empty_to_null(clean_name(m["rest"], units, not page)), empty_to_null(clean_name(o, units, not page)), o)
        pair = F.struct(name.alias("name"), prep.alias("preparation")) if page else balanced(name, prep)
        return let(pair, lambda n: F.struct(m["quantity"].alias("quantity"), m["unit"].alias("unit"), n["name"].alias("name"), n["preparation"].alias("preparation")))

    return let(clean_page(text), parted)


def split_text(df: DataFrame, text: str, prefix: str = "", page: bool = False) -> DataFrame:
    """df with the parts of parsed_text as columns behind a prefix."""
    parts = df.withColumn("_parts", parsed_text(F.col(text), page))
    return parts.withColumns({f"{prefix}{c}": F.col(f"_parts.{c}") for c in ("quantity", "unit", "name", "preparation")}).drop("_parts")


def normalized_line(x: Column) -> Column:
    """A line's quantity, unit, name, preparation, normalized_name and ingredient_id read anew, as a struct.

    The stored quantity, unit and name are joined and parsed again; what the text does not tell
    is kept as stored.
    """
    part = lambda c: empty_to_null(clean_page(x[c]))

    def read(raw: Column) -> Column:
        return let(parsed_text(raw), lambda new: let(own_name(new), lambda name: let(own_preparation(new), lambda prep: let(balanced(name, prep), lambda pair: named(raw, new, pair)))))

    def own_name(new: Column) -> Column:
        first = F.coalesce(empty_to_null(new["name"]), empty_to_null(clean_name(x["name"])), x["name"])
        enclosed = let(clean_page(x["name"]), lambda n: n.startswith("(") & n.endswith(")"))
        chosen = F.coalesce(F.when(enclosed, empty_to_null(clean_name(x["normalized_name"]))), first)
        open_ = let(chosen, lambda n: F.coalesce(without_excess_closers(n), n))
        return let(open_, lambda n: F.coalesce(without_reference_digits(n), n))

    def own_preparation(new: Column) -> Column:
        return without_reference_digits(without_excess_closers(empty_to_null(without_notes(F.coalesce(new["preparation"], part("preparation"))))))

    def named(raw: Column, new: Column, pair: Column) -> Column:
        key = F.coalesce(empty_to_null(normalize_name(pair["name"])), normalize_name(raw))
        return let(key, lambda k: F.struct(entity_id("ingredient", k).alias("ingredient_id"), pair["name"].alias("name"), k.alias("normalized_name"), F.coalesce(new["quantity"], x["quantity"]).alias("quantity"), F.coalesce(new["unit"], x["unit"]).alias("unit"), pair["preparation"].alias("preparation")))

    return let(F.concat_ws(" ", part("quantity"), part("unit"), part("name")), read)


FIELDS = ("ingredient_id", "name", "normalized_name", "quantity", "unit", "preparation")


def normalize_lines(lines: DataFrame) -> DataFrame:
    """Lines with the fields of normalized_line, HTML entities resolved first. Other columns stay."""
    cleaned = lines.withColumns({c: unescape(F.col(c)) for c in FIELDS[1:]})
    out = cleaned.withColumn("_line", let(F.struct(*FIELDS), normalized_line))
    return out.withColumns({c: F.col(f"_line.{c}") for c in FIELDS}).drop("_line")


def bracket_parts(text: Column) -> Column:
    """base and parts: a text without its brackets, and their contents, the innermost first."""
    start = F.struct(clean_page(text).alias("base"), F.array().cast("array<string>").alias("parts"))

    def peel(acc: Column, _: Column) -> Column:
        inner = F.filter(F.transform(F.regexp_extract_all(acc["base"], F.lit(r"\(([^()]*)\)"), 1), clean_page), lambda p: p != "")
        return F.struct(clean_page(F.regexp_replace(acc["base"], r"\([^()]*\)", " ")).alias("base"), F.concat(acc["parts"], inner).alias("parts"))

    return F.aggregate(_turns(F.coalesce(text, F.lit(""))), start, peel)


def bracket_kind(part: Column) -> Column:
    """ignore, optional, ambiguous, preparation or alias, in this order."""
    return let(normalize_name(part), _kind_of)


def _kind_of(n: Column) -> Column:
    return (
        F.when(n == "", "ignore")
        .when(n.rlike("^optional(?: |$)"), "optional")
        .when(n.rlike(CONNECTOR), "ambiguous")
        .when(F.arrays_overlap(F.split(n, r"\s+"), F.split(F.lit(" ".join(BUILD_PREPARATIONS)), " ")), "preparation")
        .otherwise("alias")
    )


def canonical_line(x: Column) -> Column:
    """kept (the canonical ingredients, 0 to 2) and review (null if there is nothing to say) of a normalised line.

    A heading is dropped in silence, what is no ingredient goes to review as excluded, a known
    compound is split, an ambiguous name goes to review and out of the recipe, all else is kept.
    """
    compound = F.create_map(*(c for name, parts in COMPOUNDS.items() for c in (F.lit(name), F.array(*map(F.lit, parts)))))

    def based(b: Column) -> Column:
        kinds = F.transform(b["parts"], lambda p: F.struct(p.alias("part"), bracket_kind(p).alias("kind")))
        return let(kinds, lambda k: let(core_name(b["base"]), lambda core: let(prepared(b["base"], k), lambda prep: let(compound[core], lambda parts: let(way(b["base"], core, parts), lambda w: routed(k, core, prep, parts, w))))))

    def prepared(base: Column, kinds: Column) -> Column:
        told = F.transform(F.filter(kinds, lambda k: k["kind"] == "preparation"), lambda k: k["part"])
        tail = empty_to_null(F.regexp_extract(base, TAIL.replace("(?i)", "(?i)(", 1) + ")", 1))
        return preparation_text(F.array_join(F.array_compact(F.concat(F.array(empty_to_null(x["preparation"])), told, F.array(tail))), " "))

    def way(base: Column, core: Column, parts: Column) -> Column:
        return F.when(is_heading(x["name"]), "heading").when(is_excluded(base) | is_excluded(core), "excluded").when(parts.isNotNull(), "split").when(core.rlike(CONNECTOR), "review").otherwise("canonicalized")

    def one(name: Column, quantity: Column, unit: Column, prep: Column) -> Column:
        return let(normalize_name(name), lambda n: F.struct(entity_id("ingredient", n).alias("ingredient_id"), name.alias("name"), n.alias("normalized_name"), quantity.alias("quantity"), unit.alias("unit"), prep.alias("preparation")))

    def routed(kinds: Column, core: Column, prep: Column, parts: Column, w: Column) -> Column:
        nothing = F.lit(None).cast("string")
        kept = F.when(w == "canonicalized", F.array(one(core, x["quantity"], x["unit"], prep))).when(w == "split", F.transform(parts, lambda p: one(p, nothing, nothing, prep)))
        issues = F.array_compact(F.transform(kinds, lambda k: F.when(k["kind"] == "optional", "optional").when(k["kind"] == "ambiguous", "ambiguous_parenthetical").when(k["kind"] == "alias", "alias_parenthetical")))
        reason = F.when(w == "excluded", "excluded_non_ingredient").when(w == "split", "compound_split").when(w == "review", "ambiguous_connector")
        every = F.array_sort(F.array_distinct(F.array_compact(F.concat(issues, F.array(reason)))))
        text = clean_page(F.concat_ws(" ", *(empty_to_null(x[c]) for c in ("quantity", "unit", "name"))))
        review = let(every, lambda types: F.when(
            (w != "heading") & ((w != "canonicalized") | (F.size(types) > 0)),
            F.struct(text.alias("original_text"), x["quantity"].alias("quantity"), x["unit"].alias("unit"), empty_to_null(core).alias("cleaned_name"), F.coalesce(parts, F.array().cast("array<string>")).alias("replacements"), types.alias("issue_types"), w.alias("resolution")),
        ))
        return F.struct(F.coalesce(kept, F.array().cast(kept_type())).alias("kept"), review.alias("review"))

    return let(bracket_parts(x["name"]), based)


def canonicalize_lines(lines: DataFrame) -> DataFrame:
    """Normalised lines with the columns kept and review of canonical_line."""
    return lines.withColumn("_c", let(F.struct(*FIELDS), canonical_line)).withColumns({"kept": F.col("_c.kept"), "review": F.col("_c.review")}).drop("_c")


def kept_type() -> str:
    return "array<struct<ingredient_id:string,name:string,normalized_name:string,quantity:string,unit:string,preparation:string>>"
