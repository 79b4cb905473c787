"""Queries of the parsing and canonicalisation of ingredient lines, and the SQL that DuckDB can check them by.

The SQL is put together of stages, each a table that adds columns to the one before it, as the
rules build upon each other. Brackets are taken off four times, more than the test tables nest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpot.functions import words as W
from stockpot.operators.ingredients import split_text
from stockpot.plans.catalog import canonical_ingredients, canonical_lines, review_queue
from stockpot.queries_catalog import _NAME, _uuid_sql, registry
from stockpot.queries_functions import _CLEAN, _KIND, _core_sql, _LAST, _SINGULAR, _values
from stockpot.session import cut, table

QUERIES, SQL, query = registry()

_GLYPHS = "".join(W.FRACTIONS)
_AMOUNT = rf"(?:[0-9]+(?:[./][0-9]+)?|[{_GLYPHS}]|to)"


def _clean(x: str) -> str:
    return _CLEAN.format(x)


def _null(x: str) -> str:
    return f"nullif({x}, '')"


class Stages:
    """A WITH clause that grows by one table at a time."""

    def __init__(self, first: str) -> None:
        self.parts, self.n = [f"t0 AS ({first})"], 0

    def add(self, **columns: str) -> Stages:
        listed = ", ".join(f"{x} AS {name}" for name, x in columns.items())
        self.parts.append(f"t{self.n + 1} AS (SELECT *, {listed} FROM t{self.n})")
        self.n += 1
        return self

    def sql(self, last: str) -> str:
        return f"WITH {', '.join(self.parts)} " + last.replace("{t}", f"t{self.n}")


def _amounts_apart(t: str) -> str:
    """The text of an ingredient with its amounts written in one way."""
    t = f"replace({t}, '⁄', '/')"
    t = f"regexp_replace({t}, '([0-9])([{_GLYPHS}])', '\\1 \\2', 'g')"
    for glyph, to in W.FRACTIONS.items():
        t = f"replace({t}, '{glyph}', '{to}')"
    for pattern, to in (
        (r"(^|\s)/([0-9])", r"\g1/\2"), (r"([0-9])\s*/\s+([0-9]+/[0-9]+\b)", r"\1 \2"), (r"(^|\s)[~≈](\s*[0-9])", r"\1\2"), ("[–—]", " - "),
        (r"([0-9])([A-Za-z])", r"\1 \2"), (r"([0-9])\s*-\s*([A-Za-z])", r"\1 \2"), (r"\s+", " "),
    ):
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'g')".replace(r"\g1/", r"\11/")
    return f"trim({t})"


def _measured(s: Stages, text: str, as_: str) -> Stages:
    """Adds <as_>_quantity, _unit and _rest of a column of text."""
    is_amount = f"(x = '-' OR regexp_full_match(trim(lower(trim(x, '()[]{{}}.,:;')), '-'), '{_AMOUNT}(?:-+{_AMOUNT})?'))"
    s.add(**{f"{as_}_w": f"list_filter(string_split({_amounts_apart(_clean(text))}, ' '), lambda x: x <> '')"})
    s.add(**{f"{as_}_n": f"coalesce(nullif(list_position(list_transform({as_}_w, lambda x: NOT {is_amount}), true), 0) - 1, len({as_}_w))"})
    s.add(**{f"{as_}_quantity": _null(f"array_to_string(list_filter({as_}_w[1:{as_}_n], lambda x: x <> '-'), ' ')"), f"{as_}_r": f"{as_}_w[{as_}_n + 1:]"})
    s.add(**{f"{as_}_unit": f"CASE WHEN lower(rtrim({as_}_r[1], '.')) IN ({_values(W.UNITS)}) THEN rtrim({as_}_r[1], '.') END"})
    s.add(**{f"{as_}_a": f"{as_}_r[CASE WHEN {as_}_unit IS NOT NULL THEN 2 ELSE 1 END:]"})
    return s.add(**{f"{as_}_rest": _clean(f"array_to_string({as_}_a[CASE WHEN lower({as_}_a[1]) = 'of' THEN 2 ELSE 1 END:], ' ')")})


def _bare(t: str) -> str:
    """A text without brackets that enclose all of it."""
    t = _clean(t)
    for _ in range(4):
        inner = f"substr(y, 2, greatest(length(y) - 2, 0))"
        marks = f"regexp_replace({inner}, '[^()]', '', 'g')"
        for _ in range(4):
            marks = f"replace({marks}, '()', '')"
        t = f"list_transform([{t}], lambda y: CASE WHEN y LIKE '(%' AND y LIKE '%)' AND length(y) > 1 AND {marks} = '' THEN {_clean(inner)} ELSE y END)[1]"
    return t


def _without_notes(t: str) -> str:
    own = r"(?i)[(][^)]*see notes?[^)]*[)][0-9]*[)]?"
    cut = f"trim(regexp_replace(regexp_replace(y, '{own}', '', 'g'), '\\s+', ' ', 'g'))"
    for pattern, to in ((r"\s+[0-9]+[)]$", ")"), (r"\s+[0-9]+$", ""), (r"(\b[A-Za-z])\s+[0-9]+([)]|$)", r"\1\2"), (r"[(]\s*[)]", ""), (r"\s+", " ")):
        cut = f"regexp_replace({cut}, '{pattern}', '{to}', 'g')"
    return f"list_transform([{_clean(t)}], lambda y: CASE WHEN regexp_matches(y, '{own}') THEN trim({cut}) ELSE y END)[1]"


def _clean_name(s: Stages, text: str, as_: str) -> Stages:
    """Adds <as_>_name: the cleaned name of a column of text."""
    s.add(**{f"{as_}_o": _without_notes(text)})
    s.add(**{f"{as_}_b": _bare(f"{as_}_o")})
    _measured(s, f"{as_}_b", as_)
    return s.add(**{f"{as_}_name": f"coalesce({_null(f'{as_}_rest')}, {_null(f'{as_}_b')}, {as_}_o)"})


def _count(t: str, c: str) -> str:
    return f"(length({t}) - length(replace({t}, '{c}', '')))"


def _minus_closers(t: str, n: str) -> str:
    return _clean(f"regexp_replace({t}, '(?:[)]\\s*){{0,' || greatest({n}, 0) || '}}$', '')")


def _balanced(s: Stages, name: str, preparation: str, as_: str) -> Stages:
    s.add(**{f"{as_}_cn": _clean(name), f"{as_}_cp": _null(_clean(f"coalesce({preparation}, '')"))})
    s.add(**{f"{as_}_m": f"greatest({_count(f'{as_}_cn', '(')} - {_count(f'{as_}_cn', ')')}, 0)"})
    return s.add(**{f"{as_}_bn": _clean(f"{as_}_cn || repeat(')', {as_}_m)"), f"{as_}_bp": f"CASE WHEN {as_}_m > 0 THEN {_null(_minus_closers(f'{as_}_cp', f'{as_}_m'))} ELSE {as_}_cp END"})


def _parsed(s: Stages, text: str, as_: str) -> Stages:
    """Adds <as_>m_quantity, <as_>m_unit, <as_>p_bn (the name) and <as_>p_bp (the preparation) of a column of text."""
    s.add(**{f"{as_}o": _clean(text)})
    s.add(**{f"{as_}s": f"CASE WHEN contains({as_}o, ',') THEN ',' WHEN contains({as_}o, ' - ') THEN ' - ' WHEN contains({as_}o, ' – ') THEN ' – ' END"})
    s.add(**{f"{as_}base": f"CASE WHEN {as_}s IS NULL THEN {as_}o ELSE left({as_}o, instr({as_}o, {as_}s) - 1) END", f"{as_}prep": f"CASE WHEN {as_}s IS NOT NULL THEN {_clean(f'substr({as_}o, instr({as_}o, {as_}s) + length({as_}s))')} END"})
    s.add(**{f"{as_}bare": _bare(f"{as_}base")})
    _measured(s, f"{as_}bare", f"{as_}m")
    _clean_name(s, f"{as_}m_rest", f"{as_}c")
    _clean_name(s, f"{as_}o", f"{as_}d")
    s.add(**{f"{as_}name": f"coalesce({_null(f'{as_}c_name')}, {_null(f'{as_}d_name')}, {as_}o)"})
    return _balanced(s, f"{as_}name", f"{as_}prep", f"{as_}p")


@query(_parsed(Stages("SELECT DISTINCT concat_ws(' ', quantity, unit, name) AS text FROM ingredient_line"), "text", "x").sql("SELECT text, xm_quantity AS quantity, xm_unit AS unit, xp_bn AS name, xp_bp AS preparation FROM {t}"))
def split_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "ingredient_line").select(F.concat_ws(" ", "quantity", "unit", "name").alias("text")).distinct()
    return split_text(texts, "text")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once: what is filtered afterwards must not carry the long expressions along
    return cut(canonical_lines(table(spark, sf_dir, "recipe_doc"), "rec_no", "pos"), "lines")


def _excess(t: str) -> str:
    """A text without the closing brackets at its end that nothing opens."""
    over = f"({_count('y', ')')} - {_count('y', '(')})"
    own = _null(_clean(f"coalesce({t}, '')"))
    return f"list_transform([{own}], lambda y: CASE WHEN {over} > 0 THEN {_null(_minus_closers('y', over))} ELSE y END)[1]"


def _without_digits(t: str) -> str:
    own = _null(_clean(f"coalesce({t}, '')"))
    return _null(f"trim(regexp_replace(regexp_replace({own}, '\\s+[0-9]+([)]|$)', '\\1', 'g'), '\\s+', ' ', 'g'))")


def _normalized(s: Stages) -> Stages:
    """Adds n_name, n_quantity, n_unit, n_preparation of lines: quantity, unit, name, normalized_name, preparation."""
    part = lambda c: _null(_clean(f"coalesce({c}, '')"))
    s.add(raw=f"concat_ws(' ', {part('quantity')}, {part('unit')}, {part('name')})", own="coalesce(name, '')", norm="coalesce(normalized_name, '')")
    _parsed(s, "raw", "x")
    _clean_name(s, "own", "e")
    _clean_name(s, "norm", "f")
    s.add(chosen=f"coalesce(CASE WHEN {_clean('own')} LIKE '(%' AND {_clean('own')} LIKE '%)' THEN {_null('f_name')} END, {_null('xp_bn')}, {_null('e_name')}, name)")
    s.add(closed=f"coalesce({_excess('chosen')}, chosen)", told=_null(_without_notes(f"coalesce(xp_bp, {part('preparation')}, '')")))
    s.add(named=f"coalesce({_without_digits('closed')}, closed)", prepared=_without_digits(_excess("told")))
    _balanced(s, "named", "prepared", "z")
    return s.add(n_name="z_bn", n_preparation="z_bp", n_quantity="coalesce(xm_quantity, quantity)", n_unit="coalesce(xm_unit, unit)")


def _canonical() -> Stages:
    """Lines with way, core, prep, compound and issues."""
    s = Stages("SELECT rec_no, slug AS recipe_slug, recipe_name, nth, x.pos AS position, x.name AS name, x.normalized_name AS normalized_name, x.quantity AS quantity, x.unit AS unit, x.preparation AS preparation FROM (SELECT rec_no, slug, name AS recipe_name, generate_subscripts(ingredients, 1) AS nth, unnest(ingredients) AS x FROM recipe_doc) WHERE x IS NOT NULL")
    _normalized(s)
    s.add(base0=_clean("n_name"), parts0="CAST([] AS VARCHAR[])")
    for i in range(4):
        inner = f"list_filter(list_transform(regexp_extract_all(base{i}, '[(]([^()]*)[)]', 1), lambda p: {_clean('p')}), lambda p: p <> '')"
        s.add(**{f"base{i + 1}": _clean(f"regexp_replace(base{i}, '[(][^()]*[)]', ' ', 'g')"), f"parts{i + 1}": f"parts{i} || {inner}"})
    s.add(kinds=f"list_transform(list_transform(parts4, lambda q: {_NAME.format('q')}), lambda n: {_KIND})", short=_core_sql("base4"))
    s.add(core=f"left(short, length(short) - length({_LAST.format('short')})) || {_SINGULAR.format(_LAST.format('short'))}", tail=_null(f"regexp_extract(base4, '(?i)(\\s+(?:{'|'.join(W.TAIL_VERBS)})\\b.*)$', 1)"))
    s.add(every="array_to_string(list_filter([nullif(n_preparation, '')] || list_filter(list_transform(parts4, lambda p, i: CASE WHEN kinds[i] = 'preparation' THEN p END), lambda p: p IS NOT NULL) || [tail], lambda p: p IS NOT NULL), ' ')")
    plain = f"trim(regexp_replace({_NAME.format('every')}, '\\boptional\\b', '', 'g'))"
    compounds = "CASE core " + " ".join(f"WHEN '{k}' THEN [{_values(v)}]" for k, v in W.COMPOUNDS.items()) + " END"
    s.add(prep=_null(f"trim(regexp_replace({plain}, '\\s+', ' ', 'g'), ' -/')"), compound=compounds)
    out = lambda c: f"({_clean(c)} = '' OR regexp_matches(lower({_clean(c)}), '{'|'.join(W.EXCLUDED)}'))"
    heading = f"({_clean('n_name')} LIKE '>>%' AND trim(ltrim({_clean('n_name')}, '>')) LIKE '%:')"
    s.add(way=f"CASE WHEN {heading} THEN 'heading' WHEN {out('base4')} OR {out('core')} THEN 'excluded' WHEN compound IS NOT NULL THEN 'split' WHEN regexp_matches(core, '\\b(or|and/or)\\b') THEN 'review' ELSE 'canonicalized' END")
    issue = "CASE k WHEN 'optional' THEN 'optional' WHEN 'ambiguous' THEN 'ambiguous_parenthetical' WHEN 'alias' THEN 'alias_parenthetical' END"
    reason = "CASE way WHEN 'excluded' THEN 'excluded_non_ingredient' WHEN 'split' THEN 'compound_split' WHEN 'review' THEN 'ambiguous_connector' END"
    return s.add(issues=f"list_sort(list_distinct(list_filter(list_transform(kinds, lambda k: {issue}) || [{reason}], lambda k: k IS NOT NULL)))")


_KEPT = f"""SELECT document, position, {_uuid_sql('ingredient', 'normalized_name')} AS ingredient_id, name, normalized_name, quantity, unit, preparation FROM (
  SELECT rec_no AS document, CAST(row_number() OVER (PARTITION BY rec_no ORDER BY nth, i) AS INTEGER) AS position, v AS name, {_NAME.format('v')} AS normalized_name, CASE WHEN way = 'canonicalized' THEN n_quantity END AS quantity, CASE WHEN way = 'canonicalized' THEN n_unit END AS unit, prep AS preparation FROM (
    SELECT *, unnest(kept) AS v, generate_subscripts(kept, 1) AS i FROM (SELECT *, CASE way WHEN 'canonicalized' THEN [core] WHEN 'split' THEN compound ELSE [] END AS kept FROM {{t}})))"""


@query(_canonical().sql(_KEPT))
def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_ingredients(_lines(spark, sf_dir))


_REVIEW = f"""SELECT {_uuid_sql('recipe', 'recipe_slug')} AS recipe_id, recipe_slug, recipe_name, position, {_clean("concat_ws(' ', nullif(n_quantity, ''), nullif(n_unit, ''), nullif(n_name, ''))")} AS original_text, n_quantity AS quantity, n_unit AS unit, nullif(core, '') AS cleaned_name,
  coalesce(array_to_string(compound, '|'), '') AS replacements, array_to_string(issues, '|') AS issue_types, way AS resolution FROM {{t}} WHERE way <> 'heading' AND (way <> 'canonicalized' OR len(issues) > 0)"""


@query(_canonical().sql(_REVIEW))
def review_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_queue(_lines(spark, sf_dir))
    return rows.withColumns({c: F.array_join(c, "|") for c in ("replacements", "issue_types")})
