"""Queries of the general problems 3, 6 and 7, and the SQL that DuckDB can check them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpot.operators.nested import common_rows, flatten_columns, flatten_json, variant_tables
from stockpot.operators.packed import _ACCENTED, explode_packed, joined_names
from stockpot.operators.quantities import calibrate, convert_quantities, statements
from stockpot.session import cut, table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = convert_quantities(table(spark, sf_dir, "ingredient_line"), table(spark, sf_dir, "unit_factor"))
    return found.select("line_id", "base_unit", "low_milli", "high_milli")


def p3_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = cut(statements(table(spark, sf_dir, "ingredient_line")), "stated")
    return calibrate(stated, table(spark, sf_dir, "unit_factor"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = joined_names(table(spark, sf_dir, "ingredient_index"))
    return explode_packed(table(spark, sf_dir, "ingredient_line"), ["line_id"], ["name", "preparation"], names, "loaded_at")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return variant_tables(flatten_columns(table(spark, sf_dir, "recipe_doc")).unionByName(flatten_json(table(spark, sf_dir, "recipe_raw"))))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_rows(_tables(spark, sf_dir)).select("rec_no", "child_kind", "section_no", "child_no")


def p7_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table of ingredients stored as objects."""
    return _tables(spark, sf_dir)["ingredient_object"]


def p7_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children of the typed nested columns alone."""
    return flatten_columns(table(spark, sf_dir, "recipe_doc")).select("rec_no", "child_kind", "child_no", F.coalesce("name", "text").alias("name"), "position")


def p7_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many children each subtype, structural variant and shape holds, and in how many documents."""
    return common_rows(_tables(spark, sf_dir)).groupBy("subtype", "variant", "shape").agg(F.count("*").alias("n"), F.countDistinct("rec_no").alias("documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p3_found": p3_found, "p3_scales": p3_scales, "p6_found": p6_found, "p7_found": p7_found, "p7_ingredients": p7_ingredients, "p7_columns": p7_columns, "p7_variants": p7_variants}
_KIND = "SELECT rec_no, '{kind}' AS child_kind, row_number() OVER (PARTITION BY rec_no ORDER BY i) AS child_no, x.{field} AS name, {place} AS position FROM (SELECT rec_no, generate_subscripts({array}, 1) AS i, unnest({array}) AS x FROM recipe_doc) WHERE x IS NOT NULL"
_KINDS = (("ingredient", "ingredients", "name", "x.pos"), ("instruction", "instructions", "text", "x.pos"), ("category", "categories", "name", "NULL"), ("tag", "tags", "name", "NULL"))
_HELD = " UNION ALL ".join(f"SELECT rec_no, '{k}' AS kind, [0] AS path, j->'{a}' AS v FROM doc WHERE json_exists(j, '$.{a}')" for k, a, _, _ in _KINDS) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT rec_no, '{k}', [1], j->'taxonomy'->'{a}' FROM doc WHERE json_type(j, '$.taxonomy') = 'OBJECT' AND json_exists(j, '$.taxonomy.{a}')" for k, a, _, _ in _KINDS
)
_GROUP = "json_type(v) = 'OBJECT' AND json_exists(v, '$.section') AND (" + " OR ".join(f"coalesce(json_type(v, '$.{g}') IN ('NULL', 'ARRAY', 'OBJECT', 'VARCHAR'), false)" for g in ("ingredients", "items", "steps", "instructions", "lines")) + ")"
_INNER = "coalesce(" + ", ".join(f"nullif(v->'{g}', 'null'::JSON)" for g in ("ingredients", "items", "steps", "instructions", "lines")) + ")"
#: Nodes of each kind are taken apart until only children are left; path orders them as stored, and a heading group keeps its own path.
_NESTED = f"""
WITH RECURSIVE doc AS (SELECT rec_no, CASE WHEN json_type(j, '$.recipe') = 'OBJECT' THEN j->'recipe' ELSE j END AS j FROM (SELECT rec_no, body::JSON AS j FROM (SELECT rec_no, CASE WHEN json_valid(body) THEN body ELSE 'null' END AS body FROM recipe_raw)) WHERE json_type(j) = 'OBJECT'),
node AS (
  SELECT rec_no, kind, path, v, CAST(NULL AS INTEGER[]) AS grp, false AS is_group, 0 AS turn FROM ({_HELD})
  UNION ALL
  SELECT rec_no, kind, n.path, n.v, CASE WHEN n.is_group THEN n.path ELSE grp END, n.is_group, turn + 1 FROM (
    SELECT rec_no, kind, grp, turn, unnest(CASE
      WHEN json_type(v) = 'VARCHAR' AND left(trim(v->>'$'), 1) IN ('[', '{{') AND json_valid(v->>'$') THEN [{{'path': path, 'v': (v->>'$')::JSON, 'is_group': false}}]
      WHEN json_type(v) = 'ARRAY' THEN list_transform(from_json(v, '["JSON"]'), lambda x, i: {{'path': path || [i::INTEGER], 'v': x, 'is_group': false}})
      WHEN json_type(v) = 'OBJECT' AND len(json_keys(v)) > 0 AND len(list_filter(json_keys(v), lambda k: NOT regexp_full_match(k, '[0-9]+'))) = 0 THEN list_transform(json_keys(v), lambda k: {{'path': path || [k::INTEGER], 'v': json_extract(v, '$."' || k || '"'), 'is_group': false}})
      WHEN {_GROUP} THEN [{{'path': path || [0], 'v': {_INNER}, 'is_group': true}}] ELSE [] END) AS n FROM node WHERE v IS NOT NULL)),
leaf AS (SELECT * FROM node WHERE v IS NOT NULL AND (json_type(v) IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN') OR json_type(v) = 'VARCHAR' AND trim(v->>'$') <> '' AND NOT (left(trim(v->>'$'), 1) IN ('[', '{{') AND json_valid(v->>'$'))
  OR json_type(v) = 'OBJECT' AND len(json_keys(v)) > 0 AND len(list_filter(json_keys(v), lambda k: NOT regexp_full_match(k, '[0-9]+'))) > 0 AND NOT ({_GROUP}))),
groups AS (SELECT rec_no, kind, path AS grp, row_number() OVER (PARTITION BY rec_no, kind ORDER BY path) AS section_no FROM node WHERE is_group)
SELECT rec_no, kind AS child_kind, coalesce(section_no, 0) AS section_no, row_number() OVER (PARTITION BY rec_no, kind ORDER BY path) AS child_no FROM leaf LEFT JOIN groups USING (rec_no, kind, grp)
UNION ALL SELECT rec_no, child_kind, 0, child_no FROM ({{columns}})"""
_COLUMNS = " UNION ALL ".join(_KIND.format(kind=k, array=a, field=f, place=p) for k, a, f, p in _KINDS)
SQL: dict[str, str] = {"p7_columns": _COLUMNS, "p7_found": _NESTED.replace("{columns}", _COLUMNS)}


def _packed_sql() -> str:
    """The values of packed fields by a scan for tokens: names, brackets, numbers, quoted texts, words, delimiters, single characters."""
    mark = "[,;/|&+•·\\n\\r\\t]"
    delimiter = rf"\s*{mark}\s*(?:and\s+)?|\s+and\s+"
    listed = ("bread-and-butter pickle", "half and half", "50/50 flour blend", "macaroni and cheese mix", "macaroni and cheese")
    names = "|".join("".join(r"[\s_-]+" if c in " -" else f"[{c}{_ACCENTED.get(c, '')}]" for c in n) + r"(?:e?s)?\b" for n in listed)
    brackets = r"[(](?:[^()]|[(](?:[^()]|[(][^()]*[)])*[)])*[)]|\[[^\[\]]*\]|[{][^{}]*[}]"
    count = "(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|an?|[0-9]+)"
    numbers = rf"[0-9]+(?:[.,/][0-9]+)+|\b{count}\s+and\s+(?:(?:an?|one)\s+)?(?:half|third|quarter|[0-9]+/[0-9]+)\b"
    quoted = '"(?:[^"]|"")*"|' + "''(?:[^'']|'''')*''"
    pattern = rf"(?is){names}|{brackets}|{numbers}|{quoted}|\p{{L}}+(?:''\p{{L}}+)*|{delimiter}|."
    near = lambda t, n: f"levenshtein(lower(coalesce({t}, '')), '{n}') <= {1 if len(n) <= 4 else 2}"
    typo = " OR ".join(f"({near('t[i - 1]', a)} AND {near('t[i + 1]', b)})" for a, b in (("half", "half"), ("macaroni", "cheese")))
    trimmed = lambda x: rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
    whole = "array_to_string(list_transform(range(lo, hi), lambda j: t[j]), '')"
    bare = trimmed("x")
    return rf"""
WITH last AS (SELECT * FROM ingredient_line QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY loaded_at DESC NULLS LAST, name DESC NULLS LAST, preparation DESC NULLS LAST) = 1),
f AS (SELECT line_id, 'name' AS field_name, name AS text FROM last UNION ALL SELECT line_id, 'preparation', preparation FROM last),
tok AS (SELECT line_id, field_name, regexp_extract_all(text, '{pattern}') AS t FROM f WHERE text IS NOT NULL),
cut AS (SELECT *, list_filter(range(1, len(t) + 1), lambda i: regexp_full_match(t[i], '(?is){delimiter}') AND NOT (regexp_full_match(t[i], '(?is)\s+and\s+') AND ({typo}))) AS d FROM tok),
span AS (SELECT line_id, field_name, t, unnest([0] || d) + 1 AS lo, unnest(d || [len(t) + 1]) AS hi FROM cut WHERE len(d) > 0),
raw AS (SELECT line_id, field_name, lo, {whole} AS x FROM span),
item AS (SELECT line_id, field_name, lo, CASE WHEN regexp_full_match({bare}, '"(?:[^"]|"")*"') THEN {trimmed(f"replace({bare}[2:-2], '\"\"', '\"')")} WHEN regexp_full_match({bare}, '''(?:[^'']|'''')*''') THEN {trimmed(f"replace({bare}[2:-2], '''''', '''')")} ELSE {bare} END AS item FROM raw),
kept AS (SELECT * FROM item WHERE item <> '' AND NOT regexp_matches(item, '(?i)^[0-9]+\s+\w+\s+of\s+[0-9][0-9.,/]*\s*-?\s*\w+[.]?\s+each[.]?(?:\s*[(].*[)])?$')),
n AS (SELECT *, count(*) OVER (PARTITION BY line_id, field_name) AS n, row_number() OVER (PARTITION BY line_id, field_name ORDER BY lo) AS item_no FROM kept)
SELECT line_id, field_name, CAST(item_no AS INTEGER) AS item_no, item FROM n WHERE n > 1"""


SQL["p6_found"] = _packed_sql()
