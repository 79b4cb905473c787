"""Queries of the functions on text, times, units and pages over whole test tables, and the SQL that DuckDB can check them by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpot.functions import classify as C
from stockpot.functions import text as X
from stockpot.functions import words as W
from stockpot.operators import indexes as I
from stockpot.operators import ingredients as G
from stockpot.operators.edit import changed_fields, merge_ids, named_objects, repair
from stockpot.operators.replies import choice_content, parsed_reply
from stockpot.queries_catalog import _NAME, MANY_SQL, _uuid_sql, registry
from stockpot.session import table
from stockpot.sources import pages as P

QUERIES, SQL, query = registry()

_WS = r"[\s\x0B\x1C-\x1F\x85\p{{Z}}]+"
_CLEAN = r"trim(regexp_replace({0}, '" + _WS + r"', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10) || '•▢')"
_PLAIN = r"trim(regexp_replace({0}, '" + _WS + r"', ' ', 'g'))"


def _names(spark: SparkSession, sf_dir: str, column: str = "name") -> DataFrame:
    return table(spark, sf_dir, "ingredient_line").select(column).distinct()


def _each(spark: SparkSession, sf_dir: str, column: str, value: Column, name: str) -> DataFrame:
    return _names(spark, sf_dir, column).select(column, value.alias(name))


def _values(items: list[str] | tuple[str, ...]) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


@query("SELECT DISTINCT name, " + _CLEAN.format("name") + " AS cleaned FROM ingredient_line")
def clean_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    # entities are made of the characters, so that there are some to resolve
    typed = F.replace(F.replace(F.replace("name", F.lit("&"), F.lit("&amp;")), F.lit("é"), F.lit("&eacute;")), F.lit("1"), F.lit("&#49;"))
    return _each(spark, sf_dir, "name", X.clean_build(typed), "cleaned")


@query("SELECT doc_id, " + _PLAIN.format("text") + " AS cleaned, " + _PLAIN.format("CASE WHEN doc_id % 2 = 0 THEN ' ' || chr(9) ELSE text END") + " = '' AS blank FROM documents")
def clean_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_repair(F.col("text")).alias("cleaned"), X.is_blank(F.when(F.col("doc_id") % 2 == 0, " \t").otherwise(F.col("text"))).alias("blank"))


_SINGULAR = (
    "CASE " + " ".join(f"WHEN {{0}} = '{k}' THEN '{v}'" for k, v in W.IRREGULAR.items())
    + r" WHEN length({0}) <= 3 OR regexp_matches({0}, '(ss|us|is)$') THEN {0} WHEN length({0}) > 4 AND {0} LIKE '%ies' THEN left({0}, -3) || 'y' WHEN length({0}) > 4 AND regexp_matches({0}, '(oes|ses)$') THEN left({0}, -2) WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ds' THEN left({0}, -1) ELSE {0} END"
)


@query("SELECT DISTINCT w AS word, " + _SINGULAR.format("w") + " AS singular FROM (SELECT unnest(string_split(" + _NAME.format("name") + ", ' ')) AS w FROM ingredient_line)")
def singular_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _names(spark, sf_dir).select(F.explode(F.split(X.normalize_name(F.col("name")), " ")).alias("word")).distinct()
    return words.select("word", X.singularize(F.col("word")).alias("singular"))


def _core_sql(text: str) -> str:
    t = f"regexp_replace({_NAME.format(text)}, '^(?:a )?can of ', 'canned ')"
    t = f"regexp_replace({t}, '^(?:{'|'.join(W.AMOUNT_PHRASES)})', '')"
    for tail in (r"\bfor boiling\b.*$", r"\bto taste\b.*$"):
        t = f"trim(regexp_replace({t}, '{tail}', ''))"
    t = f"regexp_replace({t}, '^(?:(?:{'|'.join(W.LEADING_WORDS)})(?:\\s+|$))+', '')"
    t = f"trim(regexp_replace({t}, '(?i)\\s+(?:{'|'.join(W.TAIL_VERBS)})\\b.*$', ''))"
    t = f"array_to_string(list_filter(string_split_regex({t}, '\\s+'), lambda w: w <> '' AND w NOT IN ({_values(W.DROPPED_WORDS)})), ' ')"
    return f"trim(trim(regexp_replace({t}, '\\bof$', '')), ' -/')"


_LAST = "regexp_extract({0}, '([^ ]*)$', 1)"


@query("SELECT name, left(c, length(c) - length(" + _LAST.format("c") + ")) || " + _SINGULAR.format(_LAST.format("c")) + " AS core FROM (SELECT name, " + _core_sql("name") + " AS c FROM (SELECT DISTINCT name FROM ingredient_line))")
def core_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _each(spark, sf_dir, "name", X.core_name(F.col("name")), "core")


@query("SELECT DISTINCT preparation, nullif(trim(regexp_replace(trim(regexp_replace(" + _NAME.format("preparation") + r", '\boptional\b', '', 'g')), '\s+', ' ', 'g'), ' -/'), '') AS cleaned FROM ingredient_line WHERE preparation IS NOT NULL UNION ALL SELECT NULL, NULL")
def preparation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _each(spark, sf_dir, "preparation", X.preparation_text(F.col("preparation")), "cleaned")


def _bracketed(text: str) -> str:
    return f"""
WITH RECURSIVE t AS (SELECT DISTINCT coalesce(preparation, '') || ' ' || name AS text FROM ingredient_line),
r AS (
  SELECT text, {_CLEAN.format('text')} AS base, CAST([] AS VARCHAR[]) AS parts, 0 AS turn FROM t
  UNION ALL
  SELECT text, {_CLEAN.format("regexp_replace(base, '[(][^()]*[)]', ' ', 'g')")}, parts || list_filter(list_transform(regexp_extract_all(base, '[(]([^()]*)[)]', 1), lambda p: {_CLEAN.format('p')}), lambda p: p <> ''), turn + 1 FROM r WHERE regexp_matches(base, '[(][^()]*[)]')),
last AS (SELECT text, arg_max(base, turn) AS base, arg_max(parts, turn) AS parts FROM r GROUP BY text)
{text}"""


_KIND = (
    "CASE WHEN n = '' THEN 'ignore' WHEN regexp_matches(n, '^optional( |$)') THEN 'optional' WHEN regexp_matches(n, '\\b(or|and/or)\\b') THEN 'ambiguous' "
    f"WHEN list_has_any(string_split_regex(n, '\\s+'), [{_values(W.BUILD_PREPARATIONS)}]) THEN 'preparation' ELSE 'alias' END"
)


@query(_bracketed(f"SELECT text, base, i AS place, part, {_KIND.replace('(n,', '(n,')} AS kind FROM (SELECT text, base, i, part, {_NAME.format('part')} AS n FROM (SELECT text, base, generate_subscripts(parts, 1) AS i, unnest(parts) AS part FROM last)) UNION ALL SELECT text, base, NULL, NULL, NULL FROM last WHERE len(parts) = 0"))
def bracket_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "ingredient_line").select(F.concat(F.coalesce("preparation", F.lit("")), F.lit(" "), "name").alias("text")).distinct()
    parted = texts.withColumn("_p", G.bracket_parts(F.col("text"))).select("text", "_p.base", F.posexplode_outer("_p.parts").alias("place", "part"))
    return parted.select("text", "base", (F.col("place") + 1).cast("long").alias("place"), "part", F.when(F.col("part").isNotNull(), G.bracket_kind(F.col("part"))).alias("kind"))


@query(r"SELECT t AS text, t LIKE '>>%' AND ltrim(t, '>') LIKE '%:' AS heading, t = '' OR regexp_matches(lower(t), '" + "|".join(W.EXCLUDED) + "') AS excluded FROM (SELECT DISTINCT " + _CLEAN.format("CASE line_id % 3 WHEN 0 THEN '>> ' || name || ':' WHEN 1 THEN 'Water for boiling ' || name ELSE name END") + " AS t FROM ingredient_line)")
def line_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("line_id") % 3
    text = X.clean_page(F.when(kind == 0, F.concat(F.lit(">> "), "name", F.lit(":"))).when(kind == 1, F.concat(F.lit("Water for boiling "), "name")).otherwise(F.col("name")))
    return table(spark, sf_dir, "ingredient_line").select(text.alias("text")).distinct().select("text", G.is_heading(F.col("text")).alias("heading"), G.is_excluded(F.col("text")).alias("excluded"))


_UNIT = "lower(unit)"


@query(f"""SELECT DISTINCT unit, CASE WHEN {_UNIT} LIKE '%ves' THEN left({_UNIT}, -3) || 'f' WHEN {_UNIT} LIKE '%ies' THEN left({_UNIT}, -3) || 'y' WHEN {_UNIT} LIKE '%s' AND {_UNIT} NOT LIKE '%ss' THEN left({_UNIT}, -1) ELSE {_UNIT} END AS one,
  CASE WHEN {_UNIT} LIKE '%f' THEN left({_UNIT}, -1) || 'ves' WHEN regexp_matches({_UNIT}, '[^aeiou]y$') THEN left({_UNIT}, -1) || 'ies' WHEN {_UNIT} LIKE '%s' THEN {_UNIT} ELSE {_UNIT} || 's' END AS many FROM ingredient_line""")
def unit_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir, "unit").select("unit", X.singular_unit(F.col("unit")).alias("one"), X.plural_unit(F.col("unit")).alias("many"))


@query(r"""SELECT slug, string_agg(upper(p[1]) || substr(p, 2), '' ORDER BY i) AS title, upper(slug[1]) || substr(slug, 2) AS capital FROM
  (SELECT slug, unnest(regexp_extract_all(lower(replace(slug, '-', ' ')), '[a-z]+|[^a-z]+')) AS p, generate_subscripts(regexp_extract_all(lower(replace(slug, '-', ' ')), '[a-z]+|[^a-z]+'), 1) AS i FROM (SELECT DISTINCT slug FROM recipe_summary)) GROUP BY slug""")
def slug_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_summary").select("slug").distinct().select("slug", X.title_of_slug(F.col("slug")).alias("title"), X.capitalize_first(F.col("slug")).alias("capital"))


_MINUTES = ("preparation_time_minutes", "cooking_time_minutes", "rest_time_minutes")


@query("SELECT rec_no, CASE WHEN cooking_time_minutes IS NOT NULL THEN cooking_time_minutes + CASE WHEN rec_no % 2 = 1 THEN 1 ELSE 0 END END AS minutes, preparation_time_minutes AS preparation, CASE WHEN cooking_time_minutes >= 60 THEN cooking_time_minutes // 60 * 60 ELSE cooking_time_minutes END AS cooking, rest_time_minutes AS rest, servings, coalesce(cooking_time_minutes, preparation_time_minutes, 0) AS shown FROM recipe_doc")
def page_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations and labels made of the minutes, and read again."""
    prep, cook, rest = map(F.col, _MINUTES)
    iso = F.concat(F.lit("P1DT"), F.floor(cook / 60), F.lit("H"), cook % 60, F.lit("M"), (F.col("rec_no") % 2), F.lit("S"))
    hours = F.when(cook >= 60, F.concat(F.floor(cook / 60).cast("string"), F.lit(" hours"))).otherwise(F.concat(cook.cast("string"), F.lit(" minutes")))
    block = F.concat_ws(" ", F.concat(F.lit("Prep Time: "), prep.cast("string"), F.lit(" mins")), F.concat(F.lit("COOK time "), hours), F.concat(F.lit("Marinating: "), rest.cast("string"), F.lit(" minutes")), F.lit("Total time 9 hours"))
    found = C.labelled_minutes(block)
    text = F.concat(F.lit("Serves "), F.col("servings").cast("string"), F.lit(" to 99"))
    rows = table(spark, sf_dir, "recipe_doc").select("rec_no", "servings", *_MINUTES)
    return rows.select("rec_no", C.iso_duration_minutes(iso).alias("minutes"), found["preparation"].alias("preparation"), found["cooking"].alias("cooking"), found["rest"].alias("rest"), C.servings(text).alias("servings"), C.shown_minutes(F.lit(None).cast("int"), cook, prep).alias("shown"))


def _lookup_sql(pairs: dict[str, str], value: str) -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


_SLUG = r"trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"
_TYPES = "CASE " + " ".join(f"WHEN regexp_matches(s, '{'|'.join(w)}') THEN '{t}'" for t, w in W.TYPE_WORDS) + f" WHEN list_has_any(string_split(s, ' '), [{_values(W.MAIN_SLUGS)}]) THEN 'main' END"


@query("SELECT rec_no, coalesce(" + _lookup_sql(W.REPAIR_DIFFICULTY, "lower(trim(difficulty))") + ", difficulty) AS difficulty, " + _lookup_sql(W.RECIPE_TYPES, _SLUG.format("recipe_type")) + f""" AS recipe_type, {_TYPES} AS inferred FROM (
  SELECT *, array_to_string(list_filter(list_transform([name, coalesce(brief_description, '')] || [x.name FOR x IN coalesce(categories, []) IF x IS NOT NULL] || [x.name FOR x IN coalesce(tags, []) IF x IS NOT NULL], lambda v: {_SLUG.format('v')}), lambda v: v <> ''), ' ') AS s FROM recipe_doc)""")
def document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = lambda c: F.transform(F.filter(F.coalesce(c, F.array()), lambda x: x.isNotNull()), lambda x: x["name"])
    values = F.concat(F.array("name", F.coalesce("brief_description", F.lit(""))), names("categories"), names("tags"))
    return table(spark, sf_dir, "recipe_doc").select("rec_no", C.repaired_difficulty(F.col("difficulty")).alias("difficulty"), C.recipe_type(F.col("recipe_type")).alias("recipe_type"), C.infer_recipe_type(values).alias("inferred"))


@query("SELECT rec_no, CASE WHEN rec_no % 3 = 0 THEN " + _lookup_sql(W.IMAGE_TYPES, "CASE rec_no % 2 WHEN 0 THEN 'image/png' ELSE 'image/webp' END") + r" ELSE coalesce(nullif(lower(regexp_extract(image_url, '[^/.]([.][^./]+)$', 1)), ''), '.png') END AS extension FROM recipe_doc")
def image_endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("rec_no") % 3 == 0, F.regexp_replace("image_url", r"\.[a-zA-Z]+$", "?size=1.jpg")).otherwise(F.concat("image_url", F.lit("?v=2")))
    kind = F.when(F.col("rec_no") % 3 != 0, "image/png").when(F.col("rec_no") % 2 == 0, "image/png; charset=x").otherwise("image/webp")
    return table(spark, sf_dir, "recipe_doc").select("rec_no", C.image_extension(url, kind).alias("extension"))


_WHERE = "lower(concat_ws(' ', nullif(" + _PLAIN.format("normalized_name") + ", ''), nullif(" + _PLAIN.format("name") + ", '')))"
_HINT = "CASE " + " ".join(f"WHEN contains({_WHERE}, '{n}') THEN '{h}'" for n, h in W.UNIT_HINTS) + " ELSE 'piece' END"
def _units_sql(rows: str) -> str:
    """The columns of some rows and the unit that their quantity and name tell."""
    return f"""SELECT * EXCLUDE (q, hint), CASE WHEN q <> '' THEN CASE WHEN NOT {MANY_SQL} THEN hint WHEN regexp_matches(hint, 'f$') THEN left(hint, -1) || 'ves' ELSE hint || 's' END END AS told FROM (
  SELECT *, lower({_PLAIN.format("coalesce(quantity, '')")}) AS q, {_HINT} AS hint FROM ({rows}))"""


@query(f"SELECT line_id, told AS unit FROM ({_units_sql('SELECT DISTINCT line_id, quantity, normalized_name, name FROM ingredient_line')})")
def inferred_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ingredient_line").select("line_id", "quantity", "normalized_name", "name").distinct()
    return rows.select("line_id", C.inferred_unit(F.col("quantity"), F.col("normalized_name"), F.col("name")).alias("unit"))


_TELLS = "regexp_matches(lower({0}), '(?:^|[^a-z])(?:" + "|".join(W.PREPARATIONS) + ")(?:[^a-z]|$)')"
_SEP = "CASE WHEN contains(b, ',') THEN ',' WHEN contains(b, ' - ') THEN ' - ' WHEN contains(b, ' – ') THEN ' – ' END"



def _preparations_sql(rows: str) -> str:
    """name and preparation, what the names of some rows tell of one."""
    low = lambda x: f"lower({_PLAIN.format(x)})"
    return f"""SELECT name, nullif(array_to_string(list_filter(list_transform(parts, lambda p, i: CASE WHEN list_position(list_transform(parts, lambda y: {low('y')}), {low('p')}) = i THEN {low('p')} END), lambda p: p IS NOT NULL), ', '), '') AS preparation FROM (
  SELECT name, list_filter(list_filter(regexp_extract_all(t, '[(]([^()]*)[)]', 1), lambda p: {_TELLS.format('p')}) || [CASE WHEN {_TELLS.format('rest')} THEN rest END, nullif(regexp_extract(b, '(?i)(\\b(?:{'|'.join(W.REPAIR_TAIL_VERBS)})\\b.*)$', 1), '')], lambda p: p IS NOT NULL) AS parts FROM (
    SELECT *, CASE WHEN {_SEP} IS NOT NULL THEN substr(b, instr(b, {_SEP}) + length({_SEP})) END AS rest FROM (
      SELECT name, t, regexp_replace(t, '[(][^()]*[)]', '', 'g') AS b FROM (SELECT name, {_PLAIN.format('name')} AS t FROM ({rows})))))"""


@query(_preparations_sql("SELECT DISTINCT concat_ws(', ', name, preparation) AS name FROM ingredient_line"))
def inferred_preparations(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "ingredient_line").select(F.concat_ws(", ", "name", "preparation").alias("name")).distinct()
    return typed.select("name", C.inferred_preparation(F.col("name")).alias("preparation"))


@query("SELECT preparation, generate_subscripts(v, 1) AS place, unnest(v) AS value FROM (SELECT preparation, list_filter(list_transform(string_split_regex(preparation, '[,|]'), lambda p: " + _CLEAN.format("p") + "), lambda p: p <> '') AS v FROM (SELECT DISTINCT preparation FROM ingredient_line WHERE preparation IS NOT NULL))")
def listed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _names(spark, sf_dir, "preparation").select("preparation", F.posexplode(X.split_values(F.col("preparation"))).alias("p", "value"))
    return rows.select("preparation", (F.col("p") + 1).cast("long").alias("place"), "value")


@query(r"SELECT rec_no, CASE rec_no % 4 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE rec_no END AS page, rec_no % 5 < 3 AS own, CASE rec_no % 4 WHEN 2 THEN 'https://x.com/recipes/page/' || rec_no || '/' END AS url, rec_no % 3 = 0 AS recipe FROM recipe_doc")
def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which URLs, made of the numbers of documents, are pages of an index or of the site, and which classes tell a recipe."""
    n = F.col("rec_no")
    path = F.when(n % 4 == 0, F.concat(F.lit("/recipe/page/"), n)).when(n % 4 == 1, "/recipes/").otherwise(F.concat(F.lit("/recipes/page/"), n))
    host = F.when(n % 5 == 0, "x.com").when(n % 5 == 1, "WWW.x.com:80").when(n % 5 == 2, "a.b.x.com").when(n % 5 == 3, "yx.com").otherwise("x.com.org")
    url = F.concat(F.lit("https://"), host, path)
    classes = F.array(F.lit("post"), F.when(n % 3 == 0, F.when(n % 2 == 0, "category-recipes").otherwise("category-beef-recipes")).otherwise("category-news"))
    number = P.index_page_number(url).cast("long")
    return table(spark, sf_dir, "recipe_doc").select("rec_no", number.alias("page"), P.on_site(url, "x.com").alias("own"), F.when(n % 4 == 2, P.index_page_url("https://x.com/recipes/", number)).alias("url"), P.looks_like_recipe(classes).alias("recipe"))


@query("SELECT rec_no, CASE WHEN rec_no % 5 = 0 THEN NULL ELSE updated_at - CASE rec_no % 5 WHEN 1 THEN updated_at % 86400 WHEN 2 THEN updated_at % 60 WHEN 3 THEN 19800 ELSE 0 END END AS seconds FROM recipe_doc")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written in several ways and read again; a year alone is no date."""
    n, at = F.col("rec_no") % 5, F.timestamp_seconds("updated_at")
    text = F.when(n == 0, F.date_format(at, "yyyy")).when(n == 1, F.date_format(at, "yyyyMMdd")).when(n == 2, F.date_format(at, "yyyy-MM-dd HH:mm")).when(n == 3, F.concat(F.date_format(at, "yyyy-MM-dd'T'HHmmss"), F.lit("+0530"))).otherwise(C.utc_text(F.col("updated_at")))
    return table(spark, sf_dir, "recipe_doc").select("rec_no", C.iso_to_seconds(text).alias("seconds"))


@query("SELECT rec_no, p.i AS place, p.x.text AS text, p.x.pos AS pos FROM (SELECT rec_no, unnest(list_transform(list_sort(list_transform(instructions, lambda x, i: {'at': coalesce(x.pos, 2147483647), 'i': i, 'x': x})), lambda y, i: {'i': i, 'x': y.x})) AS p FROM recipe_doc)")
def ordered_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "recipe_doc").select("rec_no", F.posexplode(I.by_position("instructions", "pos")).alias("p", "x"))
    return rows.select("rec_no", (F.col("p") + 1).cast("long").alias("place"), "x.text", "x.pos")


@query("SELECT rec_no, i AS place, x.name AS name FROM (SELECT rec_no, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM (SELECT rec_no, [x FOR x IN ingredients IF x IS NOT NULL] AS l FROM recipe_doc))")
def renumbered_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "recipe_doc").select("rec_no", F.explode(I.renumbered(F.col("ingredients"), "pos")).alias("x"))
    return rows.select("rec_no", F.col("x.pos").cast("long").alias("place"), "x.name")


def _page_texts(array: str, field: str) -> str:
    return f"list_filter(list_transform(list_filter({array}, lambda x: x IS NOT NULL), lambda x: {_CLEAN.format('x.' + field)}), lambda x: x <> '')"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages that state the documents: most as JSON-LD, every third by headings and lists."""
    docs = table(spark, sf_dir, "recipe_doc")
    texts = lambda c, f: F.transform(F.filter(F.coalesce(c, F.array()), lambda x: x.isNotNull()), lambda x: F.coalesce(x[f], F.lit("")))
    ld = F.to_json(F.struct(
        F.lit("Recipe").alias("@type"), F.col("name"), F.col("brief_description").alias("description"), texts("ingredients", "name").alias("recipeIngredient"), F.transform(texts("instructions", "text"), lambda t: F.struct(t.alias("text"))).alias("recipeInstructions"),
        F.concat(F.lit("PT"), F.col("preparation_time_minutes").cast("string"), F.lit("M")).alias("prepTime"), F.concat(F.col("servings").cast("string"), F.lit(" servings")).alias("recipeYield"), F.transform(F.filter(F.coalesce("categories", F.array()), lambda x: x.isNotNull()), lambda x: x["name"]).alias("recipeCategory"), F.col("cuisine").alias("recipeCuisine"), C.utc_text(F.col("updated_at")).alias("dateModified"),
    ))
    safe = lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    items = lambda c, f: F.concat(F.lit("<ul>"), F.array_join(F.transform(texts(c, f), lambda t: F.concat(F.lit("<li>"), safe(t), F.lit("</li>"))), ""), F.lit("</ul>"))
    listed = F.concat(F.lit("<html><meta property='og:title' content=\""), F.replace(safe(F.col("name")), F.lit('"'), F.lit("&quot;")), F.lit("\"><div id='wprm-recipe-container-1'><h3>Ingredients</h3>"), items("ingredients", "name"), F.lit("<h3>Instructions</h3>"), items("instructions", "text"), F.lit("</div></html>"))
    page = F.when(F.col("rec_no") % 3 == 0, listed).otherwise(F.concat(F.lit("<html><script type='application/ld+json'>"), F.replace(ld, F.lit("</"), F.lit("<\\/")), F.lit("</script></html>")))
    return docs.select(F.concat(F.lit("https://x.com/Recipe%20"), "rec_no", F.lit("/")).alias("url"), page.alias("html"))


@query(f"""WITH t AS (SELECT rec_no, {_CLEAN.format('name')} AS name, CASE WHEN rec_no % 3 > 0 THEN nullif({_CLEAN.format("coalesce(brief_description, '')")}, '') END AS brief_description, CASE WHEN rec_no % 3 > 0 THEN servings END AS servings, CASE WHEN rec_no % 3 > 0 THEN preparation_time_minutes END AS preparation, CASE WHEN rec_no % 3 > 0 THEN updated_at ELSE 7 END AS updated_at,
  {_page_texts('ingredients', 'name')} AS i, {_page_texts('instructions', 'text')} AS s FROM recipe_doc)
SELECT 'recipe-' || rec_no AS slug, {_uuid_sql('recipe', "'recipe-' || rec_no")} AS id, name, brief_description, servings, preparation, updated_at, CASE WHEN rec_no % 3 = 0 THEN len(list_distinct(i)) ELSE len(i) END AS ingredients, CASE WHEN rec_no % 3 = 0 THEN len(list_distinct(s)) ELSE len(s) END AS instructions FROM t WHERE len(i) > 0 AND len(s) > 0""")
def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = P.parse_pages(_pages(spark, sf_dir), "site", F.lit(7).cast("long"))
    return docs.select("slug", "id", "name", "brief_description", "servings", F.col("preparation_time_minutes").alias("preparation"), "updated_at", F.size("ingredient_texts").cast("long").alias("ingredients"), F.size("instructions").cast("long").alias("instructions"))


@query(f"SELECT count(*) FILTER (good) AS ok, count(*) FILTER (NOT good) AS failed FROM (SELECT len({_page_texts('coalesce(ingredients, [])', 'name')}) > 0 AND len({_page_texts('coalesce(instructions, [])', 'text')}) > 0 AS good FROM recipe_doc)")
def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.run_totals(*P.parse_pages(_pages(spark, sf_dir), "site", F.lit(7).cast("long")))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 4 THEN '' WHEN 0 THEN chr(10) || text || ' ' WHEN 3 THEN chr(10) || text || ' ' ELSE regexp_replace(text, '^" + _WS.format() + "|" + _WS.format() + "$', '', 'g') END AS content FROM documents")
def reply_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices of a text model made of the texts in several shapes, and their content read again."""
    n, text = F.col("doc_id") % 5, F.concat(F.lit("\n"), "text", F.lit(" "))
    choice = F.when(n == 0, F.to_json(F.struct(F.struct(text.alias("content")).alias("message")))).when(n == 1, F.to_json(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("content")).alias("message"))))
    choice = choice.when(n == 2, F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(text.alias("value")).alias("text"))).alias("content")).alias("message")))).when(n == 3, F.to_json(F.struct(text.alias("text")))).otherwise('{"message": {"content": " "}}')
    return table(spark, sf_dir, "documents").select("doc_id", choice_content(choice).alias("content"))


@query("SELECT rec_no, CASE WHEN rec_no % 5 = 3 THEN NULL ELSE slug END AS slug, CASE rec_no % 5 WHEN 3 THEN 'model output must include a \"recipe\" object' WHEN 4 THEN 'model output \"summary\" must be a string if present' END AS error FROM recipe_doc")
def parsed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("rec_no") % 5
    body = F.to_json(F.struct(F.struct("slug", "name").alias("recipe"), F.lit("done").alias("summary")))
    reply = F.when(n == 0, body).when(n == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(n == 2, F.concat(F.lit("\n ```\n"), body, F.lit("\n```\n"))).when(n == 3, '{"recipe": 3}').otherwise(F.replace(body, F.lit('"done"'), F.lit("7")))
    got = parsed_reply(reply)
    return table(spark, sf_dir, "recipe_doc").select("rec_no", F.get_json_object(got["recipe"], "$.slug").alias("slug"), got["error"].alias("error"))


@query("""WITH s AS (SELECT id, normalized_name FROM ingredient_index WHERE name IN ('salt', 'water')), first AS (SELECT min(id) AS id, arg_min(normalized_name, id) AS name FROM s),
e AS (SELECT rec_no, generate_subscripts(ingredients, 1) AS place, unnest(ingredients) AS x FROM recipe_doc),
h AS (SELECT e.rec_no, place, x, s.id IS NOT NULL AS hit FROM e LEFT JOIN s ON s.id = x.ingredient_id)
SELECT rec_no, place, CASE WHEN hit THEN first.name ELSE x.name END AS name, CASE WHEN hit THEN first.id ELSE x.ingredient_id END AS ingredient_id FROM h, first WHERE rec_no IN (SELECT rec_no FROM h WHERE hit)""")
def merged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "ingredient_index")
    ids = sorted(r.id for r in index.where("name in ('salt', 'water')").collect())
    changed = merge_ids(table(spark, sf_dir, "recipe_doc"), index, ids).select("rec_no", F.posexplode("ingredients").alias("p", "x"))
    return changed.select("rec_no", (F.col("p") + 1).cast("long").alias("place"), "x.name", "x.ingredient_id")


_GOOD_TAGS = "(tags IS NOT NULL AND coalesce(len([x FOR x IN tags IF x IS NULL OR coalesce(x.id, '') = '' OR coalesce(x.slug, '') = '' OR coalesce(x.name, '') = '']), 0) = 0)"


@query(f"""SELECT rec_no, id, slug, revision, CASE WHEN rec_no % 3 = 0 OR NOT {_GOOD_TAGS} THEN 'old' ELSE 'new' END AS tags_of,
  (CASE WHEN id <> 'x' THEN 1 ELSE 0 END) + 1 + CASE WHEN NOT {_GOOD_TAGS} OR rec_no % 3 = 0 THEN 1 ELSE 0 END AS restored FROM recipe_doc""")
def restored_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates whose id and revision are changed in all, and whose tags are broken in every third, repaired against the documents."""
    docs = table(spark, sf_dir, "recipe_doc").select("rec_no", "id", "slug", "schema_version", "updated_at", "revision", "difficulty", F.array().cast("array<struct<id:string,slug:string,name:string>>").alias("categories"), "tags", F.expr("slice(filter(ingredients, x -> false), 1, 1)").alias("ingredients"))
    mark = F.array(F.struct(F.lit("m").alias("id"), F.lit("m").alias("slug"), F.lit("m").alias("name"), F.lit(None).cast("string").alias("color")))
    old = docs.withColumn("tags", F.array(F.struct(F.lit("o").alias("id"), F.lit("old").alias("slug"), F.lit("o").alias("name"), F.lit(None).cast("string").alias("color"))))
    broken = F.when(F.col("rec_no") % 3 == 0, F.transform(mark, lambda x: x.withField("slug", F.lit(None).cast("string")))).when(named_objects("tags"), mark).otherwise(F.col("tags"))
    candidate = docs.withColumns({"id": F.lit("x"), "revision": F.col("revision") + 1, "tags": broken})
    done = repair(old, candidate)
    return done.select("rec_no", "id", "slug", "revision", F.when(F.get("tags", F.lit(0))["slug"] == "old", "old").otherwise("new").alias("tags_of"), F.size(F.filter("repairs", lambda r: r.startswith("restored"))).alias("restored"))


@query("SELECT rec_no, CASE WHEN rec_no % 4 = 0 THEN 'no visible changes' WHEN rec_no % 4 = 1 THEN 'name' WHEN rec_no % 4 = 2 THEN 'cuisine, name' ELSE 'servings' END AS changed FROM recipe_doc")
def document_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "recipe_doc").select("rec_no", "id", "name", "cuisine", "servings", "revision")
    n = F.col("rec_no") % 4
    after = docs.select("rec_no", "id", F.when((n == 1) | (n == 2), F.concat("name", F.lit("!"))).otherwise(F.col("name")).alias("name"), F.when(n == 2, F.concat(F.coalesce("cuisine", F.lit("")), F.lit("!"))).otherwise(F.col("cuisine")).alias("cuisine"), F.when(n == 3, F.coalesce("servings", F.lit(0)) + 1).otherwise(F.col("servings")).alias("servings"), (F.col("revision") + 1).alias("revision"))
    return changed_fields(docs, after, "rec_no")


def _repairs_sql() -> str:
    """The log of repairs of documents against themselves: misshapen lists, names of difficulties, units and preparations that names tell."""
    good = lambda a: f"({a} IS NOT NULL AND coalesce(len([x FOR x IN {a} IF x IS NULL OR coalesce(x.id, '') = '' OR coalesce(x.slug, '') = '' OR coalesce(x.name, '') = '']), 0) = 0)"
    blank = lambda x: f"coalesce({_PLAIN.format(x)}, '') = ''"
    quoted = lambda x: f"chr(39) || {x} || chr(39)"
    known = f"coalesce({_lookup_sql(W.REPAIR_DIFFICULTY, 'lower(trim(difficulty))')}, difficulty)"
    lines = "SELECT rec_no, nth, x.name AS name, x.normalized_name AS normalized_name, x.quantity AS quantity, x.unit AS unit, x.preparation AS stated FROM (SELECT rec_no, generate_subscripts(ingredients, 1) AS nth, unnest(ingredients) AS x FROM recipe_doc) WHERE x IS NOT NULL"
    return f"""WITH u AS ({_units_sql(lines)}), p AS ({_preparations_sql('SELECT DISTINCT name FROM u')}),
e AS (
  SELECT rec_no, 0 AS nth, 0 AS k, 'restored categories because model returned an invalid shape' AS said FROM recipe_doc WHERE NOT {good('categories')}
  UNION ALL SELECT rec_no, 0, 1, 'restored tags because model returned an invalid shape' FROM recipe_doc WHERE NOT {good('tags')}
  UNION ALL SELECT rec_no, 0, 2, 'normalized difficulty from ' || {quoted('difficulty')} || ' to ' || {quoted(known)} FROM recipe_doc WHERE difficulty <> {known}
  UNION ALL SELECT rec_no, nth, 3, 'filled unit for ingredient ' || {quoted('name')} FROM u WHERE {blank('unit')} AND told IS NOT NULL
  UNION ALL SELECT rec_no, nth, 4, 'filled preparation for ingredient ' || {quoted('name')} FROM u JOIN p USING (name) WHERE {blank('stated')} AND preparation IS NOT NULL)
SELECT rec_no, count(said) AS n_repairs, coalesce(string_agg(said, '; ' ORDER BY nth, k), '') AS repairs FROM recipe_doc LEFT JOIN e USING (rec_no) GROUP BY rec_no"""


@query(_repairs_sql())
def repaired_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repaired against themselves: what is filled is what their own names tell."""
    docs = table(spark, sf_dir, "recipe_doc").select("rec_no", "id", "slug", "schema_version", "updated_at", "revision", "difficulty", "categories", "tags", F.expr("filter(ingredients, x -> x is not null)").alias("ingredients"))
    return repair(docs, docs).select("rec_no", F.size("repairs").alias("n_repairs"), F.array_join("repairs", "; ").alias("repairs"))
