"""Queries of the catalog operators over the test tables, and the SQL that DuckDB can check them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpot.functions import classify as C
from stockpot.functions import text as X
from stockpot.functions.ids import content_hash, entity_id
from stockpot.operators import indexes as I
from stockpot.operators import search as S
from stockpot.operators.edit import edit_stats, merge_ids, named_objects
from stockpot.operators.ingredients import FIELDS
from stockpot.operators.validate import violations
from stockpot.plans.catalog import build_catalog, manifest
from stockpot.session import new_folder, table
from stockpot.sources.documents import documents_by_slug, read_documents, read_index, rewrite_changed, write_documents
from stockpot.sources.pages import canonical_url, slug_of_url

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """The queries and the SQL of a module, and the decorator that adds to them."""
    queries: dict[str, Query] = {}
    texts: dict[str, str] = {}

    def query(sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            queries[f.__name__] = f
            if sql:
                texts[f.__name__] = sql
            return f

        return add

    return queries, texts, query


QUERIES, SQL, query = registry()

_CURRENT = "cur AS (SELECT * FROM recipe_summary QUALIFY row_number() OVER (PARTITION BY recipe_no ORDER BY revision DESC) = 1)"


_SEARCHED = ("name", "slug", "brief_description", "ingredient_names", "category_slugs", "tag_slugs", "difficulty")


def _current(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """recipe_no and the named columns of the current rows; no other column is read."""
    rows = table(spark, sf_dir, "recipe_summary").groupBy("recipe_no").agg(F.max_by(F.struct(*columns), F.coalesce("revision", F.lit(-(2**31)))).alias("_r"))
    return rows.select("recipe_no", "_r.*")


def _uuid_sql(kind: str, key: str) -> str:
    from stockpot.functions.words import NAMESPACES

    h = f"sha1(unhex('{NAMESPACES[kind].replace('-', '')}') || encode({key}))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || translate(substr({h}, 17, 1), '0123456789abcdef', '{'89ab' * 4}') || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


_NAME = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace({0}, '[\s\x0B\x1C-\x1F\x85\p{{Z}}]+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10) || '•▢')), '\([^)]*\)', '', 'g'), '[^a-z0-9\s/-]', '', 'g'), '\s+', ' ', 'g'), ' -/')"""


@query("SELECT slug, " + _uuid_sql("recipe", "slug") + " AS id FROM (SELECT DISTINCT slug FROM recipe_summary)")
def stable_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_summary").select("slug").distinct().withColumn("id", entity_id("recipe", F.col("slug")))


@query(r"SELECT recipe_no, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM (SELECT DISTINCT recipe_no, name FROM recipe_summary)")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_summary").select("recipe_no", "name").distinct().select("recipe_no", X.slugify(F.col("name")).alias("slug"))


@query("SELECT DISTINCT name, " + _NAME.format("name") + " AS normalized FROM ingredient_line")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ingredient_line").select("name").distinct().select("name", X.normalize_name(F.col("name")).alias("normalized"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10) || '•▢') AS cleaned FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_page(F.col("text")).alias("cleaned"))


def _index_sql(array: str, key: str, attributes: str) -> str:
    return f"""
WITH x AS (SELECT rec_no, generate_subscripts({array}, 1) AS p, unnest({array}) AS x FROM recipe_doc),
c AS (SELECT x.{key} AS {key}, arg_max(x, (rec_no, p)) AS l, count(*) AS recipe_count FROM x WHERE x.{key} IS NOT NULL GROUP BY x.{key})
SELECT {key}, {", ".join(f"l.{a} AS {a}" for a in attributes.split())}, recipe_count FROM c"""


@query(_index_sql("categories", "slug", "name"))
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.category_index(table(spark, sf_dir, "recipe_doc"), "rec_no").drop("id")


@query(_index_sql("tags", "slug", "name color"))
def tag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.tag_index(table(spark, sf_dir, "recipe_doc"), "rec_no").drop("id")


@query(_index_sql("ingredients", "normalized_name", "name"))
def ingredient_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.ingredient_index(table(spark, sf_dir, "recipe_doc"), "rec_no").drop("id")


@query("SELECT slug, recipe_count FROM (" + _index_sql("tags", "slug", "name") + ") WHERE recipe_count > 1 ORDER BY recipe_count DESC, slug LIMIT 10")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.top(I.tag_index(table(spark, sf_dir, "recipe_doc"), "rec_no"), "slug").select("slug", "recipe_count")


@query(f"""
WITH {_CURRENT},
v AS (SELECT 'c' AS k, unnest(category_slugs) AS x FROM cur UNION ALL SELECT 't', unnest(tag_slugs) FROM cur UNION ALL SELECT 'i', unnest(ingredient_names) FROM cur),
n AS (SELECT count(DISTINCT x) FILTER (k = 'c') AS categories, count(DISTINCT x) FILTER (k = 't') AS tags, count(DISTINCT x) FILTER (k = 'i') AS ingredients FROM v)
SELECT (SELECT count(*) FROM cur) AS recipes, CAST((SELECT floor(sum(coalesce(total_time_minutes, 0)) / count(*) + 0.5) FROM cur) AS BIGINT) AS average_minutes, n.* FROM n""")
def catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.catalog_stats(_current(spark, sf_dir, "category_slugs", "tag_slugs", "ingredient_names", "total_time_minutes"))


@query("SELECT strftime(to_timestamp(max(updated_at)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS generated_at FROM recipe_doc")
def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.generated_at(table(spark, sf_dir, "recipe_doc"), "1970-01-01T00:00:00Z")


@query("SELECT rec_no, nullif(coalesce(preparation_time_minutes, 0) + coalesce(cooking_time_minutes, 0) + coalesce(rest_time_minutes, 0), 0) AS total_time_minutes FROM recipe_doc")
def total_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = C.total_minutes(*map(F.col, ("preparation_time_minutes", "cooking_time_minutes", "rest_time_minutes")))
    return table(spark, sf_dir, "recipe_doc").select("rec_no", minutes.alias("total_time_minutes"))


_SCALARS = ("name", "recipe_type", "brief_description", "cuisine", "image_url", "difficulty", "servings", "cooking_time_minutes", "preparation_time_minutes", "rest_time_minutes", "updated_at", "revision")
_TEXT_LISTS = ("dietary_labels", "allergens")
_PLUCKED = (("category_slugs", "categories", "slug"), ("tag_slugs", "tags", "slug"), ("ingredient_names", "ingredients", "name"))


@query("SELECT rec_no, slug, " + _uuid_sql("recipe", "slug") + " AS id, " + ", ".join(_SCALARS) + ", nullif(coalesce(preparation_time_minutes, 0) + coalesce(cooking_time_minutes, 0) + coalesce(rest_time_minutes, 0), 0) AS total_time_minutes, coalesce(len(instructions), 0) AS instruction_step_count, "
  + ", ".join(f"coalesce(array_to_string({c}, '|'), '') AS {c}" for c in _TEXT_LISTS) + ", " + ", ".join(f"coalesce(array_to_string([x.{f} FOR x IN {a} IF x IS NOT NULL], '|'), '') AS {n}" for n, a, f in _PLUCKED) + " FROM recipe_doc")
def nested_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # arrays are compared as texts; rec_no rides along beside the summary's own columns
    docs = table(spark, sf_dir, "recipe_doc").withColumn("recipe_path", F.col("rec_no").cast("string"))
    rows = I.recipe_summaries(docs)
    texts = {c: F.coalesce(F.array_join(c, "|"), F.lit("")) for c in (*_TEXT_LISTS, *(n for n, _, _ in _PLUCKED))}
    return rows.withColumns(texts).withColumn("instruction_step_count", F.col("instruction_step_count").cast("long")).select(F.col("recipe_path").cast("long").alias("rec_no"), *I.browse_rows(rows).columns)


_BLOB = "lower(concat_ws(' ', coalesce(name, ''), coalesce(slug, ''), coalesce(brief_description, ''), coalesce(array_to_string(ingredient_names, ' '), ''), coalesce(array_to_string(category_slugs, ', '), ''), coalesce(array_to_string(tag_slugs, ', '), ''), coalesce(difficulty, '')))"


@query(f"WITH {_CURRENT} SELECT recipe_no, {_BLOB} AS search_terms FROM cur")
def search_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_search_terms(_current(spark, sf_dir, *_SEARCHED)).select("recipe_no", "search_terms")


@query(f"WITH {_CURRENT} SELECT recipe_no, slug FROM cur WHERE contains({_BLOB}, 'smoked') AND list_contains(category_slugs, 'soup') AND list_contains(tag_slugs, 'easy-recipes') AND difficulty = 'medium'")
def facet_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_current(spark, sf_dir, *_SEARCHED), query=" Smoked ", category="soup", tag="easy-recipes", difficulty="medium").select("recipe_no", "slug")


@query(f"WITH {_CURRENT} SELECT count(*) FILTER (contains({_BLOB}, 'salt')) AS visible, count(*) AS total FROM cur")
def visible_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.visible(_current(spark, sf_dir, *_SEARCHED), query="salt")


@query(f"WITH {_CURRENT}, d AS (SELECT slug, arg_max(rec_no, rec_no) AS rec_no, arg_max(revision, rec_no) AS doc_revision FROM recipe_doc GROUP BY slug) SELECT recipe_no, slug, rec_no, doc_revision FROM cur JOIN d USING (slug)")
def slug_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.slug_join(_current(spark, sf_dir, "slug", "revision"), table(spark, sf_dir, "recipe_doc").select("slug", "rec_no", "revision"), "rec_no").select("recipe_no", "slug", "rec_no", "doc_revision")


@query("""
WITH e AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS related_id FROM lineitem),
r AS (SELECT id, related_id, row_number() OVER (PARTITION BY id ORDER BY lower(p_name), p_brand, related_id) AS place FROM e JOIN part ON CAST(p_partkey AS VARCHAR) = related_id)
SELECT * FROM r WHERE place <= 6""")
def related(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the parts of an order stand for related entries: no document of the test tables names any
    docs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(F.collect_set(F.col("l_partkey").cast("string")).alias("related_recipe_ids"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("slug"))
    return S.related(docs, parts).withColumn("place", F.col("place").cast("long"))


@query("""
WITH l AS (SELECT doc_id AS id, sha256(text) AS digest FROM documents WHERE doc_id % 7 <> 0),
r AS (SELECT doc_id AS id, CASE WHEN n_chars > 1500 THEN sha256(text || '!') ELSE sha256(text) END AS digest FROM documents WHERE lang IS NOT NULL)
SELECT coalesce(l.id, r.id) AS id, CASE WHEN r.id IS NULL THEN 'remove' ELSE 'fetch' END AS op FROM l FULL JOIN r ON l.id = r.id WHERE r.id IS NULL OR l.id IS NULL OR l.digest IS DISTINCT FROM r.digest""")
def sync_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # two states of one catalog made of the whole table: here lacks some, there lacks and changed others
    here = docs.where("doc_id % 7 <> 0").select(F.col("doc_id").alias("id"), content_hash(F.col("text")).alias("digest"))
    there = docs.where("lang is not null").select(F.col("doc_id").alias("id"), content_hash(F.when(F.col("n_chars") > 1500, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("digest"))
    return S.sync_diff(here, there)


@query("SELECT doc_id, source FROM documents WHERE lang IS NULL")
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    # documents with a language stand for those that a run has done before
    return S.not_done(docs, docs.where("lang is not null"), "doc_id").select("doc_id", "source")


@query("SELECT text, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.first_of(table(spark, sf_dir, "documents").select("text", "doc_id", "source"), ["text"], ["doc_id"])


_ACTIVE = "(coalesce(preparation_time_minutes, 0) + coalesce(cooking_time_minutes, 0))"
_EFFECTIVE = f"({_ACTIVE} + (coalesce(rest_time_minutes, 0) + 3) // 4)"
_STEPS = "coalesce(len(instructions), 0)"


@query(f"SELECT rec_no, CASE WHEN {_STEPS} >= 14 OR {_EFFECTIVE} >= 150 OR {_ACTIVE} >= 120 THEN 'expert' WHEN {_STEPS} >= 10 OR {_EFFECTIVE} >= 90 OR {_ACTIVE} >= 75 THEN 'hard' WHEN {_STEPS} >= 6 OR {_EFFECTIVE} >= 40 OR {_ACTIVE} >= 30 THEN 'medium' ELSE 'easy' END AS difficulty FROM recipe_doc")
def difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.size(F.coalesce("instructions", F.array().cast("array<struct<pos:int,text:string>>")))
    return table(spark, sf_dir, "recipe_doc").select("rec_no", C.infer_difficulty(steps, F.col("preparation_time_minutes"), F.col("cooking_time_minutes"), F.col("rest_time_minutes")).alias("difficulty"))


_SCHEMA = {
    "type": "object",
    "properties": {
        "recipe_no": {"type": "integer", "minimum": 1},
        "difficulty": {"type": ["string", "null"], "enum": ["easy", "medium", "hard", None]},
        "servings": {"type": ["integer", "null"], "minimum": 3},
        "recipe_type": {"type": "string"},
    },
    "required": ["recipe_no", "recipe_type"],
}


@query(f"""
WITH {_CURRENT}
SELECT recipe_no, array_to_string(list_sort(list_filter([
  CASE WHEN difficulty NOT IN ('easy', 'medium', 'hard') THEN 'difficulty: is not one of [''easy'', ''medium'', ''hard'', None]' END,
  CASE WHEN servings < 3 THEN 'servings: is less than the minimum of 3' END,
  CASE WHEN recipe_type IS NULL THEN 'recipe_type: is not of type string' END], lambda x: x IS NOT NULL)), '; ') AS errors FROM cur""")
def violation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _current(spark, sf_dir, "difficulty", "servings", "recipe_type")
    return rows.select("recipe_no", F.array_join(violations(rows, _SCHEMA), "; ").alias("errors"))


@query("""
WITH x AS (SELECT rec_no, unnest(ingredients) AS i FROM recipe_doc),
h AS (SELECT rec_no FROM x WHERE i.ingredient_id IN (SELECT id FROM ingredient_index WHERE name IN ('salt', 'water')))
SELECT count(DISTINCT rec_no) AS files_changed, count(*) AS rows_changed FROM h""")
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "ingredient_index")
    ids = sorted(r.id for r in index.where("name in ('salt', 'water')").collect())
    return edit_stats(merge_ids(table(spark, sf_dir, "recipe_doc"), index, ids))


@query(f"WITH {_CURRENT} SELECT id, slug, updated_at, revision, 4 AS from_sequence, 5 AS to_sequence, '0000000005.json' AS file_name FROM cur")
def manifest_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_current(spark, sf_dir, "id", "slug", "updated_at", "revision"), 5)


_URL = "regexp_extract(source.url, '^[a-z]+://([^/?#]*)', 1)", "regexp_extract(source.url, '^[a-z]+://[^/?#]*([^?#;]*)', 1)"


@query(f"SELECT rec_no, CASE WHEN rec_no % 3 = 2 THEN 'http' ELSE 'https' END || '://' || lower({_URL[0]}) || rtrim({_URL[1]}, '/') || '/' AS url FROM recipe_doc WHERE source.url IS NOT NULL")
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs of the documents, of which every third is typed without a scheme and every third with capitals, a query and a fragment."""
    rows = table(spark, sf_dir, "recipe_doc").where("source.url is not null").select("rec_no", F.regexp_replace("source.url", "^[a-z]+:", "").alias("url"))
    host = F.regexp_extract("url", "^(//[^/?#]*)", 1)
    loud = F.concat(F.lit("HTTP:"), F.upper(host), F.substr("url", F.length(host) + 1), F.lit("///?a=b#c"))
    typed = F.when(F.col("rec_no") % 3 == 0, F.concat(F.lit("https:"), "url")).when(F.col("rec_no") % 3 == 1, F.col("url")).otherwise(loud)
    return rows.select("rec_no", canonical_url(typed).alias("url"))


@query("SELECT rec_no, nullif(trim(regexp_replace(lower(url_decode(regexp_extract(rtrim(regexp_extract(source.url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '([^/]+)$', 1))), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug FROM recipe_doc WHERE source.url IS NOT NULL")
def url_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_doc").where("source.url is not null").select("rec_no", slug_of_url(F.col("source.url")).alias("slug"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "string").alias("k"))


@query(rf"""WITH {_CURRENT} SELECT recipe_no, CASE WHEN regexp_matches(s, 'salad') THEN 'salad' WHEN regexp_matches(s, 'appetizer|starter') THEN 'appetizer' WHEN regexp_matches(s, 'soup|broth|bisque') THEN 'soup'
  WHEN regexp_matches(s, 'dessert|cake|cookie|brownie|sweet') THEN 'dessert' WHEN contains(s, 'breakfast') THEN 'breakfast' WHEN contains(s, 'snack') THEN 'snack' WHEN regexp_matches(s, 'drink|beverage|juice|shake|smoothie') THEN 'drink'
  WHEN contains(s, 'side') THEN 'side' WHEN s IN ('main-course', 'dinner', 'lunch', 'entree') THEN 'main' END AS recipe_type
  FROM (SELECT recipe_no, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM cur)""")
def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(spark, sf_dir, "name").select("recipe_no", C.infer_recipe_type(F.array("name")).alias("recipe_type"))


@query(f"WITH {_CURRENT} SELECT recipe_no, row_number() OVER (ORDER BY lower(name), slug, recipe_no) AS place FROM cur")
def index_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every entry in index order."""
    return I.index_places(_current(spark, sf_dir, "name", "slug"), "recipe_no")


_QUANTITY = r"lower(trim(regexp_replace(coalesce(quantity, ''), '[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ', 'g')))"
#: Whether the quantity q is more than one, as SQL.
MANY_SQL = r"""coalesce(CASE WHEN q IN ('a', 'an', 'one') THEN false WHEN regexp_matches(q, '^(?:[0-9]+\s+)?[0-9]+/[0-9]+$')
  THEN coalesce(try_cast(nullif(regexp_extract(q, '^([0-9]+)\s', 1), '') AS DOUBLE), 0) + try_cast(regexp_extract(q, '([0-9]+)/', 1) AS DOUBLE) / nullif(try_cast(regexp_extract(q, '/([0-9]+)$', 1) AS DOUBLE), 0) > 1
  ELSE try_cast(nullif(regexp_extract(q, '([0-9]+(?:[.][0-9]+)?)', 1), '') AS DOUBLE) > 1 END, false)"""


@query(f"SELECT line_id, quantity, {MANY_SQL} AS plural FROM (SELECT DISTINCT line_id, quantity, {_QUANTITY} AS q FROM ingredient_line)")
def plural_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ingredient_line").select("line_id", "quantity").distinct()
    return rows.select("line_id", "quantity", C.is_plural(F.col("quantity")).alias("plural"))


@query(r"SELECT tag_slug, string_agg(upper(p[1]) || lower(substr(p, 2)), '' ORDER BY i) AS title FROM (SELECT slug AS tag_slug, unnest(regexp_extract_all(s, '[\s_-]+|[^\s_-]+')) AS p, generate_subscripts(regexp_extract_all(s, '[\s_-]+|[^\s_-]+'), 1) AS i FROM (SELECT slug, upper(slug) || '_' || name AS s FROM tag_index)) GROUP BY tag_slug")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tag_index").select(F.col("slug").alias("tag_slug"), X.title_case(F.concat(F.upper("slug"), F.lit("_"), "name")).alias("title"))


@query("SELECT rec_no, tags IS NOT NULL AND coalesce(len([x FOR x IN tags IF x IS NULL OR coalesce(x.id, '') = '' OR coalesce(x.slug, '') = '' OR coalesce(x.name, '') = '']), 0) = 0 AS named FROM recipe_doc")
def named_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_doc").select("rec_no", named_objects("tags").alias("named"))


@query("SELECT rec_no, CASE lower(trim(difficulty)) WHEN 'easy' THEN 'easy' WHEN 'medium' THEN 'medium' WHEN 'hard' THEN 'hard' WHEN 'expert' THEN 'expert' END AS difficulty FROM recipe_doc")
def page_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_doc").select("rec_no", C.page_difficulty(F.col("difficulty")).alias("difficulty"))


def _catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a catalog stores them: path, and places named position."""
    docs = table(spark, sf_dir, "recipe_doc").withColumn("path", F.lpad(F.col("rec_no").cast("string"), 12, "0"))
    placed = lambda c, *fields: F.transform(c, lambda x: F.when(x.isNotNull(), F.struct(*(x[f].alias(f) for f in fields), x["pos"].alias("position"))))
    return docs.withColumns({"ingredients": placed("ingredients", *FIELDS), "instructions": placed("instructions", "text")}).drop("rec_no")


_INDEXED = "SELECT '{kind}' AS kind, " + "{uuid} AS id, slug, name, recipe_count FROM ({index})"


@query(" UNION ALL ".join(_INDEXED.format(kind=k, uuid=_uuid_sql(k, "slug"), index=_index_sql(a, "slug", "name")) for k, a in (("category", "categories"), ("tag", "tags"))))
def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog is built, and two of the index files that its release names are read again."""
    folder = new_folder(spark, "catalog")
    release = build_catalog(_catalog_documents(spark, sf_dir), folder)
    rows = [read_index(spark, f"{folder}/{release['indexes'][n]['path']}", n).select(F.lit(kind).alias("kind"), "id", "slug", "name", "recipe_count") for kind, n in (("category", "categories"), ("tag", "tags"))]
    return rows[0].unionByName(rows[1])


@query("SELECT slug, max(rec_no) AS rec_no, arg_max(name, rec_no) AS name, arg_max(revision + CASE WHEN rec_no % 2 = 0 THEN 1 ELSE 0 END, rec_no) AS revision, arg_max([x.name FOR x IN ingredients IF x IS NOT NULL], rec_no)::VARCHAR AS ingredients FROM recipe_doc GROUP BY slug")
def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are written as files, every second is rewritten with a higher revision, and all are read again, one a slug."""
    folder = new_folder(spark, "files")
    docs = _catalog_documents(spark, sf_dir).withColumnRenamed("path", "_file")
    write_documents(docs.withColumn("_file", F.concat("_file", F.lit(".json"))), folder)
    number = F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long")
    stored = read_documents(spark, folder)
    rewrite_changed(stored.where(number % 2 == 0).withColumn("revision", F.col("revision") + 1))
    rows = documents_by_slug(read_documents(spark, folder))
    names = F.transform(F.filter("ingredients", lambda x: x.isNotNull()), lambda x: F.coalesce(x["name"], F.lit("NULL")))
    return rows.select("slug", number.alias("rec_no"), "name", "revision", F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")).alias("ingredients"))
