"""Queries that write to files and read them again, and of orders and links, with the SQL that DuckDB can check them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockpot.functions import classify as C
from stockpot.functions import text as X
from stockpot.functions.ids import content_hash, entity_id
from stockpot.operators import indexes as I
from stockpot.operators.edit import rename_id
from stockpot.operators.replies import improve
from stockpot.plans.catalog import review_order
from stockpot.queries_catalog import _uuid_sql, registry
from stockpot.session import new_folder, table
from stockpot.sources import documents as D
from stockpot.sources import pages as P

QUERIES, SQL, query = registry()


@query("""SELECT rec_no, sha256('{' || chr(10) || '  "slug": "' || slug || '",' || chr(10) || '  "revision": ' || revision || chr(10) || '}' || chr(10)) AS digest FROM recipe_doc""")
def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files, and the hashes of the files' bytes."""
    folder = new_folder(spark, "hashes")
    D.write_documents(table(spark, sf_dir, "recipe_doc").select(F.concat(F.col("rec_no").cast("string"), F.lit(".json")).alias("_file"), "slug", "revision"), folder)
    return D.read_hashes(spark, folder).select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long").alias("rec_no"), F.col("file_sha256").alias("digest"))


@query("SELECT DISTINCT split_part(source.url, '#', 1) AS url FROM recipe_doc WHERE source.url IS NOT NULL")
def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'urls')}/urls.txt"
    urls = table(spark, sf_dir, "recipe_doc").where("source.url is not null").select(F.concat("source.url", F.lit("#note")).alias("url")).distinct()
    D.write_url_list(urls, path)
    return D.read_url_list(spark, path)


@query("WITH s AS (SELECT CASE rec_no % 3 WHEN 0 THEN 'written' ELSE 'reviewed' END AS kind, id, min(rec_no) AS n FROM recipe_doc GROUP BY ALL) SELECT kind, id, row_number() OVER (PARTITION BY kind ORDER BY n) - 1 AS seq FROM s")
def state_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'state')}/state.json"
    state = table(spark, sf_dir, "recipe_doc").select(F.when(F.col("rec_no") % 3 == 0, "written").otherwise("reviewed").alias("kind"), "id", F.col("rec_no").alias("seq"))
    # ids that come twice count where they come first
    D.write_state(state.unionByName(state.withColumn("seq", F.col("seq") + 10**9)), path)
    return D.read_state(spark, path)


@query("SELECT id, name, normalized_name, recipe_count FROM ingredient_index")
def ingredient_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'index')}/ingredients.index.json"
    rows = table(spark, sf_dir, "ingredient_index").select("id", "name", "normalized_name", "recipe_count")
    old = rows.withColumn("name", F.lit("old"))
    D.dump_rows(path, {"schema_version": 1}, "ingredients", old.withColumn("_o", F.lit(0)).unionByName(rows.withColumn("_o", F.lit(1))).orderBy("_o").drop("_o"))
    return D.read_ingredient_index(spark, path)


@query("SELECT rec_no, 'manifests/' || lpad(rec_no::VARCHAR, 10, '0') || '.json' AS manifest, 'https://x/r/raw/main/' || slug AS address, strftime(make_timestamp(updated_at * 1000000), '%-m/%-d/%Y') AS shown FROM recipe_doc")
def file_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_doc").select("rec_no", X.manifest_path_of_sequence(F.col("rec_no")).alias("manifest"), X.asset_url("https://x/r", "main", F.concat(F.lit("/"), "slug")).alias("address"), C.display_date(F.col("updated_at")).alias("shown"))


@query("WITH h AS (SELECT id FROM ingredient_index WHERE name = 'salt') SELECT rec_no, place, CASE WHEN x.ingredient_id = h.id THEN 'a pinch of salt' ELSE x.name END AS name, CASE WHEN x.ingredient_id = h.id THEN " + _uuid_sql("ingredient", "'a pinch of salt'") + " ELSE x.ingredient_id END AS ingredient_id FROM (SELECT rec_no, ingredients, generate_subscripts(ingredients, 1) AS place, unnest(ingredients) AS x FROM recipe_doc), h WHERE len([1 FOR y IN ingredients IF y.ingredient_id = h.id]) > 0")
def renamed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "ingredient_index")
    changed = rename_id(table(spark, sf_dir, "recipe_doc"), index, index.where("name = 'salt'").first().id, "A Pinch (or two) of Salt!")
    return changed.select("rec_no", F.posexplode("ingredients").alias("p", "x")).select("rec_no", (F.col("p") + 1).cast("long").alias("place"), "x.name", "x.ingredient_id")


@query("WITH r AS (SELECT line_id, recipe_id AS recipe_slug, CASE WHEN pos % 5 <> 0 THEN pos END AS position, name AS original_text, unit AS resolution FROM ingredient_line QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY loaded_at DESC) = 1) SELECT line_id, row_number() OVER (PARTITION BY recipe_slug ORDER BY coalesce(position, 0), lower(original_text), resolution NULLS FIRST, line_id) AS place FROM r")
def review_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of lines, taken for entries of a review, within their recipes."""
    lines = table(spark, sf_dir, "ingredient_line").groupBy("line_id").agg(F.max_by(F.struct("recipe_id", "pos", "name", "unit"), "loaded_at").alias("l")).select("line_id", "l.*")
    rows = lines.select("line_id", F.col("recipe_id").alias("recipe_slug"), F.when(F.col("pos") % 5 != 0, F.col("pos")).alias("position"), F.col("name").alias("original_text"), F.col("unit").alias("resolution"))
    return rows.select("line_id", F.row_number().over(Window.partitionBy("recipe_slug").orderBy(*review_order(), "line_id")).cast("long").alias("place"))


@query("SELECT u AS url, min(part) AS part, arg_min(place, part) AS place FROM (SELECT source.url AS u, 0 AS part, min(rec_no) AS place FROM recipe_doc WHERE rec_no % 2 = 0 AND source.url IS NOT NULL GROUP BY ALL UNION ALL SELECT source.url, 1, min(rec_no) FROM recipe_doc WHERE rec_no % 3 = 0 AND source.url IS NOT NULL GROUP BY ALL) GROUP BY u")
def url_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "recipe_doc").where("source.url is not null")
    parts = [docs.where(f"rec_no % {n} = 0").select(F.col("source.url").alias("url"), F.col("rec_no").alias("place")) for n in (2, 3)]
    return I.ordered_union("url", *parts).select("url", "place.part", "place.place")


@query("SELECT DISTINCT rtrim(source.url, '/') || '/' AS url FROM recipe_doc WHERE source.url IS NOT NULL AND source.url NOT IN (SELECT source.url FROM recipe_doc WHERE rec_no % 2 = 0 AND source.url IS NOT NULL)")
def urls_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "recipe_doc").where("source.url is not null").select("rec_no", F.col("source.url").alias("url"))
    return P.urls_to_fetch(docs, docs.where("rec_no % 2 = 0").withColumn("url", F.concat("url", F.lit("/?again"))))


_PER_PAGE = 7


def _index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages of seven articles each, of which every fifth is not known to be a recipe."""
    article = F.concat(F.lit("<article class='post "), F.when(F.col("rec_no") % 5 == 0, "category-news").otherwise("category-recipes"), F.lit("'><h2><a href='/"), "slug", F.lit("?x=1'>t</a></h2><a href='/no'>n</a></article>"))
    number = F.floor(F.col("rec_no") / _PER_PAGE)
    body = table(spark, sf_dir, "recipe_doc").groupBy(number.alias("n")).agg(F.array_join(F.array_sort(F.collect_list(article)), "").alias("a"))
    links = F.concat(F.lit("<a class='page-numbers' href='/recipes/page/"), F.col("n") + 2, F.lit("'>n</a><div class='pagination'><a href='https://other.org/recipes/page/99999999/'>o</a></div>"))
    return body.select(P.index_page_url("https://x.com/recipes/", F.col("n") + 1).alias("url"), F.concat(F.lit("<html><main>"), "a", F.lit("</main>"), links, F.lit("</html>")).alias("html"))


@query("SELECT DISTINCT 'https://x.com/' || slug || '/' AS url FROM recipe_doc WHERE rec_no % 5 <> 0 OR rec_no % 2 = 0")
def crawled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    confirmed = table(spark, sf_dir, "recipe_doc").where("rec_no % 5 = 0 and rec_no % 2 = 0").select(F.concat(F.lit("https://x.com/"), "slug", F.lit("/")).alias("url"))
    return P.crawled_urls(P.page_links(_index_pages(spark, sf_dir), "x.com"), confirmed)


@query(f"SELECT max(rec_no) // {_PER_PAGE} + 2 AS last_page FROM recipe_doc")
def last_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.last_index_page(P.page_links(_index_pages(spark, sf_dir), "x.com")).select(F.col("last_page").cast("long").alias("last_page"))


@query("SELECT rec_no, CASE rec_no % 4 WHEN 3 THEN 'manual' ELSE 'valid' END AS route, CASE rec_no % 4 WHEN 3 THEN 'model output was not valid JSON' ELSE '' END AS errors FROM recipe_doc")
def improved_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a stand-in for a model improves: a fourth needs a second request, a fourth is never answered well."""

    def call(payload: str) -> str:
        import json

        told = json.loads(payload)["messages"][1]["content"]
        turn = int(json.loads(told[told.index("{") :])["rec_no"]) % 4
        again = told.startswith("Validation error")
        return "no" if turn == 3 else json.dumps({"recipe": {"rec_no": turn, "good": turn < 2 or again}})

    def check(rows: DataFrame) -> DataFrame:
        return rows.select("rec_no", F.when(F.get_json_object("recipe", "$.good") == "true", F.array().cast("array<string>")).otherwise(F.array(F.lit("not good"))).alias("errors"))

    docs = table(spark, sf_dir, "recipe_doc").select("rec_no", F.to_json(F.struct("rec_no", "slug")).alias("document"))
    return improve(docs, call, "model", "improve", check, "rec_no").select("rec_no", "route", F.array_join("errors", "; ").alias("errors"))


@query("SELECT rec_no, " + _uuid_sql("recipe", "slug") + " AS id, sha256(slug) AS digest FROM recipe_doc")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "recipe_doc").select("rec_no", entity_id("recipe", F.col("slug")).alias("id"), content_hash(F.col("slug")).alias("digest"))
