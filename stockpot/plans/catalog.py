"""The batch plan of a catalog: canonical documents, indexes, review, manifest and release."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpot.functions.ids import entity_id
from stockpot.functions.text import file_name_of_sequence
from stockpot.operators import indexes as I
from stockpot.operators.ingredients import canonicalize_lines, normalize_lines
from stockpot.operators.validate import require_valid
from stockpot.session import cut
from stockpot.sources.documents import dump_json, dump_rows, exists, read_bytes

# Versions that a catalog states of itself, and the schemas that its files name.
VERSION, CATALOG_VERSION, CLIENT_VERSION = 1, "v1", "1.0.0"
SCHEMAS = {
    "document": "recipe.schema.json", "recipes": "recipes-index.schema.json", "categories": "categories-index.schema.json", "tags": "tags-index.schema.json",
    "ingredients": "ingredients-index.schema.json", "entries": "ingredients-review.schema.json", "upserts": "manifest.schema.json", "release": "release.schema.json",
}


def ingredient_rows(docs: DataFrame, key: str, place: str = "position") -> DataFrame:
    """One row per ingredient of a document, in stored order: key, slug, name of the document, and the ingredient's fields."""
    rows = docs.select(F.col(key).alias("_key"), F.col("slug").alias("recipe_slug"), F.col("name").alias("recipe_name"), F.posexplode("ingredients").alias("_at", "_x")).where("_x is not null")
    return rows.select("_key", "recipe_slug", "recipe_name", "_at", F.col(f"_x.{place}").alias("position"), *(F.col(f"_x.{f}").alias(f) for f in ("ingredient_id", "name", "normalized_name", "quantity", "unit", "preparation")))


def canonical_lines(docs: DataFrame, key: str, place: str = "position") -> DataFrame:
    """The ingredient rows normalised and made canonical, with kept and review.

    Reading a line costs far more than moving it, so lines are dealt out by their document
    first; the number is that of the session, as few large files would else be few tasks.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return canonicalize_lines(normalize_lines(ingredient_rows(docs, key, place).repartition(tasks, "_key")))


def canonical_ingredients(lines: DataFrame) -> DataFrame:
    """One row per kept ingredient. position counts them in their document from 1.

    The count is by document, of which the rows are few; no document is larger than its own list.
    """
    per_document = lines.groupBy("_key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_at", "kept"))), lambda x: x["kept"])).alias("_all"))
    return per_document.select(F.col("_key").alias("document"), F.posexplode("_all").alias("_p", "_x")).select("document", (F.col("_p") + 1).cast("int").alias("position"), "_x.*")


def review_queue(lines: DataFrame) -> DataFrame:
    """The doubtful ingredients, each with its document; order by review_order."""
    rows = lines.where("review is not null")
    return rows.select(entity_id("recipe", F.col("recipe_slug")).alias("recipe_id"), "recipe_slug", "recipe_name", "position", "review.original_text", "review.quantity", "review.unit", "review.cleaned_name", "review.replacements", "review.issue_types", "review.resolution")


def review_order() -> list[Column]:
    return [F.col("recipe_slug"), F.coalesce("position", F.lit(0)), F.lower("original_text"), F.col("resolution")]


def manifest(summaries: DataFrame, sequence: int) -> DataFrame:
    """The full snapshot as upserts, by slug, with the sequences it leads from and to."""
    rows = summaries.select("id", "slug", "updated_at", "revision", *[c for c in ("file_sha256", "recipe_path") if c in summaries.columns])
    return rows.withColumns({"from_sequence": F.lit(max(sequence - 1, 0)), "to_sequence": F.lit(sequence), "file_name": file_name_of_sequence(F.lit(sequence))})


def next_sequence(release: dict[str, Any] | None, bump: bool) -> int:
    return int((release or {}).get("repo_sequence", 1)) + bool(bump)


def load_release(folder: str | Path, now: str = "1970-01-01T00:00:00Z") -> dict[str, Any]:
    """The release of a catalog, or that of an empty one."""
    path = f"{folder}/release.json"
    if exists(path):
        return json.loads(read_bytes(path))
    return {
        "$schema": f"./schemas/{SCHEMAS['release']}", "schema_version": VERSION, "catalog_version": CATALOG_VERSION, "repo_sequence": 1, "generated_at": now,
        "minimum_supported_client_version": CLIENT_VERSION, "indexes": {}, "latest_manifest": {},
    }


def canonical_documents(docs: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Documents with the identities of their natural keys, and with the kept ingredients of their lines, numbered anew."""
    kept = canonical_ingredients(lines).groupBy("document").agg(F.array_sort(F.collect_list(F.struct("position", "ingredient_id", "name", "normalized_name", "quantity", "unit", "preparation"))).alias("ingredients"))
    named = lambda array, kind: F.transform(array, lambda x: x.withField("id", entity_id(kind, x["slug"])))
    joined = docs.drop("ingredients").join(kept, docs[key] == kept["document"], "left").drop("document")
    return joined.withColumns({
        "schema_version": F.lit(VERSION), "id": entity_id("recipe", F.col("slug")), "categories": named("categories", "category"), "tags": named("tags", "tag"),
        "ingredients": F.coalesce("ingredients", F.array().cast(kept.schema["ingredients"].dataType)),
    })


def valid_rows(rows: DataFrame, name: str, schemas: str | None) -> DataFrame:
    """rows, or an error at the first action where one of them breaks the schema of its file; without a folder of schemas, or the file in it, unchecked."""
    if not schemas or not exists(f"{schemas}/{SCHEMAS[name]}"):
        return rows
    root = json.loads(read_bytes(f"{schemas}/{SCHEMAS[name]}"))
    own = root if name in ("document", "release") else root["properties"][name]["items"]
    while "$ref" in own:
        own = root["$defs"][own["$ref"].rpartition("/")[2]]
    known = [c for c in rows.columns if c in own.get("properties", {})] if name == "document" else rows.columns
    return require_valid(rows, {**own, "$defs": root.get("$defs", {}), **({"additionalProperties": True} if name == "document" else {})}, name) if known else rows


def require_valid_release(spark: SparkSession, release: dict[str, Any], schemas: str | None) -> None:
    if schemas:
        text = F.lit(json.dumps(release))
        valid_rows(spark.range(1).select(F.from_json(text, F.schema_of_json(text)).alias("r")).select("r.*"), "release", schemas).count()


def build_catalog(docs: DataFrame, out: str, key: str = "path", bump: bool = False, fallback: str = "1970-01-01T00:00:00Z", schemas: str | None = None, tables: str | None = None) -> dict[str, Any]:
    """Writes indexes, review, manifest and, last, the release that points at them; returns the release.

    docs: documents with path, their ordinal, and file_sha256 and recipe_path where these are
    known. An input without documents is an error. schemas: a folder of JSON Schemas that
    documents and all files written are checked by, the first that is broken being an error;
    without it nothing is checked. tables: a folder in which the executors write the same
    indexes as tables, for catalogs whose files would be too large. The release is put in place
    at once after all files it names, so a build that fails leaves the old one whole.
    """
    if not docs.take(1):
        raise ValueError("no documents to build a catalog from")
    docs = cut(docs, "documents")
    lines = cut(canonical_lines(docs, key), "lines")
    canonical = cut(valid_rows(canonical_documents(docs, lines, key), "document", schemas), "canonical")
    before = load_release(out, fallback)
    sequence = next_sequence(before, bump)
    stamp = I.generated_at(canonical, before.get("generated_at") or fallback).first().generated_at
    header = lambda name: {"$schema": f"../schemas/{SCHEMAS[name]}", "schema_version": VERSION}
    at = {"generated_at": stamp, "repo_sequence": sequence}
    summaries = cut(I.recipe_summaries(canonical), "summaries")
    categories = I.category_index(canonical, key)
    parts = {
        "recipes": I.in_index_order(I.browse_rows(summaries)),
        "categories": categories.select("id", "slug", "name", *(["description"] if "description" in categories.columns else []), "recipe_count").orderBy("slug"),
        "tags": I.tag_index(canonical, key).select("id", "slug", "name", "color", "recipe_count").orderBy("slug"),
        "ingredients": I.ingredient_index(canonical, key).select("id", "name", "normalized_name", "recipe_count").orderBy("normalized_name"),
    }
    for name, rows in parts.items():
        dump_rows(f"{out}/indexes/{name}.index.json", {**header(name), **at}, name, valid_rows(rows, name, schemas))
    entries = review_queue(lines).orderBy(*review_order())
    dump_rows(f"{out}/indexes/ingredients.review.json", {**header("entries"), **at}, "entries", valid_rows(entries, "entries", schemas))
    upserts = summaries.select("id", "slug", "updated_at", "revision", *(c for c in I.FILE_COLUMNS if c in summaries.columns)).orderBy("slug")
    if all(c in summaries.columns for c in I.FILE_COLUMNS):
        upserts = valid_rows(upserts, "upserts", schemas)
    file = f"manifests/{sequence:010d}.json"
    dump_rows(f"{out}/{file}", {**header("upserts"), "from_sequence": max(sequence - 1, 0), "to_sequence": sequence, "generated_at": stamp}, "upserts", upserts, {"removals": []})
    for name, rows in (({**parts, "review": entries, "manifest": upserts}) if tables else {}).items():
        rows.write.mode("overwrite").parquet(f"{tables}/{name}")
    digest = lambda path: hashlib.sha256(read_bytes(f"{out}/{path}")).hexdigest()
    release = {
        "minimum_supported_client_version": CLIENT_VERSION, **before, "$schema": f"./schemas/{SCHEMAS['release']}", "schema_version": VERSION, "catalog_version": CATALOG_VERSION, "repo_sequence": sequence, "generated_at": stamp,
        "indexes": {name: {"path": f"indexes/{name}.index.json", "sha256": digest(f"indexes/{name}.index.json")} for name in parts},
        "latest_manifest": {"sequence": sequence, "path": file, "sha256": digest(file)},
    }
    require_valid_release(docs.sparkSession, release, schemas)
    dump_json(f"{out}/release.json", release)
    return release
