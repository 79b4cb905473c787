"""Facet search, joins by slug, related records and incremental sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpot.functions.text import search_blob


def with_search_terms(summaries: DataFrame) -> DataFrame:
    """summaries with search_terms, the text that search looks in; made once, when a catalog is built."""
    lists = lambda c, s: F.array_join(F.coalesce(c, F.array().cast("array<string>")), s)
    blob = search_blob(F.col("name"), F.col("slug"), F.col("brief_description"), lists("ingredient_names", " "), lists("category_slugs", ", "), lists("tag_slugs", ", "), F.col("difficulty"))
    return summaries.withColumn("search_terms", blob)


def facet(query: str = "", category: str = "", tag: str = "", difficulty: str = "") -> Column:
    """The predicate of a search; an empty facet passes every row."""
    parts = [F.lit(True)]
    if wanted := query.strip().lower():
        parts.append(F.col("search_terms").contains(wanted))
    if category:
        parts.append(F.coalesce(F.array_contains("category_slugs", category), F.lit(False)))
    if tag:
        parts.append(F.coalesce(F.array_contains("tag_slugs", tag), F.lit(False)))
    if difficulty:
        parts.append(F.coalesce(F.col("difficulty") == difficulty, F.lit(False)))
    result = parts[0]
    for p in parts[1:]:
        result = result & p
    return result


def search(summaries: DataFrame, **facets: str) -> DataFrame:
    """The rows that all given facets pass."""
    return (summaries if "search_terms" in summaries.columns else with_search_terms(summaries)).where(facet(**facets))


def visible(summaries: DataFrame, **facets: str) -> DataFrame:
    """One row: how many rows the facets pass, of how many."""
    return with_search_terms(summaries).agg(F.count_if(facet(**facets)).alias("visible"), F.count("*").alias("total"))


def slug_join(index: DataFrame, docs: DataFrame, ordinal: str) -> DataFrame:
    """Rows of an index with the document of their slug; of several the last by ordinal, rows without one dropped.

    Columns of the document that the index has too get the prefix doc_.
    """
    last = docs.groupBy("slug").agg(F.max_by(F.struct(*[F.col(c).alias(f"doc_{c}" if c in index.columns else c) for c in docs.columns if c != "slug"]), F.col(ordinal)).alias("_d"))
    return index.join(last, "slug").select(*index.columns, "_d.*")


def related(docs: DataFrame, index: DataFrame, most: int = 6) -> DataFrame:
    """id, related_id, place: the first rows of the index, in its order, that each document names as related.

    docs: id, related_recipe_ids; index: id, name, slug. An equi-join on the exploded ids;
    the ranking keeps at most `most` rows per document, so sorts stay small.
    """
    named = docs.select("id", F.explode(F.array_distinct("related_recipe_ids")).alias("related_id"))
    found = named.join(index.select(F.col("id").alias("related_id"), F.lower("name").alias("_n"), F.col("slug").alias("_s")), "related_id")
    order = Window.partitionBy("id").orderBy("_n", "_s", "related_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("id", "related_id", "place")


def sync_diff(local: DataFrame, remote: DataFrame, key: str = "id", digest: str = "digest") -> DataFrame:
    """key and op: fetch for what is missing here or differs, remove for what is there no more.

    One full outer join; rows that agree give nothing. A null digest equals a null digest only.
    """
    here = local.select(key, F.col(digest).alias("_l"), F.lit(True).alias("_here"))
    there = remote.select(key, F.col(digest).alias("_r"), F.lit(True).alias("_there"))
    op = F.when(F.col("_there").isNull(), "remove").when(F.col("_here").isNull() | ~F.col("_l").eqNullSafe(F.col("_r")), "fetch")
    return here.join(there, key, "full_outer").select(key, op.alias("op")).where("op is not null")


def not_done(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The items whose key is not among those done."""
    return items.join(done.select(key), key, "left_anti")


def next_item(items: DataFrame, done: DataFrame, key: str, order: str) -> DataFrame:
    """The first item in order that is not done."""
    return not_done(items, done, key).orderBy(order).limit(1)
