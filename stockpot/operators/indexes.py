"""Entity indexes with counts, recipe summaries and catalog statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpot.functions.classify import total_minutes, utc_text
from stockpot.functions.ids import entity_id
from stockpot.session import cut


#: Columns of a summary that tell of its file.
FILE_COLUMNS = ("file_sha256", "recipe_path")


def entity_index(docs: DataFrame, array: str, key: str, attributes: list[str], ordinal: str, count: str = "recipe_count") -> DataFrame:
    """One row per key of an array of objects: key, attributes of its last occurrence, number of occurrences.

    An object that a document holds twice counts twice. The last occurrence is that of the
    greatest ordinal, then of the greatest place in the array. Null arrays, objects and keys
    give nothing. The counts are combined before the shuffle, so frequent keys are no hot keys.
    """
    each = docs.select(F.col(ordinal).alias("_o"), F.posexplode(array).alias("_p", "_x")).where(F.col(f"_x.{key}").isNotNull())
    last = F.max_by(F.struct(*(F.col(f"_x.{a}").alias(a) for a in attributes)), F.struct("_o", "_p"))
    return each.groupBy(F.col(f"_x.{key}").alias(key)).agg(last.alias("_l"), F.count("*").alias(count)).select(key, "_l.*", count)


def category_index(docs: DataFrame, ordinal: str) -> DataFrame:
    """Counts of categories; their description is given where the documents have one."""
    more = ["description"] if "description" in docs.schema["categories"].dataType.elementType.fieldNames() else []
    return entity_index(docs, "categories", "slug", ["name", *more], ordinal).withColumn("id", entity_id("category", F.col("slug")))


def tag_index(docs: DataFrame, ordinal: str) -> DataFrame:
    return entity_index(docs, "tags", "slug", ["name", "color"], ordinal).withColumn("id", entity_id("tag", F.col("slug")))


def ingredient_index(docs: DataFrame, ordinal: str) -> DataFrame:
    return entity_index(docs, "ingredients", "normalized_name", ["name"], ordinal).withColumn("id", entity_id("ingredient", F.col("normalized_name")))


def recipe_summaries(docs: DataFrame) -> DataFrame:
    """The summary of each document: identity, times with their total, plucked arrays, number of steps, and hash and path of its file where these are known."""
    pluck = lambda array, field: F.coalesce(F.transform(F.filter(array, lambda x: x.isNotNull()), lambda x: x[field]), F.array().cast("array<string>"))
    minutes = [F.col(c) for c in ("preparation_time_minutes", "cooking_time_minutes", "rest_time_minutes")]
    return docs.select(
        entity_id("recipe", F.col("slug")).alias("id"), "slug", "name", "recipe_type", "brief_description", "cuisine", "image_url", "difficulty", "servings",
        "cooking_time_minutes", "preparation_time_minutes", "rest_time_minutes", total_minutes(*minutes).alias("total_time_minutes"),
        pluck("categories", "slug").alias("category_slugs"), pluck("tags", "slug").alias("tag_slugs"), "dietary_labels", "allergens",
        pluck("ingredients", "name").alias("ingredient_names"), F.size(F.coalesce("instructions", F.array())).alias("instruction_step_count"), "updated_at", "revision",
        *(c for c in FILE_COLUMNS if c in docs.columns),
    )


def browse_rows(summaries: DataFrame) -> DataFrame:
    """Summaries as an index lists them, without hash and path."""
    return summaries.drop(*FILE_COLUMNS)


def in_index_order(summaries: DataFrame) -> DataFrame:
    """By lower-cased name, then slug, in code point order."""
    return summaries.orderBy(F.lower("name"), "slug")


def index_places(summaries: DataFrame, key: str) -> DataFrame:
    """key and place from 1 of every entry in index order; entries of one name and slug go by key.

    Entries are parted by range and numbered within each part; a part's places start behind
    those of the parts before it. Only one row a part is gathered.
    """
    ordered = summaries.select(key, F.lower("name").alias("_n"), "slug").repartitionByRange("_n", "slug", key).sortWithinPartitions("_n", "slug", key)
    # the number holds the part in its upper bits and the row within the part in the lower 33
    numbered = cut(ordered.select(key, F.monotonically_increasing_id().alias("_i")), "places")
    part, row = F.shiftright("_i", 33).alias("_part"), F.col("_i").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part).agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_start"))
    return numbered.select(key, part, row.alias("_row")).join(F.broadcast(starts), "_part").select(key, (F.col("_start") + F.col("_row") + 1).alias("place"))


def in_locale_order(df: DataFrame, name: str = "name") -> DataFrame:
    return df.orderBy(F.expr(f"`{name}` COLLATE UNICODE"))


def first_in_locale_order(df: DataFrame, name: str = "name", n: int = 6) -> DataFrame:
    """The first n rows in locale order."""
    return in_locale_order(df, name).limit(n)


def generated_at(docs: DataFrame, fallback: str) -> DataFrame:
    """One row with the latest update as UTC text, or the fallback."""
    return docs.agg(F.coalesce(utc_text(F.max("updated_at")), F.lit(fallback)).alias("generated_at"))


def top(index: DataFrame, key: str, n: int = 10, count: str = "recipe_count") -> DataFrame:
    """The n entries with the most occurrences, those with one left out; ties by key."""
    return index.where(F.col(count) > 1).orderBy(F.desc(count), key).limit(n)


def average_minutes(total: str = "total_time_minutes") -> Column:
    """The mean with null as 0, rounded half up."""
    return F.floor(F.try_divide(F.sum(F.coalesce(total, F.lit(0))), F.count("*")) + 0.5)


def catalog_stats(summaries: DataFrame) -> DataFrame:
    """One row with the number of recipes, of distinct categories, tags and ingredients, and the mean minutes."""
    long = lambda kind, c: summaries.select(F.lit(kind).alias("kind"), F.explode(c).alias("value"))
    values = long("categories", "category_slugs").union(long("tags", "tag_slugs")).union(long("ingredients", "ingredient_names")).where("value is not null").distinct()
    counts = values.agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("categories", "tags", "ingredients")))
    return summaries.agg(F.count("*").alias("recipes"), average_minutes().alias("average_minutes")).join(F.broadcast(counts))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an order; other columns stay."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def renumbered(array: Column, field: str) -> Column:
    """An array of objects with the field set to the running number of those that are not null."""
    return F.transform(F.filter(array, lambda x: x.isNotNull()), lambda x, i: x.withField(field, (i + 1).cast("int")))


def by_position(array: str, field: str = "position") -> Column:
    """An array of objects in the order of a field, those without it and null objects last, ties in stored order."""
    placed = F.transform(array, lambda x, i: F.struct(F.coalesce(x[field], F.lit(2**31 - 1)).alias("at"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(placed, lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(a["i"] - b["i"])), lambda p: p["x"])


def ordered_union(key: str, *parts: DataFrame) -> DataFrame:
    """key and place: the rows of several tables (key, place), one table after the other, each key where it is met first."""
    every = [p.select(key, F.struct(F.lit(i).alias("part"), F.col("place").alias("place")).alias("place")) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, every).groupBy(key).agg(F.min("place").alias("place"))


def document_order(df: DataFrame, path: str) -> DataFrame:
    """df with the ordinal that decides which occurrence is the last: the path itself, in code point order."""
    return df.withColumn("ordinal", F.col(path))
