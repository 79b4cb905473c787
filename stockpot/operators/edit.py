"""Changes to ingredient ids over all documents, and repair of documents against their originals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.functions.classify import inferred_preparation, inferred_unit, repaired_difficulty
from stockpot.functions.ids import entity_id
from stockpot.functions.text import is_blank, normalize_name


def _rewritten(docs: DataFrame, sources: list[str], ingredient_id: Column, name: Column) -> DataFrame:
    """Documents that hold a source id, with those rows renamed, and rows_changed."""
    hit = lambda x: x["ingredient_id"].isin(sources)
    new = F.transform("ingredients", lambda x: F.when(hit(x), x.withField("ingredient_id", ingredient_id).withField("name", name).withField("normalized_name", name)).otherwise(x))
    n = F.size(F.filter("ingredients", hit))
    return docs.withColumn("rows_changed", n).where("rows_changed > 0").withColumn("ingredients", new)


def merge_ids(docs: DataFrame, index: DataFrame, ids: list[str]) -> DataFrame:
    """The changed documents after all ids became the first of them; its name is the normalised one of the index.

    Ids are made distinct in order; fewer than two, or one that the index lacks, are an error.
    Rows that become equal stay, as do positions and revisions.
    """
    unique = list(dict.fromkeys(ids))
    if len(unique) < 2:
        raise ValueError("merge requires at least two ingredient ids")
    known = {r.id: r.normalized_name for r in index.where(F.col("id").isin(unique)).select("id", "normalized_name").collect()}
    if missing := [i for i in unique if i not in known]:
        raise ValueError(f"unknown ingredient id(s): {', '.join(missing)}")
    return _rewritten(docs, unique, F.lit(unique[0]), F.lit(known[unique[0]]))


def rename_id(docs: DataFrame, index: DataFrame, ingredient_id: str, name: str) -> DataFrame:
    """The changed documents after an ingredient got a new name, and with it a new id."""
    if not index.where(F.col("id") == ingredient_id).take(1):
        raise ValueError(f"unknown ingredient id: {ingredient_id}")
    new = normalize_name(F.lit(name))
    wanted = docs.sparkSession.range(1).select(new.alias("n")).first().n
    if not wanted:
        raise ValueError("ingredient name cannot be empty")
    return _rewritten(docs, [ingredient_id], entity_id("ingredient", F.lit(wanted)), F.lit(wanted))


def edit_stats(changed: DataFrame) -> DataFrame:
    return changed.agg(F.count("*").alias("files_changed"), F.coalesce(F.sum("rows_changed"), F.lit(0)).alias("rows_changed"))


IMMUTABLE = ("id", "slug", "schema_version", "updated_at", "revision")


def named_objects(array: str) -> Column:
    """Whether an array holds objects with an id, slug and name alone; a null array does not."""
    good = F.forall(array, lambda x: x.isNotNull() & (F.length(x["id"]) > 0) & (F.length(x["slug"]) > 0) & (F.length(x["name"]) > 0))
    return F.coalesce(F.col(array).isNotNull() & good, F.lit(False))


def repair(original: DataFrame, candidate: DataFrame, key: str = "rec_no") -> DataFrame:
    """Candidates repaired against their originals, with the log of repairs.

    Both: key, the immutable fields, categories, tags, difficulty, ingredients. Immutable fields
    and misshapen categories and tags come back from the original, difficulty gets its known name, blank units
    and preparations of ingredients are filled where the name tells them. Candidates without an original are dropped.
    """
    old = original.select(key, *(F.col(c).alias(f"_old_{c}") for c in (*IMMUTABLE, "categories", "tags")))
    both = candidate.join(old, key)
    log = [F.when(~F.col(c).eqNullSafe(F.col(f"_old_{c}")), f"restored immutable field {c}") for c in IMMUTABLE]
    log += [F.when(~named_objects(c), f"restored {c} because model returned an invalid shape") for c in ("categories", "tags")]
    difficulty = repaired_difficulty(F.col("difficulty"))
    log.append(F.when(~difficulty.eqNullSafe(F.col("difficulty")), F.concat(F.lit("normalized difficulty from '"), F.col("difficulty"), F.lit("' to '"), difficulty, F.lit("'"))))
    fill = lambda x: F.struct(F.when(is_blank(x["unit"]), inferred_unit(x["quantity"], x["normalized_name"], x["name"])).alias("unit"), F.when(is_blank(x["preparation"]), inferred_preparation(x["name"])).alias("preparation"))
    both = both.withColumn("_log", F.array_compact(F.array(*log))).withColumn("_fill", F.transform("ingredients", fill))
    paired = F.transform("ingredients", lambda x, i: x.withField("unit", F.coalesce(F.get("_fill", i)["unit"], x["unit"])).withField("preparation", F.coalesce(F.get("_fill", i)["preparation"], x["preparation"])))
    filled = F.flatten(F.transform("_fill", lambda f, i: F.array_compact(F.array(*(F.when(f[c].isNotNull(), F.concat(F.lit(f"filled {c} for ingredient '"), F.get("ingredients", i)["name"], F.lit("'"))) for c in ("unit", "preparation"))))))
    both = both.withColumn("repairs", F.concat("_log", F.coalesce(filled, F.array().cast("array<string>"))))
    mended = {c: F.col(f"_old_{c}") for c in IMMUTABLE} | {c: F.when(named_objects(c), F.col(c)).otherwise(F.coalesce(f"_old_{c}", F.array().cast(both.schema[c].dataType))) for c in ("categories", "tags")}
    return both.withColumns(mended | {"difficulty": difficulty, "ingredients": paired}).select(*candidate.columns, "repairs")


def changed_fields(before: DataFrame, after: DataFrame, key: str, ignored: tuple[str, ...] = ("schema_version", "id", "slug", "updated_at", "revision")) -> DataFrame:
    """key and changed: the sorted names of the columns that differ, or a text that says there are none."""
    names = sorted((set(before.columns) | set(after.columns)) - set(ignored) - {key})
    a = before.select(key, F.struct(*before.columns).alias("a"))
    b = after.select(key, F.struct(*after.columns).alias("b"))
    of = lambda side, df, c: F.to_json(F.struct(F.col(f"{side}.{c}"))) if c in df.columns else F.lit(None)
    differ = F.array_compact(F.array(*(F.when(~of("a", before, c).eqNullSafe(of("b", after, c)), c) for c in names)))
    text = F.array_join(differ, ", ")
    return a.join(b, key).select(key, F.when(text == "", "no visible changes").otherwise(text).alias("changed"))
