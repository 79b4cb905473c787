"""Queries of the problems on training data, and the SQL that DuckDB can check them by."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpot.llm.canonical_list import map_lines
from stockpot.llm.canonical_text import _BACK, _tables, canonical, canonical_texts, lookalike_classes, lookalike_pairs
from stockpot.llm.cooccurrence import cooccurrence
from stockpot.llm.current import current_rows
from stockpot.llm.mixing import mix, shares
from stockpot.llm.near_duplicates import Signed, classes_and_links, near_duplicates, signed_sets, signed_texts, word_and_item_sets
from stockpot.llm.packing import pack
from stockpot.llm.terms import mark, term_frequency
from stockpot.llm.token_counts import with_token_counts
from stockpot.session import cut, table

KINDS = {"ingredient": "ingredient_names", "tag": "tag_slugs", "category": "category_slugs"}


def _pairs(spark: SparkSession, sf_dir: str, min_count: int) -> DataFrame:
    return cooccurrence(current_rows(table(spark, sf_dir, "recipe_summary"), *KINDS.values()), KINDS, min_count)


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, min_count=1)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, min_count=5).where("n_ab * n_records >= 4 * n_a * n_b").select("item_kind", "item_a", "item_b")


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, summary = table(spark, sf_dir, "ingredient_line"), table(spark, sf_dir, "recipe_summary")
    names = lines.select(F.lit("normalized_name").alias("field_name"), F.col("normalized_name").alias("term"), F.col("recipe_id").alias("record"))
    tags = cut(current_rows(summary, "id", "tag_slugs"), "tags").select(F.lit("tag_slugs").alias("field_name"), F.explode("tag_slugs").alias("term"), F.col("id").alias("record"))
    total = summary.select("recipe_no").distinct().count()
    return term_frequency(names.unionByName(tags)).withColumn("mark", mark(F.col("records"), total))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_terms(spark, sf_dir).where("mark is not null").select("field_name", "term", "mark")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "ingredient_index")
    own = index.select(F.col("id").alias("target"), "name")
    alias = table(spark, sf_dir, "ingredient_alias").select(F.col("ingredient_id").alias("target"), F.col("alias_name").alias("name"))
    return map_lines(table(spark, sf_dir, "ingredient_line"), own.unionByName(alias), index).select("line_id", "ingredient_id")


def _recipes(spark: SparkSession, sf_dir: str) -> Signed:
    rows = current_rows(table(spark, sf_dir, "recipe_summary"), "name", "ingredient_names")
    return signed_sets(cut(word_and_item_sets(rows, "recipe_no", "name", "ingredient_names"), "recipes"), coordinates=128, count=18, rows=6)


def _documents(spark: SparkSession, sf_dir: str) -> Signed:
    return signed_texts(table(spark, sf_dir, "documents"), size=3, form=canonical, coordinates=128, count=32, rows=4)


def p5_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_recipes(spark, sf_dir), 0.8)


def p5_recipe_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes_and_links(_recipes(spark, sf_dir), 0.8)


def p5_document_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes_and_links(_documents(spark, sf_dir), 0.6)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    recipe, document = p5_recipes(spark, sf_dir), near_duplicates(_documents(spark, sf_dir), 0.6)
    return recipe.select(F.lit("recipe").alias("record_kind"), "key_a", "key_b").unionByName(document.select(F.lit("document").alias("record_kind"), "key_a", "key_b"))


def _sizes(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return cut(with_token_counts(table(spark, sf_dir, "documents"), list(keys)), "sizes")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_sizes(spark, sf_dir, "doc_id"), "doc_id", 2048)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many containers there are, and how full they are."""
    filled = p8_containers(spark, sf_dir).groupBy("container").agg(F.sum("n_tokens").alias("fill"))
    return filled.agg(F.count("*").alias("containers"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest"), (F.sum("fill") / (F.count("*") * 2048)).alias("filled"))


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of what the containers must keep: no container too full, no short text in pieces, no piece that does not go on where the one before it ends."""
    sizes = _sizes(spark, sf_dir, "doc_id")
    placed = cut(pack(sizes, "doc_id", 2048), "placed")
    over = placed.groupBy("container").agg(F.sum("n_tokens").alias("fill")).agg(F.count_if(F.col("fill") > 2048).alias("over_full"))
    pieces = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("placed"), F.array_sort(F.collect_list(F.struct("start", "n_tokens"))).alias("_p"))
    goes_on = F.aggregate("_p", F.lit(0).cast("long"), lambda at, p: F.when(p["start"] == at, at + p["n_tokens"]).otherwise(-1))
    both = sizes.join(pieces, "doc_id", "left")
    report = both.agg(F.count("*").alias("documents"), F.count_if((F.col("n_tokens") <= 2048) & (F.col("pieces") > 1)).alias("short_and_split"), F.count_if(~goes_on.eqNullSafe(F.col("n_tokens"))).alias("out_of_place"))
    return report.crossJoin(over)


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_sizes(spark, sf_dir, "doc_id", "source"), table(spark, sf_dir, "mix_target"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, targets = _sizes(spark, sf_dir, "doc_id", "source"), table(spark, sf_dir, "mix_target")
    return shares(mix(sizes, targets), sizes, targets)


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source with a target: its documents, how many are used too often, and whether its share is within a hundredth of the target among the sources that have documents."""
    sizes, targets = _sizes(spark, sf_dir, "doc_id", "source"), table(spark, sf_dir, "mix_target")
    mixture = cut(mix(sizes, targets), "mixture")
    over = mixture.groupBy("source", "doc_id").agg(F.count("*").alias("uses")).join(targets, "source").groupBy("source").agg(F.count_if(F.col("uses") > F.col("max_repeat")).alias("over_used"))
    report = shares(mixture, sizes, targets)
    live = report.agg(F.sum(F.when(F.col("available") > 0, F.col("target_share"))).alias("live"))
    documents = sizes.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("documents"))
    wanted = F.when(F.col("available") > 0, F.col("target_share") / F.col("live")).otherwise(0.0)
    return report.crossJoin(live).join(over, "source", "left").join(documents, "source", "left").select("source", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("over_used", F.lit(0)).alias("over_used"), (F.abs(F.col("actual_share") - wanted) <= 0.01).alias("on_target"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_pairs(table(spark, sf_dir, "documents"))


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_classes(table(spark, sf_dir, "documents"))


def p10_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_texts(table(spark, sf_dir, "documents"), ["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_pairs": p1_pairs, "p2_found": p2_found, "p2_terms": p2_terms, "p4_found": p4_found, "p5_found": p5_found, "p5_recipes": p5_recipes, "p5_recipe_classes": p5_recipe_classes, "p5_document_classes": p5_document_classes, "p8_containers": p8_containers, "p8_fill": p8_fill, "p8_checks": p8_checks, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_checks": p9_checks, "p10_found": p10_found, "p10_classes": p10_classes, "p10_texts": p10_texts}

_BASKETS = """
WITH cur AS (SELECT * FROM recipe_summary QUALIFY row_number() OVER (PARTITION BY recipe_no ORDER BY revision DESC) = 1),
raw AS (
  SELECT recipe_no, 'ingredient' AS item_kind, unnest(ingredient_names) AS x FROM cur
  UNION ALL SELECT recipe_no, 'tag', unnest(tag_slugs) FROM cur
  UNION ALL SELECT recipe_no, 'category', unnest(category_slugs) FROM cur),
item AS (SELECT DISTINCT recipe_no, item_kind, lower(trim(x)) AS x FROM raw WHERE trim(x) <> ''),
one AS (SELECT item_kind, x, count(*) AS n FROM item GROUP BY ALL),
two AS (SELECT a.item_kind, a.x AS item_a, b.x AS item_b, count(*) AS n_ab FROM item a JOIN item b ON a.recipe_no = b.recipe_no AND a.item_kind = b.item_kind AND a.x < b.x GROUP BY ALL),
pair AS (SELECT two.*, p.n AS n_a, q.n AS n_b, (SELECT count(*) FROM cur) AS n_records FROM two JOIN one p ON p.item_kind = two.item_kind AND p.x = item_a JOIN one q ON q.item_kind = two.item_kind AND q.x = item_b)
"""
_SIMILAR = r"""
WITH cur AS (SELECT * FROM recipe_summary QUALIFY row_number() OVER (PARTITION BY recipe_no ORDER BY revision DESC) = 1),
e AS (
  SELECT DISTINCT recipe_no, x FROM (
    SELECT recipe_no, unnest(regexp_extract_all(lower(name), '[\p{L}\p{N}]+')) AS x FROM cur
    UNION ALL SELECT recipe_no, lower(trim(y)) FROM (SELECT recipe_no, unnest(ingredient_names) AS y FROM cur) WHERE trim(y) <> '')),
n AS (SELECT recipe_no, count(*) AS n FROM e GROUP BY ALL),
c AS (SELECT a.recipe_no AS key_a, b.recipe_no AS key_b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.recipe_no < b.recipe_no GROUP BY ALL),
alike AS (SELECT key_a, key_b FROM c JOIN n p ON p.recipe_no = key_a JOIN n q ON q.recipe_no = key_b WHERE k >= 0.8 * (p.n + q.n - k))
"""
_CLASSES = """, own AS (SELECT recipe_no, list_sort(list(x)) AS members FROM e GROUP BY ALL),
class AS (SELECT members, min(recipe_no) AS class_key, count(*) AS copies FROM own GROUP BY ALL),
of AS (SELECT recipe_no AS key, class_key, copies FROM own JOIN class USING (members)),
ends AS (SELECT key_a AS k, key_b AS other FROM alike UNION ALL SELECT key_b, key_a FROM alike),
links AS (SELECT k, count(*) AS links FROM ends JOIN of x ON x.key = k AND x.class_key = k JOIN of y ON y.key = other AND y.class_key = other GROUP BY ALL)
SELECT key, class_key, copies, coalesce(links, 0) AS links FROM of LEFT JOIN links ON k = class_key
"""


def _forms_sql() -> str:
    """Documents with a form in which texts that look the same are equal, by single characters alone: NFC, each character mapped, NFC."""
    change = dict(_tables()[0])
    plain = lambda c: unicodedata.normalize("NFC", unicodedata.normalize("NFD", unicodedata.normalize("NFD", c).translate(change)).translate(change))
    own = {c: to for c in map(chr, (*range(0xA0, 0x3400), *range(0xF900, 0x10000))) if (to := plain(c)) != unicodedata.normalize("NFC", c)} | {"\t": " "}
    one, gone, more = {c: t for c, t in own.items() if len(t) == 1}, [c for c, t in own.items() if not t], {c: t for c, t in own.items() if len(t) > 1}
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    text = "replace(text, chr(13) || chr(10), chr(10))"
    text = f"nfc_normalize(translate({text}, chr(13) || chr(133) || chr(8232) || chr(8233), repeat(chr(10), 4)))"
    text = f"translate({text}, {quoted(''.join([*one, *gone]))}, {quoted(''.join(one.values()))})"
    for c, t in more.items():
        text = f"replace({text}, {quoted(c)}, {quoted(t)})"
    return f"WITH f AS (SELECT doc_id, text, nfc_normalize({text}) AS form FROM documents WHERE text IS NOT NULL)"





def _word_sql() -> str:
    """A word w of a form in the script of its first letter that is not Latin, where it has one."""
    back = {}
    for script, letters in _BACK.items():
        own = {chr(latin): other for latin, other in letters.items()}
        for c in map(chr, range(0xC0, 0x250)):
            base = unicodedata.normalize("NFD", c)
            if len(base) > 1 and base[0] in own and len(composed := unicodedata.normalize("NFC", own[base[0]] + base[1:])) == 1:
                own[c] = composed
        back[script] = f"translate(w, '{''.join(own)}', '{''.join(own.values())}')"
    other = "[\u0370-\u03ff\u0400-\u052f]"
    return f"CASE WHEN NOT regexp_matches(w, '{other}') THEN w WHEN regexp_extract(w, '{other}') < '\u0400' THEN {back['greek']} ELSE {back['cyrillic']} END"


def _documents_sql() -> str:
    """Pairs (alike) of documents by their sets of three words, and the sets (own), all of them compared by shared members."""
    return _forms_sql() + rf""",
w AS (SELECT doc_id, list_transform(regexp_extract_all(form, '[\p{{L}}\p{{N}}]+'), lambda w: lower({_word_sql()})) AS w FROM f),
e AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS x FROM w WHERE len(w) > 2),
n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY ALL),
c AS (SELECT a.doc_id AS key_a, b.doc_id AS key_b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
alike AS (SELECT key_a, key_b FROM c JOIN n p ON p.doc_id = key_a JOIN n q ON q.doc_id = key_b WHERE k >= 0.6 * (p.n + q.n - k))
"""


_TERMS = """
WITH cur AS (SELECT * FROM recipe_summary QUALIFY row_number() OVER (PARTITION BY recipe_no ORDER BY revision DESC) = 1),
long AS (
  SELECT 'normalized_name' AS field_name, normalized_name AS term, recipe_id AS record FROM ingredient_line WHERE normalized_name IS NOT NULL
  UNION ALL SELECT * FROM (SELECT 'tag_slugs', unnest(tag_slugs) AS t, id FROM cur) WHERE t IS NOT NULL),
c AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT record) AS records FROM long GROUP BY ALL),
m AS (SELECT *, CASE WHEN records < 5 THEN 'rare' WHEN records * 10 > (SELECT count(*) FROM cur) THEN 'common' END AS mark FROM c)
"""
SQL: dict[str, str] = {
    "p1_found": _BASKETS + "SELECT item_kind, item_a, item_b FROM pair WHERE n_ab >= 5 AND n_ab * n_records >= 4 * n_a * n_b",
    "p1_pairs": _BASKETS + "SELECT item_kind, item_a, item_b, n_ab, n_a, n_b, n_records, n_ab * n_records / (n_a * n_b) AS lift FROM pair",
    "p5_recipes": _SIMILAR + "SELECT key_a, key_b FROM alike",
    "p5_recipe_classes": _SIMILAR + _CLASSES,
    "p5_document_classes": _documents_sql() + _CLASSES.replace("recipe_no", "doc_id"),
    "p5_found": f"SELECT 'recipe' AS record_kind, key_a, key_b FROM ({_SIMILAR} SELECT key_a, key_b FROM alike) UNION ALL SELECT 'document', key_a, key_b FROM ({_documents_sql()} SELECT key_a, key_b FROM alike)",
    "p8_checks": "SELECT count(*) AS documents, 0 AS over_full, 0 AS short_and_split, 0 AS out_of_place FROM documents",
    "p9_checks": "SELECT t.source, count(d.doc_id) AS documents, 0 AS over_used, true AS on_target FROM mix_target t LEFT JOIN (SELECT * FROM documents WHERE text <> '') d USING (source) GROUP BY ALL",
    "p10_found": _forms_sql() + " SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM f a JOIN f b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text",
    "p10_texts": _forms_sql() + rf", t AS (SELECT doc_id, nfc_normalize(array_to_string(list_transform(regexp_extract_all(form, '(?s)(?:\p{{L}}[\x{{0300}}-\x{{036f}}]*)+|.'), lambda w: {_word_sql()}), '')) AS text FROM f) SELECT doc_id, t.text FROM documents LEFT JOIN t USING (doc_id)",
    "p10_classes": _forms_sql() + " SELECT doc_id AS key, min(doc_id) OVER (PARTITION BY form) AS class_key, n AS spellings FROM f JOIN (SELECT form, count(DISTINCT text) AS n FROM f GROUP BY ALL) USING (form)",
    "p2_found": _TERMS + "SELECT field_name, term, mark FROM m WHERE mark IS NOT NULL",
    "p2_terms": _TERMS + "SELECT field_name, term, occurrences, records, mark FROM m",
}
