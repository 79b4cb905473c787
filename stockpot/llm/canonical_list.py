"""Problem 4: freely typed values mapped to a canonical list.

Method. Token-level repair: each distinct token is joined to the tokens of the reference
list by edit distance, through the texts both leave when letters are deleted; the corrected
tokens of a value are combined with soft TF-IDF to rank complete entries. Words about
quality, size or use carry no weight, nor do makers, which the corpus tells: unknown words
in front of many different entries.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

NONE = "none"
# Words about quality, size, preparation and use that may stand around a name.
MODIFIERS = (
    "fresh organic best premium extra homemade good quality local imported ripe firm whole small medium large big tiny some few a an of the or more for garnish serve serving to at hand as needed "
    "choice divided optional any kind store bought raw pure natural plain real fine finest quality new jumbo mini little plus taste your favorite favourite brand preferably well very approximately about if desired available"
).split()


#: Accented letters of the Latin blocks and their bases, made by rule.
_ACCENTED = "".join(c for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFD", c)) > 1)
_BASES = "".join(unicodedata.normalize("NFD", c)[0] for c in _ACCENTED)


def tokens(text: Column) -> Column:
    """Lower-cased words without accents; what stands in brackets and all punctuation is dropped."""
    plain = F.lower(F.translate(F.regexp_replace(text, r"\p{M}", ""), _ACCENTED, _BASES))
    plain = F.regexp_replace(F.regexp_replace(plain, r"\([^()]*\)", " "), r"['’]", "")
    return F.filter(F.split(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "), " "), lambda t: t != "")


def _allowed(length: Column) -> Column:
    """The edits that the longer of two tokens may need: none to two letters, one to four, else two."""
    return F.when(length <= 2, 0).when(length <= 4, 1).otherwise(2)


def _shortened(text: Column) -> Column:
    """All texts with one letter less."""
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))


#: Up to so many letters tokens are met by the texts that deletions leave; longer ones by their thirds.
LONGEST = 48


def _with_keys(df: DataFrame, token: str) -> DataFrame:
    """df with a hash for the token and each text that its allowed deletions leave."""
    t = F.col(token)
    none = F.array().cast("array<string>")
    one = F.when(F.length(t) >= 2, _shortened(t)).otherwise(none)
    two = F.when(F.length(t) >= 4, F.flatten(F.transform(one, _shortened))).otherwise(none)
    return df.where(F.length(t) <= LONGEST).withColumn("_key", F.explode(F.transform(F.array_distinct(F.concat(F.array(t), one, two)), lambda x: F.xxhash64(x))))


def _third(text: Column, length: Column, i: Column, shift: Column) -> Column:
    """A hash of the i-th third of a text as one of that length has it, read so many letters later."""
    start, end = F.floor(i * length / 3), F.floor((i + 1) * length / 3)
    return F.xxhash64(length, i, F.substring(text, (start + shift + 1).cast("int"), (end - start).cast("int")))


def _with_thirds(df: DataFrame, token: str, typed: bool) -> DataFrame:
    """df with keys of long tokens: two edits leave one of the thirds of a form whole, at most two letters away from its place."""
    t, i = F.col(token), F.array(*map(F.lit, range(3)))
    near = F.array(*map(F.lit, range(-2, 3)))
    own = lambda length: F.flatten(F.transform(i, lambda k: F.transform(near, lambda d: F.when(F.floor(k * length / 3) + d >= 0, _third(t, length, k, d)))))
    keys = F.flatten(F.transform(near, lambda d: own(F.length(t) + d))) if typed else F.transform(i, lambda k: _third(t, F.length(t), k, F.lit(0)))
    return df.where(F.length(t) >= LONGEST - 1).withColumn("_key", F.explode(F.array_distinct(F.array_compact(keys))))


def _swapped(a: Column, b: Column) -> Column:
    """Whether two texts of one length differ in a swap of neighbours alone."""
    swap = lambda at: F.concat(F.substring(a, F.lit(1), at - 1), F.substring(a, at + 1, F.lit(1)), F.substring(a, at, F.lit(1)), F.substring(a, at + 2, F.length(a)))
    return (F.length(a) == F.length(b)) & (F.length(a) > 1) & F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda at: swap(at) == b)


def _inflected(token: Column) -> Column:
    """A reference token with its plural and singular forms."""
    return F.array_distinct(
        F.filter(
            F.array(
                token, F.concat(token, F.lit("s")), F.concat(token, F.lit("es")),
                F.when(token.rlike("y$"), F.regexp_replace(token, "y$", "ies")), F.when(token.rlike("fe?$"), F.regexp_replace(token, "fe?$", "ves")),
                F.when(token.rlike("...s$"), F.regexp_replace(token, "s$", "")), F.when(token.rlike("..es$"), F.regexp_replace(token, "es$", "")),
                F.when(token.rlike("ies$"), F.regexp_replace(token, "ies$", "y")), F.when(token.rlike("ves$"), F.regexp_replace(token, "ves$", "f")),
            ),
            lambda x: x.isNotNull(),
        )
    )


def _reference(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries (entry, target, weighted tokens, anchor) and the vocabulary (form, refs, inflected) of their tokens."""
    listed = entries.where("target is not null").select("target", F.array_distinct(tokens(F.col("name"))).alias("words"), tokens(F.col("name")).alias("line")).where(F.size("words") > 0)
    listed = listed.withColumn("entry", F.xxhash64("target", "words")).dropDuplicates(["entry"])
    spread = listed.select("entry", F.explode("words").alias("ref"))
    total = listed.agg(F.count("*").alias("total"))
    weight = spread.groupBy("ref").agg(F.count("*").alias("df")).join(F.broadcast(total)).select("ref", F.log(1 + F.col("total") / F.col("df")).alias("idf"))
    weighted = spread.join(weight, "ref").groupBy("entry").agg(F.collect_list(F.struct("idf", "ref")).alias("weighted"))
    listed = listed.join(weighted, "entry").withColumn("anchor", F.array_max("weighted")["ref"])
    # two neighbouring words may have been typed as one
    joined = F.transform(F.sequence(F.lit(1), F.size("line") - 1), lambda i: F.struct(F.concat(F.get("line", i - 1), F.get("line", i)).alias("form"), F.array(F.get("line", i - 1), F.get("line", i)).alias("refs")))
    pairs = listed.where(F.size("line") > 1).select(F.explode(joined).alias("p")).select("p.form", "p.refs", F.lit(0).alias("inflected"))
    single = spread.select("ref").distinct().select(F.explode(_inflected(F.col("ref"))).alias("form"), F.array("ref").alias("refs"), (F.col("form") != F.col("ref")).cast("int").alias("inflected"))
    forms = single.union(pairs).groupBy("form", "refs").agg(F.min("inflected").alias("inflected"))
    return listed.select("entry", "target", "weighted", "anchor"), forms


def _repair(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """token, ref, edits, span: the reference tokens within the allowed edit distance of each distinct token.

    span counts the reference tokens that one typed token stands for. An inflected form needs
    a letter more than the listed one for the same number of edits.
    """
    met = _with_keys(words, "token").join(_with_keys(vocabulary, "form"), "_key").select("token", "form", "refs", "inflected")
    long = _with_thirds(words, "token", True).join(_with_thirds(vocabulary, "form", False), "_key").select("token", "form", "refs", "inflected")
    close = met.union(long).distinct().withColumn("edits", F.levenshtein("token", "form", 2)).where("edits >= 0")
    edits = F.col("edits")
    close = close.withColumn("edits", F.when((edits == 2) & _swapped(F.col("token"), F.col("form")), 1).otherwise(edits)).where(F.col("edits") <= F.when(F.col("edits") == 0, 0).otherwise(_allowed(F.greatest(F.length("token"), F.length("form")) - F.col("inflected"))))
    spread = close.select("token", F.explode("refs").alias("ref"), "edits", F.size("refs").alias("span"))
    return spread.groupBy("token", "ref").agg(F.min(F.struct("edits", "span")).alias("_m")).select("token", "ref", "_m.edits", "_m.span")


def map_values(values: DataFrame, entries: DataFrame, makers_from: int = 3, max_edits: int = 4) -> DataFrame:
    """value, target, score: the entry that each distinct value means, or NONE.

    values: value; entries: target, name, several names for a target being allowed. An entry is
    meant if every token of it is met, with at most two edits each and max_edits in all, and what is left over are
    modifiers or a maker. makers_from: different entries that an unknown word must stand before
    to count as a maker. A null value gives no row; a blank one gives NONE. Ties go to the
    higher score, then to more tokens, then to the smaller target.
    """
    listed, vocabulary = _reference(entries)
    listed, vocabulary = cut(listed, "entries"), cut(vocabulary, "vocabulary")
    named = values.where("value is not null").select("value").distinct().withColumn("tokens", tokens(F.col("value")))
    named = cut(named.withColumn("name", F.array_join("tokens", " ")), "values")
    # values that differ in case, blanks or accents alone are one name
    names = named.where(F.size("tokens") > 0).groupBy("name").agg(F.first("tokens").alias("tokens"))
    placed = names.select("name", F.posexplode("tokens").alias("at", "token"))
    repaired = cut(_repair(placed.select("token").distinct(), vocabulary), "repaired")
    met = placed.join(repaired, "token").select("name", "at", "ref", "edits", "span")
    found = met.groupBy("name").agg(F.collect_list(F.struct("at", "ref", "edits", "span")).alias("met"))
    candidates = met.join(listed, F.col("ref") == F.col("anchor")).select("name", "entry", "target", "weighted").dropDuplicates(["name", "entry"])
    scored = candidates.join(found, "name").join(names, "name")
    cover = F.transform("weighted", lambda w: F.struct(w["idf"].alias("idf"), F.array_min(F.transform(F.filter("met", lambda m: m["ref"] == w["ref"]), lambda m: m["edits"])).alias("edits")))
    scored = scored.withColumn("cover", cover).where(F.forall("cover", lambda c: c["edits"].isNotNull()) & (F.aggregate("cover", F.lit(0), lambda acc, c: acc + c["edits"]) <= max_edits))
    refs = F.transform("weighted", lambda w: w["ref"])
    used = F.array_distinct(F.transform(F.filter("met", lambda m: F.array_contains(refs, m["ref"])), lambda m: m["at"]))
    modifier = F.array(*map(F.lit, MODIFIERS))
    left = F.filter(F.transform("tokens", lambda t, i: F.struct(i.alias("at"), t.alias("token"))), lambda x: ~F.array_contains(F.col("used"), x["at"]) & ~F.array_contains(modifier, x["token"]))
    square = lambda column, f: F.aggregate(column, F.lit(0.0), lambda acc, c: acc + f(c))
    # a token stands for one token of the entry, or for two that were typed as one
    reach = lambda at: F.array_max(F.transform(F.filter("met", lambda m: (m["at"] == at) & F.array_contains(refs, m["ref"])), lambda m: m["span"]))
    room = F.aggregate("used", F.lit(0), lambda acc, at: acc + reach(at))
    scored = scored.withColumn("used", used).where(room >= F.size("weighted")).withColumn("left", left).where(F.size("left") <= 1)
    scored = scored.withColumn("score", square("cover", lambda c: c["idf"] * c["idf"] * (1 - 0.2 * c["edits"])) / square("cover", lambda c: c["idf"] * c["idf"]))
    leading = (F.size("left") == 1) & (F.col("left")[0]["at"] < F.array_min("used"))
    scored = scored.withColumn("maker", F.when(leading, F.col("left")[0]["token"])).where((F.size("left") == 0) | leading)
    scored = cut(scored.select("name", "target", "score", F.size("weighted").alias("n"), "maker"), "scored")
    exact = scored.where("maker is not null").groupBy("maker").agg(F.countDistinct("target").alias("targets")).where(F.col("targets") >= makers_from)
    # a word of the list itself is no maker
    makers = exact.join(vocabulary.select(F.col("form").alias("maker")), "maker", "left_anti").select("maker", F.lit(True).alias("known"))
    meant = scored.join(makers, "maker", "left").where("maker is null or known")
    best = meant.groupBy("name").agg(F.min_by(F.struct("target", "score"), F.struct(-F.col("score"), -F.col("n"), F.col("maker").isNotNull(), "target")).alias("best"))
    return named.select("value", "name").join(best, "name", "left").select("value", F.coalesce("best.target", F.lit(NONE)).alias("target"), F.coalesce("best.score", F.lit(0.0)).alias("score"))


def map_lines(lines: DataFrame, entries: DataFrame, known: DataFrame) -> DataFrame:
    """line_id, ingredient_id, score for the lines whose stored id is null or not in known.id.

    lines: line_id, ingredient_id, name, normalized_name, loaded_at; a line that is delivered
    again counts by its last delivery. A line without any name means NONE.
    """
    stray = lines.select("line_id", "ingredient_id", F.coalesce("name", "normalized_name", F.lit("")).alias("value"), "loaded_at")
    stray = stray.join(known.select(F.col("id").alias("ingredient_id")), "ingredient_id", "left_anti")
    stray = cut(stray.groupBy("line_id").agg(F.max_by("value", F.coalesce("loaded_at", F.lit("1970-01-01").cast("timestamp"))).alias("value")), "stray")
    mapped = map_values(stray, entries)
    return stray.join(mapped, "value").select("line_id", F.col("target").alias("ingredient_id"), "score")
