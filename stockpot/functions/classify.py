"""Scalar functions on times, servings, difficulty, types and units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockpot.functions.text import clean_page, clean_repair, empty_to_null, let, plural_unit, singular_unit, slugify
from stockpot.functions.words import IMAGE_TYPES, MAIN_SLUGS, PAGE_DIFFICULTY, PREPARATIONS, RECIPE_TYPES, REPAIR_DIFFICULTY, REPAIR_TAIL_VERBS, TIME_LABELS, TYPE_WORDS, UNIT_HINTS


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


def total_minutes(*parts: Column) -> Column:
    """The sum of minutes with null as 0; null instead of 0."""
    total = F.lit(0)
    for p in parts:
        total = total + F.coalesce(p, F.lit(0))
    return F.nullif(total, F.lit(0))


def utc_text(seconds: Column) -> Column:
    """Epoch seconds as ISO text in UTC; the session's time zone must be UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_to_seconds(text: Column) -> Column:
    """ISO date and time as epoch seconds; null if it is none.

    Dates with or without hyphens, times with or without colons, any character between them, an
    offset or Z; a time of no zone is that of the session. A year alone is no date; weeks are not read.
    """
    return let(F.regexp_replace(text, "Z", "+00:00"), _iso_to_seconds)


def _iso_to_seconds(text: Column) -> Column:
    pattern = r"^(\d{4})(?:-(\d{2})-|(\d{2}))(\d{2})(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,]\d+)?)?)?(?:([+-]\d{2}):?(\d{2})(?::?\d{2})?)?)?$"
    part = lambda i: F.regexp_extract(text, pattern, i)
    filled = lambda i: F.lpad(part(i), 2, "0")
    zone = F.when(part(8) != "", F.concat(part(8), F.lit(":"), part(9))).otherwise("")
    whole = F.concat(part(1), F.lit("-"), part(2), part(3), F.lit("-"), part(4), F.lit("T"), filled(5), F.lit(":"), filled(6), F.lit(":"), filled(7), zone)
    return F.when(text.rlike(pattern), F.unix_timestamp(F.try_to_timestamp(whole)))


def display_date(seconds: Column) -> Column:
    """Epoch seconds as a date to be read; Unknown without them."""
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "M/d/yyyy"), F.lit("Unknown"))


def shown_minutes(total: Column, cooking: Column, preparation: Column) -> Column:
    """The first of the times that is known, else 0."""
    return F.coalesce(total, cooking, preparation, F.lit(0))


def iso_duration_minutes(text: Column) -> Column:
    """Minutes of a duration such as PT1H30M; days are read over, and any seconds add one minute."""
    pattern = r"^P(?:\d+D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"
    part = lambda i: F.coalesce(empty_to_null(F.regexp_extract(text, pattern, i)).cast("int"), F.lit(0))
    return F.when(text.rlike(pattern), part(1) * 60 + part(2) + F.when(part(3) > 0, 1).otherwise(0))


def labelled_minutes(text: Column) -> Column:
    """preparation, cooking and rest as read from labels in a text; of a repeated label the last counts.

    One number with one unit is read per label.
    """
    every = [label for labels in TIME_LABELS.values() for label in labels]
    head = rf"(?:{'|'.join([*every, 'total'])})"
    every_match = F.regexp_extract_all(F.lower(clean_page(text)), F.lit(rf"({head}(?:\s+time)?\s*:?\s*(?:\d+\s*hours?|\d+\s*minutes?|\d+\s*mins?))"), 1)

    def last(found: Column, labels: tuple[str, ...]) -> Column:
        own = F.filter(found, lambda m: m.rlike(rf"^(?:{'|'.join(labels)})(?:\s|:|\d|time)"))
        m = F.element_at(own, -1)
        number = F.regexp_extract(m, r"(\d+)", 1).cast("int")
        return F.when(F.size(own) > 0, F.when(m.contains("hour"), number * 60).otherwise(number))

    return let(every_match, lambda found: F.struct(*(last(found, labels).alias(name) for name, labels in TIME_LABELS.items())))


def servings(text: Column) -> Column:
    """The first run of digits as a number."""
    return empty_to_null(F.regexp_extract(text.cast("string"), r"(\d+)", 1)).cast("int")


def is_plural(quantity: Column) -> Column:
    """Whether a quantity is more than one; a fraction over 0 is none."""
    q = F.lower(clean_repair(quantity))
    fraction = r"^(?:(\d+)\s+)?(\d+)/(\d+)$"
    part = lambda i: F.coalesce(empty_to_null(F.regexp_extract(q, fraction, i)).cast("double"), F.lit(0.0))
    value = F.when(q.rlike(fraction), part(1) + F.try_divide(part(2), part(3))).otherwise(empty_to_null(F.regexp_extract(q, r"(\d+(?:\.\d+)?)", 1)).cast("double"))
    return F.coalesce(value > 1, F.lit(False)) & ~q.isin("a", "an", "one")


def page_difficulty(text: Column) -> Column:
    return lookup(PAGE_DIFFICULTY, F.lower(clean_page(text)))


def repaired_difficulty(text: Column) -> Column:
    """The known name of a difficulty; one that is on no list stays."""
    return F.coalesce(lookup(REPAIR_DIFFICULTY, F.lower(clean_repair(text))), text)


def infer_difficulty(steps: Column, preparation: Column, cooking: Column, rest: Column) -> Column:
    """By the number of steps, the active minutes and these with a quarter of the rest, rounded up."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    active = zero(preparation) + zero(cooking)
    total = active + F.floor((zero(rest) + 3) / 4)
    over = lambda s, t, a: (steps >= s) | (total >= t) | (active >= a)
    # Steps, minutes in all and active minutes from which each begins.
    return F.when(over(14, 150, 120), "expert").when(over(10, 90, 75), "hard").when(over(6, 40, 30), "medium").otherwise("easy")


def recipe_type(text: Column) -> Column:
    return lookup(RECIPE_TYPES, slugify(text))


def infer_recipe_type(values: Column) -> Column:
    """The type that the texts of an array tell, by parts of words; the last rule needs a whole value."""
    return let(F.filter(F.transform(values, slugify), lambda s: s != ""), _type_of_slugs)


def _type_of_slugs(slugs: Column) -> Column:
    joined = F.array_join(slugs, " ")
    rule = F.lit(None).cast("string")
    rule = F.when(F.exists(slugs, lambda s: s.isin(*MAIN_SLUGS)), "main").otherwise(rule)
    for name, words in reversed(TYPE_WORDS):
        rule = F.when(joined.rlike("|".join(words)), name).otherwise(rule)
    return rule


def image_extension(url: Column, content_type: Column) -> Column:
    """The ending of an image file by its URL, else by its type, else .jpg."""
    own = F.lower(F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), r"[^/.](\.[^./]+)$", 1))
    return F.coalesce(empty_to_null(own), lookup(IMAGE_TYPES, F.trim(F.split(content_type, ";")[0])), F.lit(".jpg"))


def inferred_unit(quantity: Column, normalized_name: Column, name: Column) -> Column:
    """The unit that a name tells where a quantity has none; null without a quantity."""
    where = F.lower(F.concat_ws(" ", empty_to_null(clean_repair(normalized_name)), empty_to_null(clean_repair(name))))
    return let(where, lambda w: _unit_of(quantity, w))


def _unit_of(quantity: Column, where: Column) -> Column:
    unit = F.lit("piece")
    for needle, hint in reversed(UNIT_HINTS):
        unit = F.when(where.contains(needle), hint).otherwise(unit)
    return F.when(clean_repair(quantity) != "", let(unit, lambda u: F.when(is_plural(quantity), plural_unit(u)).otherwise(singular_unit(u))))


def inferred_preparation(name: Column) -> Column:
    """The preparations that a name tells in brackets, after a separator and at its end, each once."""
    return let(clean_repair(name), _preparation_of)


def _preparation_of(text: Column) -> Column:
    tells = lambda p: F.lower(p).rlike(rf"(?:^|[^a-z])(?:{'|'.join(PREPARATIONS)})(?:[^a-z]|$)")
    inner = F.filter(F.regexp_extract_all(text, F.lit(r"\(([^()]*)\)"), 1), tells)
    base = F.regexp_replace(text, r"\([^()]*\)", "")
    separator = F.when(base.contains(","), ",").when(base.contains(" - "), " - ").when(base.contains(" – "), " – ")
    rest = F.when(separator.isNotNull(), F.substr(base, F.instr(base, separator) + F.length(separator)))
    tail = F.regexp_extract(base, rf"(?i)(\b(?:{'|'.join(REPAIR_TAIL_VERBS)})\b.*)$", 1)
    parts = F.concat(inner, F.array(F.when(tells(rest), rest), empty_to_null(tail)))
    parts = F.array_distinct(F.transform(F.array_compact(parts), lambda p: F.lower(clean_repair(p))))
    return empty_to_null(F.array_join(parts, ", "))
