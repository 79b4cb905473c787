"""Problem 3: amounts stated in many units and places, converted to common units.

Method. Every spelling of a unit is a source, a line the entity. Lines that state one amount
twice ("3 cups (720 ml)") link two sources; the lines of a pair of sources give a robust scale
and offset between them. Known notations of a unit ("Tbsp." of tbsp) are links of scale 1.
Scales are propagated from the canonical spellings of the factor table through the graph of all
these links and snapped to the known conversions; links with an offset tell of no such
conversion and lead nowhere. A spelling that the graph reaches is a unit: spellings that no
list holds but that measured links reach are then read in all texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

# Known spellings of each canonical unit, after lower-casing and without dots.
SPELLINGS = {
    "g": ["g", "gm", "gms", "gr", "grs", "grm", "grms", "gram", "grams", "gramme", "grammes", "gramo", "gramos", "г", "гр"],
    "kg": ["kg", "kgs", "kilo", "kilos", "kilogram", "kilograms", "kilogramme", "kilogrammes", "кг"],
    "mg": ["mg", "mgs", "milligram", "milligrams", "milligramme", "milligrammes"],
    "oz": ["oz", "ozs", "ounce", "ounces"],
    "lb": ["lb", "lbs", "pound", "pounds"],
    "ml": ["ml", "mls", "cc", "ccs", "milliliter", "milliliters", "millilitre", "millilitres", "мл"],
    "cl": ["cl", "cls", "centiliter", "centiliters", "centilitre", "centilitres"],
    "dl": ["dl", "dls", "deciliter", "deciliters", "decilitre", "decilitres"],
    "l": ["l", "lt", "ltr", "ltrs", "lts", "liter", "liters", "litre", "litres", "л"],
    "tsp": ["tsp", "tsps", "ts", "teaspoon", "teaspoons", "teaspoonful", "teaspoonfuls", "teaspoonsful"],
    "tbsp": ["tbsp", "tbsps", "tbs", "tbl", "tbls", "tblsp", "tblsps", "tablespoon", "tablespoons", "tablespoonful", "tablespoonfuls", "tablespoonsful"],
    "fl oz": ["fl oz", "fl ozs", "floz", "fluid ounce", "fluid ounces", "fl ounce", "fl ounces", "fluid oz"],
    "cup": ["cup", "cups", "c", "cupful", "cupfuls", "cupsful"],
    "pint": ["pint", "pints", "pt", "pts"],
    "quart": ["quart", "quarts", "qt", "qts"],
    "gallon": ["gallon", "gallons", "gal", "gals"],
}
# Spellings in which the case of the letter counts.
CASED = {"T": "tbsp", "t": "tsp", "T.": "tbsp", "t.": "tsp"}
# Words for packages.
PACKAGES = (
    "can", "cans", "tin", "tins", "jar", "jars", "box", "boxes", "pack", "packs", "packet", "packets", "package", "packages", "pkg", "pkgs",
    "pouch", "pouches", "sachet", "sachets", "bottle", "bottles", "bag", "bags", "carton", "cartons", "tub", "tubs", "container", "containers", "envelope", "envelopes",
    "stick", "sticks", "block", "blocks", "tube", "tubes",
)
# Numbers and parts written as words.
NUMBER_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12}
PART_WORDS = {"half": 2, "halves": 2, "third": 3, "thirds": 3, "quarter": 4, "quarters": 4, "fourth": 4, "fourths": 4, "eighth": 8, "eighths": 8}
# Fraction characters.
FRACTIONS = {"½": "1/2", "⅓": "1/3", "⅔": "2/3", "¼": "1/4", "¾": "3/4", "⅕": "1/5", "⅖": "2/5", "⅗": "3/5", "⅘": "4/5", "⅙": "1/6", "⅚": "5/6", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8"}

_NUMBER = r"(?:\d+\s*/\s*\d+|\d+\s+\d+/\d+|\d*[.,]\d+|\d+)"
_MIXED = rf"(?:\d+\s*-\s*\d+/\d+|\d+\s+\d+/\d+|{_NUMBER})"
_RANGE = rf"(?P<lo>{_MIXED})(?:\s*(?:-|to)\s*(?P<hi>{_MIXED}))?"
_UNIT = r"(?P<unit>fl(?:uid)?\.?\s*(?:oz|ounce)s?\.?|[^\W\d_]+\.?)"
_AMOUNT = re.compile(rf"(?<![\w/.,]){_RANGE}\s*-?\s*{_UNIT}(?![\w%])", re.I)
_COUNT = re.compile(rf"(?<![\w/.,]){_RANGE}(?![\w/%]|[.,]\d)", re.I)
_PACK = re.compile(rf"\b(?:{'|'.join(PACKAGES)})\b", re.I)
_ANY_NUMBER = "|".join(NUMBER_WORDS)
_ANY_PART = "|".join(PART_WORDS)
#: "one and a half", "three quarters", "half a", "six", and a leading "a", in this order.
_WORD_AMOUNT = re.compile(
    rf"\b(?P<whole>{_ANY_NUMBER}|\d+) and (?:an?|one) (?P<rest>{_ANY_PART})\b|(?:\b(?P<times>an?|{_ANY_NUMBER})[ -])?\b(?P<part>{_ANY_PART})\b(?: of)?(?: an?\b(?! *(?:little|few|bit)\b))?|\b(?P<number>{_ANY_NUMBER})\b|(?:^|(?<=\d to )|(?<=\d - )|(?<=\d-))(?P<a>an?)(?: (?!little|few|bit|pinch|dash)|$)",
    re.I,
)
_NEXT = re.compile(r"[\s-]*?(-|[^\W\d_]+\.?)")
_SIZE = re.compile(r"\s*(?:x\s*)?[(\d]")
_AND_PART = re.compile(r"(?<=\d) and (?=\d+/\d)")
_GLYPH = re.compile("[" + "".join(FRACTIONS) + "]")
_DIGIT = re.compile(r"\d|[" + "".join(FRACTIONS) + "]")


def _plain(text: str) -> str:
    """One form of fractions, dashes and blanks, so that one pattern reads numbers."""
    text = _GLYPH.sub(lambda m: " " + FRACTIONS[m[0]], text.replace("⁄", "/"))
    text = re.sub("[‐‑‒–—−]", "-", text)
    text = re.sub(r"(?<=\d)\s*-\s+(?=\d/\d)", "-", re.sub(r"\s+", " ", text))
    return re.sub(r"(?<=\d)- (?=\d)", "-", text).strip()


def _value(text: str) -> float | None:
    """``1 1/2``, ``1-1/2``, ``3/4``, ``.75``, ``0,25`` or ``1,000`` as a number; null if the denominator is 0."""
    text = text.strip()
    if m := re.fullmatch(r"(?:(\d+)\s*[- ]\s*)?(\d+)\s*/\s*(\d+)", text):
        return None if int(m[3]) == 0 else int(m[1] or 0) + int(m[2]) / int(m[3])
    if re.fullmatch(r"[1-9]\d{0,2},\d{3}", text):
        return float(text.replace(",", ""))
    return float(text.replace(",", "."))


def _ends(m: re.Match) -> tuple[float, float] | None:
    lo = _value(m["lo"])
    hi = _value(m["hi"]) if m["hi"] else lo
    if lo is None or hi is None:
        return None
    if m["hi"] and hi < lo:
        # "1 - 1/2" is a mixed number, no range that falls
        return (lo + hi, lo + hi) if hi < 1 and lo == int(lo) else (hi, lo)
    return lo, hi


def _read(text: str, known: frozenset[str]) -> tuple[float, float, str] | None:
    """The first amount in a text, times the number of packages that hold it."""
    found = None
    for m in _AMOUNT.finditer(text):
        unit = re.sub(r"\s+", " ", m["unit"])
        if fold(unit) in known or unit in CASED:
            found = m, unit
            break
    if not found or not (ends := _ends(found[0])):
        return None
    m, unit = found
    lo, hi = ends
    rest = text[: m.start()] + " " + text[m.end() :]
    if _PACK.search(rest):
        before = re.search(rf"({_MIXED})\s*(?:x|×|\*)?\s*(?:[a-z]+\s+of\s+|{_PACK.pattern}\s*(?:of\s*)?)?[\s(]*$", text[: m.start()], re.I)
        times = _value(before[1]) if before else None
        if times:
            lo, hi = lo * times, hi * times
    return lo, hi, source_of(unit)


def fold(spelling: str) -> str:
    """A spelling without case, dots and doubled blanks."""
    return re.sub(r"\s+", " ", spelling.replace(".", " ").lower()).strip()


def source_of(unit: str) -> str:
    """The spelling that a unit as typed is: folded, but for those in which case counts."""
    return unit if unit in CASED else fold(unit)


def _read_field(quantity: str | None, unit: str | None, known: frozenset[str]) -> tuple:
    """The amount that quantity and unit state, the packages they count, and an amount in a spelling that is not known."""
    field = _words_to_number(_plain(f"{quantity or ''} {unit or ''}"), known)
    if not _DIGIT.search(field):
        return None, None, None
    if first := _read(field, known):
        return first, None, None
    if _PACK.search(field):
        return None, ((m := _COUNT.search(field)) and _ends(m)), None
    m = _AMOUNT.fullmatch(field)
    return None, None, m and (n := _ends(m)) and (*n, source_of(re.sub(r"\s+", " ", m["unit"])))


def _read_text(text: str, known: frozenset[str]) -> tuple:
    """The amount within a text, and whether the text itself tells of packages."""
    text = _words_to_number(_plain(text), known, of_name=True)
    return (_read(text, known), bool(_PACK.search(text))) if _DIGIT.search(text) else (None, False)


def _words_to_number(text: str, known: frozenset[str], of_name: bool = False) -> str:
    """A text with its number words as digits, parts as fractions.

    In a name only those count that a unit or package follows, or a range for whole
    numbers: "half and half - 250 ml" has no half in its amount.
    """

    def digits(m: re.Match) -> str:
        if of_name:
            after, counts = _NEXT.match(text, m.end()), m["number"] and m.start() == 0 and _SIZE.match(text, m.end())
            if not counts and (not after or not (fold(after[1]) in known or after[1] in CASED or _PACK.fullmatch(after[1]) or not m["part"] and after[1] in ("to", "-"))):
                return m[0]
        if m["whole"]:
            return f"{NUMBER_WORDS.get(m['whole'].lower(), m['whole'])} 1/{PART_WORDS[m['rest'].lower()]}"
        if m["part"]:
            return f"{NUMBER_WORDS.get((m['times'] or 'a').lower(), 1)}/{PART_WORDS[m['part'].lower()]}"
        return f"{NUMBER_WORDS[m['number'].lower()]}" if m["number"] else "1 "

    return _plain(_AND_PART.sub(" ", _WORD_AMOUNT.sub(digits, text)))


def _combine(field: tuple, text: tuple) -> list[tuple[float, float, str]]:
    (first, count, other), (second, packed) = field, text
    if first is None and second is not None:
        if count and not packed:
            # "2 cans" of a thing whose name gives the size of one
            second = second[0] * count[0], second[1] * count[1], second[2]
        elif other:
            # a spelling on no list: the pair with the amount in the text may tell its scale
            first = other
    return [x for x in (first, second) if x is not None]


KNOWN = frozenset(s for known in SPELLINGS.values() for s in known)
LEXICON = {s: unit for unit, known in SPELLINGS.items() for s in known}


def parse_line(quantity: str | None, unit: str | None, name: str | None, preparation: str | None = None, known: frozenset[str] = KNOWN) -> list[tuple[float, float, str]]:
    """The amounts that a line states, at most two: by quantity and unit, and within its text.

    A field that is null counts as empty. A line that states none gives an empty list.
    """
    field, text = _read_field(quantity, unit, known), _read_text(name or "", known)
    if field[0] is None and text[0] is None and preparation:
        text = _read_text(preparation, known)
    return _combine(field, text)


STATEMENT = "line_id long, at timestamp, turn int, lo double, hi double, spelling string, lo2 double, hi2 double, spelling2 string"


def _statements(known: frozenset[str], turn: int):
    def statements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the memos save time only: an answer never depends on them
        field_of, text_of = lru_cache(20_000)(lambda q, u: _read_field(q, u, known)), lru_cache(20_000)(lambda t: _read_text(t, known))
        nothing, none = (None, False), (None,) * 3
        names = ["lo", "hi", "spelling", "lo2", "hi2", "spelling2"]
        types = [pa.float64(), pa.float64(), pa.string()] * 2
        for batch in batches:
            rows = []
            for quantity, unit, name, preparation in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                field, text = field_of(quantity, unit), text_of(name) if name else nothing
                if field[0] is None and text[0] is None and preparation:
                    text = text_of(preparation)
                found = _combine(field, text)
                rows.append((*(found[0] if found else none), *(found[1] if len(found) > 1 else none)))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(rows), turn, np.int32)), *(pa.array(v, t) for v, t in zip(columns, types, strict=True))], ["line_id", "at", "turn", *names])

    return statements


#: What a text must hold for the parser to find a number in it; wider than the parser, never narrower.
NUMBERED = rf"(?iu)[\p{{Nd}}{''.join(FRACTIONS)}]|(?<![a-z])(?:{_ANY_NUMBER}|{_ANY_PART})(?![a-z])|^[\s\p{{Z}}\x1c-\x1f\x85]*an?(?![a-z])"


def statements(lines: DataFrame, order: str | None = "loaded_at", learned: frozenset[str] = frozenset()) -> DataFrame:
    """One row per line (STATEMENT): the ends and spelling of the amount it states, and those of a second statement.

    The spelling of a line that states none is null. at: when the row was delivered, null
    without the column order. Texts without a number never leave the scan. learned: spellings
    known besides the list; then only lines that hold one are read, as their turn 1.
    """
    at = F.col(order).cast("timestamp") if order and order in lines.columns else F.lit(None).cast("timestamp")
    columns = ("quantity", "unit", "name", "preparation")
    if learned:
        holds = "(?iu)(?<![a-z])(?:" + "|".join(re.escape(x).replace(r"\ ", r"[\s\p{Z}.]+") for x in sorted(learned)) + ")"
        lines = lines.where(F.concat_ws("\n", *columns).rlike(holds))
    numbered = [F.coalesce(F.col(c).rlike(NUMBERED), F.lit(False)) for c in columns]
    texts = [F.when(n, F.col(c)).alias(c) for n, c in zip(numbered[2:], columns[2:], strict=True)]
    rows = lines.select(F.col("line_id").cast("long").alias("line_id"), at.alias("at"), "quantity", "unit", *texts, (numbered[0] | numbered[1] | numbered[2] | numbered[3]).alias("_n"))
    parsed = rows.where("_n").drop("_n").mapInArrow(_statements(KNOWN | learned, int(bool(learned))), STATEMENT)
    if learned:
        return parsed
    blank = [F.lit(None).cast(t).alias(n) for n, t in (f.strip().split() for f in STATEMENT.split(",")[3:])]
    return parsed.unionByName(rows.where("not _n").select("line_id", "at", F.lit(0).alias("turn"), *blank))


def measured_links(stated: DataFrame, least: int = 3, near: float = 0.04) -> DataFrame:
    """spelling, spelling2, scale, offset, pairs: an amount a by the one spelling is scale * a + offset by the other.

    Robust estimates over the lines that state one amount in both: the scale is the slope between
    outer quantiles, the median ratio where it agrees with the slope, as then the offset is null.
    least: pairs that a link needs. near: the relative distance up to which two scales are one.
    Spellings whose ratios scatter more than that, without a line that explains them, are not linked.
    """
    both = stated.where("turn = 0 and spelling2 is not null and lo > 0 and lo2 > 0 and lo = hi and lo2 = hi2")
    at = "array(0.1, 0.5, 0.9), 1000)"
    links = both.groupBy("spelling", "spelling2").agg(F.expr(f"percentile_approx(lo, {at}").alias("x"), F.expr(f"percentile_approx(lo2, {at}").alias("y"), F.expr(f"percentile_approx(lo2 / lo, {at}").alias("r"), F.count("*").alias("pairs"))
    links = links.where(F.col("pairs") >= least)
    slope = F.try_divide(F.col("y")[2] - F.col("y")[0], F.col("x")[2] - F.col("x")[0])
    links = links.withColumn("slope", F.coalesce(slope, F.col("r")[1])).withColumn("even", F.col("r")[2] <= F.col("r")[0] * (1 + 2 * near))
    links = links.withColumn("offset", F.when(F.col("even"), 0.0).otherwise(F.col("y")[1] - F.col("slope") * F.col("x")[1])).withColumn("scale", F.when(F.col("even"), F.col("r")[1]).otherwise(F.col("slope")))
    # three quantiles on one line tell that a scale and an offset explain the pairs
    fits = F.abs(F.col("y")[0] - F.col("scale") * F.col("x")[0] - F.col("offset")) <= near * F.col("y")[0]
    return links.where(F.col("even") | ((F.col("scale") > 0) & fits)).select("spelling", "spelling2", "scale", "offset", "pairs")


def calibrate(stated: DataFrame, factors: DataFrame, least: int = 3, near: float = 0.04) -> DataFrame:
    """spelling, base_unit, factor, steps, pairs: the scale of each spelling that the graph reaches.

    steps: links from the nearest canonical spelling; pairs: lines behind the last link, 0 for a
    known notation. Links go both ways. A spelling is reached in the fewest steps, by measured
    links first and of these by the one with the most pairs, and its scale is snapped to a
    factor within near before it is passed on; what snaps to none is no unit. The tables here
    are of the size of the set of spellings, never of the lines.
    """
    spark = stated.sparkSession
    known = cut(factors.where("unit is not null and factor > 0").select("unit", "base_unit", F.col("factor").cast("double").alias("factor")).dropDuplicates(["unit"]), "factors")
    measured = cut(measured_links(stated, least, near), "links")
    spellings = cut(stated.select("spelling").union(stated.select("spelling2")).where("spelling is not null").distinct(), "spellings")
    lexicon = spark.createDataFrame(list(LEXICON.items()) + list(CASED.items()), "spelling string, unit string")
    notations = spellings.join(F.broadcast(lexicon), "spelling").select("spelling", F.col("unit").alias("spelling2"), F.lit(1.0).alias("scale"), F.lit(0).cast("long").alias("pairs"))
    straight = measured.where("offset = 0").select("spelling", "spelling2", "scale", "pairs")
    links = straight.unionByName(notations.where("spelling <> spelling2"))
    links = cut(links.unionByName(links.select(F.col("spelling2").alias("spelling"), F.col("spelling").alias("spelling2"), (1 / F.col("scale")).alias("scale"), "pairs")), "graph")
    reached = known.select(F.col("unit").alias("spelling"), "base_unit", "factor", F.lit(0).alias("steps"), F.lit(0).cast("long").alias("pairs"))
    targets = F.broadcast(known.select("base_unit", F.col("factor").alias("known_factor")).distinct())
    far = F.abs(F.log(F.col("factor") / F.col("known_factor")))
    step = 0
    while True:
        step += 1
        front = reached.where(F.col("steps") == step - 1).select(F.col("spelling").alias("spelling2"), "base_unit", "factor")
        new = links.join(front, "spelling2").join(reached.select("spelling"), "spelling", "left_anti").select("spelling", "base_unit", (F.col("scale") * F.col("factor")).alias("factor"), "pairs")
        new = new.join(targets, "base_unit").where(far <= math.log1p(near))
        new = new.groupBy("spelling").agg(F.max_by(F.struct("base_unit", F.col("known_factor").alias("factor"), "pairs"), F.struct("pairs", -far, "base_unit", "known_factor")).alias("s"))
        new = cut(new.select("spelling", "s.base_unit", "s.factor", F.lit(step).alias("steps"), "s.pairs"), "reached")
        # ends, as each turn reaches spellings that no turn before it has
        if not new.take(1):
            break
        reached = cut(reached.unionByName(new), "scales")
    return spellings.join(reached, "spelling")


def _learned(scales: DataFrame) -> frozenset[str]:
    """Spellings that are units by measured links alone; as few as there are units that people invent and convert beside."""
    return frozenset(r.spelling for r in scales.where("pairs > 0").select("spelling").toLocalIterator()) - KNOWN - CASED.keys()


def convert_quantities(lines: DataFrame, factors: DataFrame, order: str | None = "loaded_at") -> DataFrame:
    """line_id, base_unit, low_milli, high_milli, spelling for each line that states a mass or volume.

    lines: line_id, quantity, unit, name, preparation; other columns are ignored. Of a line
    delivered several times the last by order counts, of two at once the greater by value.
    Nulls and empty texts state nothing. The amount that quantity and unit state goes before
    one within the text. Empty tables give no rows.
    """
    stated = cut(statements(lines, order), "stated")
    scales = cut(calibrate(stated, factors), "scales")
    if learned := _learned(scales):
        # texts may hold the units that the links have told; lines without one stay as they are
        stated = stated.unionByName(cut(statements(lines, order, learned), "stated"))
        scales = cut(calibrate(stated, factors), "scales")
    last = F.max(F.struct("at", "turn", "lo", "hi", "spelling", "lo2", "hi2", "spelling2")).alias("_s")
    rows = stated.groupBy("line_id").agg(last).select("line_id", "_s.*").where("spelling is not null")
    scale = scales.select("spelling", "base_unit", "factor")
    # spellings are typed by people, so their table is broadcast by a check of its size alone
    scale = F.broadcast(scale) if scale.count() <= 100_000 else scale
    second = scale.select(F.col("spelling").alias("spelling2"), F.col("base_unit").alias("base2"), F.col("factor").alias("factor2"))
    milli = lambda end, factor: F.floor(F.col(end) * F.col(factor) * 1000 + 0.5 + 1e-6).cast("long")
    rows = rows.join(scale, "spelling", "left").join(second, "spelling2", "left")
    own = F.col("base_unit").isNotNull()
    return rows.where("base_unit is not null or base2 is not null").select(
        "line_id",
        F.coalesce("base_unit", "base2").alias("base_unit"),
        F.when(own, milli("lo", "factor")).otherwise(milli("lo2", "factor2")).alias("low_milli"),
        F.when(own, milli("hi", "factor")).otherwise(milli("hi2", "factor2")).alias("high_milli"),
        F.when(own, F.col("spelling")).otherwise(F.col("spelling2")).alias("spelling"),
    )
