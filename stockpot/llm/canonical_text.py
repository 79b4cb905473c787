"""Problem 10: visually identical text with different characters, in one consistent form.

Method. Normalisation quick-check: almost all of a text is stable, that is, made of
starters that no step changes and no accent follows. Only the segments around unstable
characters, with the word or the starter they touch as boundary context, are decomposed, mapped
and composed again; they are spliced into the unchanged text. Look-alike letters become
Latin, but in a word with a letter that only another script has they become that script's.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

# Letters of other scripts and the Latin letter they look like.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "ѵ": "v",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ρ": "p", "ι": "i", "υ": "u", "ϲ": "c", "ϳ": "j",
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "ǃ": "!", "ı": "i", "ɑ": "a", "ɡ": "g",
}
# A capital letter that looks like a digit only is no look-alike: digits stay visible.
LOOKALIKES.pop("З")
# Characters that show nothing.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
# Blanks of any width, hyphens that look like the plain one, and line ends.
BLANKS = "\t               　"
HYPHENS = "‐‑"
LINE_ENDS = re.compile("\r\n|[\r\x85  ]")
#: Compatibility forms that look like the plain one: wide, narrow, unbreakable, and the Latin ligatures.
_TAGS = ("<wide>", "<narrow>", "<noBreak>")
_LIGATURES = {chr(c) for c in range(0xFB00, 0xFB07)}


@lru_cache(1)
def _tables() -> tuple[dict[int, str | None], re.Pattern, re.Pattern]:
    """The map of single characters after decomposition, and the patterns of unstable runs: of texts within the first plane, and of any."""
    change: dict[int, str | None] = {ord(k): v for k, v in LOOKALIKES.items()}
    change |= dict.fromkeys(map(ord, INVISIBLE)) | dict.fromkeys(map(ord, BLANKS), " ") | dict.fromkeys(map(ord, HYPHENS), "-")
    # conjoining vowels and final consonants of Hangul compose with what is before them
    unstable = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3), 9, *change}
    for code in (*range(0xA0, 0xD800), *range(0xE000, 0x32000), *range(0xE0100, 0xE01F0)):
        char = chr(code)
        form = unicodedata.decomposition(char)
        if form and code not in change and (char in _LIGATURES or form.startswith(_TAGS)):
            change[code] = unicodedata.normalize("NFKC", char)
            unstable.add(code)
        elif unicodedata.combining(char) or not unicodedata.is_normalized("NFC", char):
            unstable.add(code)
        elif form and form[0] != "<" and ord(unicodedata.normalize("NFD", char)[0]) in change:
            # a composed letter is unstable if its base is a look-alike
            unstable.add(code)
    # a word of a script with look-alikes is one segment, which a memo then knows
    codes = sorted(unstable | {c for c in range(0x370, 0x530) if chr(c).isalpha()})
    # ranges beyond the first plane make a pattern slow; few texts need them
    return change, re.compile(f"[{_ranges([c for c in codes if c < 0x10000])}]+"), re.compile(f"[{_ranges(codes)}]+")


def _ranges(codes: list[int]) -> str:
    out, k = [], 0
    while k < len(codes):
        end = k
        while end + 1 < len(codes) and codes[end + 1] == codes[end] + 1:
            end += 1
        out.append(f"\\U{codes[k]:08x}" + (f"-\\U{codes[end]:08x}" if end > k else ""))
        k = end + 1
    return "".join(out)


#: A letter of a script with look-alikes, and a word that holds one.
_OTHER = re.compile("[\u0370-\u03ff\u0400-\u052f]")
_WORD = re.compile("(?:[^\\W\\d_][\u0300-\u036f]*)+")
#: Latin letters as the basic letters of the other scripts that look like them.
_BACK = {
    "greek": {ord(to): char for char, to in LOOKALIKES.items() if "\u0391" <= char <= "\u03c9"},
    "cyrillic": {ord(to): char for char, to in LOOKALIKES.items() if "\u0410" <= char <= "\u044f" or char in "ІЈЅіјѕ"},
}


def _by_script(word: re.Match) -> str:
    """A word in the script of its first letter that is not Latin, where it has one; it depends on what is seen alone."""
    other = _OTHER.search(word[0])
    return word[0].translate(_BACK["greek" if other[0] < "\u0400" else "cyrillic"]) if other else word[0]


@lru_cache(50_000)
def _segment(text: str) -> str:
    change = _tables()[0]
    mapped = unicodedata.normalize("NFD", text).translate(change)
    mapped = unicodedata.normalize("NFD", mapped).translate(change)
    return unicodedata.normalize("NFC", _WORD.sub(_by_script, mapped) if _OTHER.search(mapped) else mapped)


_UNSEEN = frozenset(INVISIBLE)


def _in_word(char: str) -> bool:
    return char.isalnum() and not char.isdecimal() or "\u0300" <= char <= "\u036f" or char in _UNSEEN


def canonical(text: str) -> str:
    """The consistent form of a text; accents, digits, case and line breaks stay as they are."""
    if text.isascii() and "\t" not in text and "\r" not in text:
        return text
    text = LINE_ENDS.sub("\n", text)
    _, first_plane, any_plane = _tables()
    parts, done = [], 0
    # two UTF-16 units stand for a character beyond the first plane
    beyond = len(text.encode("utf-16-le", "surrogatepass")) > 2 * len(text)
    for run in (any_plane if beyond else first_plane).finditer(text):
        if run.end() <= done:
            continue
        # the character before a run may compose with it, and a word is one segment
        at, end = max(done, run.start()), run.end()
        start = max(done, at - 1)
        if _in_word(text[at]):
            while at > done and _in_word(text[at - 1]):
                at -= 1
            start = min(start, at)
        if _in_word(text[end - 1]):
            while end < len(text) and _in_word(text[end]):
                end += 1
        segment = text[start:end]
        parts += text[done:start], _segment(segment) if len(segment) <= 32 else _segment.__wrapped__(segment)
        done = end
    return "".join([*parts, text[done:]])


def _canonical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        done = pa.array([None if t is None else canonical(t) for t in texts.to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pc.cast(done, pa.string())], batch.schema.names)


def canonical_texts(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and the text in its consistent form; null stays null, an empty text empty.

    Texts of plain ASCII are found by the JVM and never leave it.
    """
    kept = df.select(*keys, F.col(text).alias("text"))
    odd = r"[^\x20-\x7e\n]"
    schema = kept.schema
    plain = kept.where(F.col("text").isNull() | ~F.col("text").rlike(odd))
    return plain.unionByName(kept.where(F.col("text").rlike(odd)).mapInArrow(_canonical, schema))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        stored, form = [], []
        for text in texts:
            stored.append(digest(text))
            form.append(stored[-1] if (own := canonical(text)) == text else digest(own))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(stored, pa.binary()), pa.array(form, pa.binary())], [*batch.schema.names[:-1], "stored", "form"])


def forms(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, stored, form: digests of each text as stored and in its consistent form, made in one pass and written once.

    Rows with a null key or text are dropped; rows that repeat a key and text count once.
    """
    kept = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    return cut(kept.mapInArrow(_digest, f"id {dict(kept.dtypes)['id']}, stored binary, form binary"), "forms")


def lookalike_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_a < doc_b: documents whose consistent forms are equal though their stored texts differ.

    Only digests of 32 bytes are shuffled. Rows with a null text or key have no pairs; rows that
    repeat a key and text count once; copies that are equal as stored are no pairs. n documents
    of one form give up to n (n - 1) / 2 rows; lookalike_classes says the same in n.
    """
    known = forms(df, key, text)
    # a form met with one stored text only has no pairs; those with several are few
    several = known.groupBy("form").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi")).where("lo <> hi").select("form")
    members = known.join(several, "form", "left_semi").distinct()
    a = members.select("form", F.col("id").alias("doc_a"), F.col("stored").alias("stored_a"))
    b = members.select("form", F.col("id").alias("doc_b"), F.col("stored").alias("stored_b"))
    return a.join(b, "form").where("doc_a < doc_b and stored_a <> stored_b").select("doc_a", "doc_b").distinct()


def lookalike_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_key, spellings: the class of equal forms of each document, known by its smallest key, and how many stored texts it has."""
    known = forms(df, key, text).distinct()
    # spellings are counted before documents meet, so a form that very many share is no hot key
    counts = known.groupBy("form", "stored").agg(F.min("id").alias("id")).groupBy("form").agg(F.min("id").alias("class_key"), F.count("*").alias("spellings"))
    return known.join(counts, "form").select(F.col("id").alias("key"), "class_key", "spellings")
