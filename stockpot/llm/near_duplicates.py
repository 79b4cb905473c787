"""Problem 5: near-duplicate records with small edits.

Method. DartMinHash signatures of the records' sets, joined by bands of coordinates, then
an exact check of each candidate. Records with equal sets form one class; only classes take
part in the join, and pairs of classes are spread over their members at the end.

Texts are read once for signatures; the sets themselves, larger than the texts, are neither
kept nor shuffled. They are made again for one record of each class that has a candidate.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.llm.dartminhash import bands, mix, signatures
from stockpot.session import cut

_WORD = re.compile(r"[^\W_]+")
#: Characters of texts, and members of sets, that are worked on in one go.
CHARACTERS, MEMBERS = 500_000, 100_000
#: Words, and classes, that a task remembers; what it forgets is computed again.
REMEMBERED = 200_000
#: White space of any kind.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f")
#: Sets up to this size have a map of their members in their sketch; sets above the other have none at all.
MAPPED, SIZED = 48, 255

SETS = "id long, class long, members array<long>"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)


def word_and_item_sets(df: DataFrame, key: str, name: str, items: str) -> DataFrame:
    """id, class, members: hashes of the words of a name together with the elements of an array.

    Elements are trimmed and lower-cased, null and blank ones dropped. Rows with a null key or an empty set are dropped.
    """
    elements = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.lower(F.btrim(x, F.lit(SPACES))))
    every = F.array_distinct(F.concat(F.coalesce(words(F.col(name)), F.array().cast("array<string>")), F.filter(elements, lambda x: x.isNotNull() & (x != ""))))
    sets = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.array_sort(F.transform(every, lambda x: F.xxhash64(x))).alias("members"))
    return sets.where(F.size("members") > 0).select("id", F.xxhash64("members").alias("class"), "members")


class _Hashes(dict):
    """Words with their hashes, which are made when they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code


def _sets_of_texts(batches: Iterator[pa.RecordBatch], size: int, form: Callable[[str], str] | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, classes, lengths, members) of some texts at a time: id and text are the first columns; texts without a shingle are dropped."""
    hashes = _Hashes()

    def sets(ids: list[int], counts: list[int], found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        codes = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
        if len(hashes) > REMEMBERED:
            hashes.clear()
        run = codes[: len(codes) - size + 1].copy()
        for j in range(1, size):
            run = mix(run + np.uint64(j)) ^ codes[j : len(codes) - size + 1 + j]
        run = mix(run)
        many = np.array(counts)
        ends = np.cumsum(many)
        for start, end in zip((ends - many).tolist(), ends.tolist(), strict=True):
            run[start : end - size + 1].sort()
        # the runs that lie across two texts are no shingles, nor is what repeats the one before it
        own = np.repeat(np.arange(len(many)), many)[: len(run)]
        place = np.arange(len(run)) - (ends - many)[own]
        real = (place <= many[own] - size) & np.concatenate(([True], (run[1:] != run[:-1]) | (place[1:] == 0)))
        members, owner = run[real], own[real]
        lengths = np.bincount(owner, minlength=len(many))
        starts = np.cumsum(lengths) - lengths
        # the class is a hash of the sorted set
        each = mix(members + mix((np.arange(len(members)) - starts[owner]).astype(np.uint64) + np.uint64(7)))
        return np.array(ids), mix(np.add.reduceat(each, starts) + lengths.astype(np.uint64)).view(np.int64), lengths, members

    ids, counts, found, held = [], [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = _WORD.findall((form(text) if form else text).lower())
            if len(own) < size:
                continue
            ids.append(key)
            counts.append(len(own))
            found += own
            held += len(text)
            if held > CHARACTERS:
                yield sets(ids, counts, found)
                ids, counts, found, held = [], [], [], 0
    if ids:
        yield sets(ids, counts, found)


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values.view(np.int64)))


def _shingle(size: int, form: Callable[[str], str] | None):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, classes, lengths, members in _sets_of_texts(batches, size, form):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(classes), _lists(lengths, members)], ["id", "class", "members"])

    return shingle


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))


def shingle_sets(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, form: Callable[[str], str] | None = None) -> DataFrame:
    """id, class, members: hashes of the sets of so many consecutive words of the whole text.

    form is applied to each text before its words are taken. Texts of fewer words have an
    empty set and are dropped, as are null keys and texts.
    """
    return _texts(df, key, text).mapInArrow(_shingle(size, form), SETS)


def sketches(members: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits a set: 8 of its size, 56 of a map of hashed members; zeros where a set is too large for them."""
    size = np.where(lengths <= SIZED, lengths, 0).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    bit = np.uint64(1) << (np.uint64(8) + mix(members ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(56))
    full = np.bitwise_or.reduceat(bit, starts) if len(members) else np.zeros(0, np.uint64)
    return size | np.where(lengths <= MAPPED, full, np.uint64(0))


def may_be_similar(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of these sketches can reach the threshold; never false for those that do.

    Sets of n and m members and Jaccard s or more differ in at most (n + m)(1 - s) / (1 + s)
    members, and in no fewer than their sizes or the bits of their maps differ in.
    """
    n, m = (a & np.uint64(255)).astype(np.int64), (b & np.uint64(255)).astype(np.int64)
    apart = np.where((n <= MAPPED) & (m <= MAPPED), np.bitwise_count((a ^ b) >> np.uint64(8)).astype(np.int64), 0)
    return (n == 0) | (m == 0) | (np.maximum(apart, np.abs(n - m)) <= (n + m) * (1 - threshold) / (1 + threshold) + 1e-9)


def _may_be_similar(a: str, b: str, threshold: float) -> Column:
    """may_be_similar as a Column."""
    n, m = F.col(a).bitwiseAND(255), F.col(b).bitwiseAND(255)
    apart = F.when((n <= MAPPED) & (m <= MAPPED), F.bit_count(F.shiftrightunsigned(F.col(a).bitwiseXOR(F.col(b)), 8))).otherwise(0)
    return (n == 0) | (m == 0) | (F.greatest(apart.cast("long"), F.abs(n - m)) <= (n + m) * ((1 - threshold) / (1 + threshold)) + 1e-9)


def _first_met(classes: np.ndarray, met: set[int]) -> np.ndarray:
    """Which classes a task meets for the first time: copies are signed once, so that a class met very often stays small."""
    if len(met) > REMEMBERED:
        met.clear()
    new = np.zeros(len(classes), bool)
    for i, c in enumerate(classes.tolist()):
        if c not in met:
            met.add(c)
            new[i] = True
    return new


def _keys(members: np.ndarray, lengths: np.ndarray, coordinates: int, count: int, rows: int) -> np.ndarray:
    """The bands of sets, a row of count keys for each."""
    ends = np.cumsum(lengths)
    cuts = np.unique(np.concatenate(([0], np.searchsorted(ends, np.arange(MEMBERS, ends[-1], MEMBERS)), [len(lengths)]))) if len(lengths) else [0]
    done = [bands(signatures(members[ends[a] - lengths[a] : ends[b - 1]], lengths[a:b], coordinates), count, rows) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return np.concatenate(done) if done else np.empty((0, count), np.uint64)


def _sign(coordinates: int, count: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(_first_met(batch.column(0).to_numpy(), met)))
            offsets = batch.column(1).offsets.to_numpy()
            flat, lengths = batch.column(1).values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64), np.diff(offsets)
            keys, sketch = _keys(flat, lengths, coordinates, count, rows), sketches(flat, lengths)
            owner, sketch = np.repeat(batch.column(0).to_numpy(), count), np.repeat(sketch, count)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(owner), pa.array(sketch.view(np.int64))], ["band", "class", "sketch"])

    return sign


def _sign_texts(size: int, form: Callable[[str], str] | None, coordinates: int, count: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for ids, classes, lengths, members in _sets_of_texts(batches, size, form):
            new = _first_met(classes, met)
            keys = _keys(members[np.repeat(new, lengths)], lengths[new], coordinates, count, rows)
            sketch = sketches(members, lengths).view(np.int64)
            # copies have no bands of their own
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(classes), pa.array(sketch), _lists(np.where(new, count, 0), keys.ravel())], ["id", "class", "sketch", "bands"])

    return sign


BANDS = "band long, class long, sketch long"


@dataclass
class Signed:
    """Records whose sets are signed.

    bands: band, class, sketch; membership: id, class; members_of: from class and id of
    some records to class and members of their sets.
    """

    bands: DataFrame
    membership: DataFrame
    members_of: Callable[[DataFrame], DataFrame]


def signed_sets(sets: DataFrame, coordinates: int = 128, count: int = 18, rows: int = 6) -> Signed:
    """sets: id, class and members, stored, as they are read several times."""
    keys = sets.select("class", "members").mapInArrow(_sign(coordinates, count, rows), BANDS)
    return Signed(keys, sets.select("id", "class"), lambda some: sets.join(some, ["class", "id"], "left_semi").select("class", "members").dropDuplicates(["class"]))


def signed_texts(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, form: Callable[[str], str] | None = None, coordinates: int = 128, count: int = 18, rows: int = 6) -> Signed:
    """The sets of shingle_sets, signed in one pass over the texts; sets are made again for those asked for alone."""
    texts = _texts(df, key, text)
    signed = cut(texts.mapInArrow(_sign_texts(size, form, coordinates, count, rows), "id long, class long, sketch long, bands array<long>"), "signed")
    again = lambda some: texts.join(some.select("id"), "id", "left_semi").select("id", "text").mapInArrow(_shingle(size, form), SETS).select("class", "members").dropDuplicates(["class"])
    return Signed(signed.select(F.explode("bands").alias("band"), "class", "sketch"), signed.select("id", "class"), again)


def _pairs_of_runs(threshold: float, most: int):
    names = ["class_a", "class_b", "band", "sketch"]

    def expand(owner: np.ndarray, sketch: np.ndarray, left: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The pairs of each entry with the entries that follow it in its run."""
        steps = np.concatenate(([0], np.cumsum(left)))
        at = 0
        while at < len(owner):
            to = max(at + 1, int(np.searchsorted(steps, steps[at] + 1_000_000, side="right")) - 1)
            size = left[at:to]
            first = np.repeat(np.arange(at, to), size)
            second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
            kept = may_be_similar(sketch[first], sketch[second], threshold)
            first, second = first[kept], second[kept]
            pairs = np.unique(np.stack([owner[first], owner[second]], axis=1), axis=0) if len(first) else np.empty((0, 2), np.int64)
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none], names)
            at = to

    def of(band: np.ndarray, owner: np.ndarray, sketch: np.ndarray) -> Iterator[pa.RecordBatch]:
        """band and owner sorted by both, the runs being whole."""
        fresh = np.concatenate(([True], (band[1:] != band[:-1]) | (owner[1:] != owner[:-1])))
        band, owner, sketch = band[fresh], owner[fresh], sketch[fresh]
        starts = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(band)])))
        size = np.repeat(sizes, sizes)
        left = size - 1 - (np.arange(len(band)) - np.repeat(starts, sizes))
        usual = (size > 1) & (size <= most)
        yield from expand(owner[usual], sketch[usual].view(np.uint64), left[usual])
        hot = size > most
        if hot.any():
            yield pa.RecordBatch.from_arrays([pa.array(owner[hot]), pa.nulls(int(hot.sum()), pa.int64()), pa.array(band[hot]), pa.array(sketch[hot])], names)

    def pairs_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns, strict=True)]
            # the last run may go on in the next batch
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                yield from of(*(h[:last] for h in held))
                held = [h[last:] for h in held]
        if len(held[0]):
            yield from of(*held)

    return pairs_of_runs


def candidate_pairs(keys: DataFrame, threshold: float, most: int = 2_000) -> DataFrame:
    """class_a < class_b: the distinct pairs of classes that share a band and may be similar, after one shuffle of the bands.

    keys: band, class, sketch. Bands that more than most classes share are not paired by the
    task that meets them but by a join, whose hot keys Spark splits.
    """
    sorted_keys = keys.repartition("band").sortWithinPartitions("band", "class")
    met = cut(sorted_keys.mapInArrow(_pairs_of_runs(threshold, most), "class_a long, class_b long, band long, sketch long"), "met")
    usual, hot = met.where("class_b is not null").select("class_a", "class_b"), met.where("class_b is null").select("band", "class_a", F.col("sketch").alias("sketch_a"))
    other = hot.select("band", F.col("class_a").alias("class_b"), F.col("sketch_a").alias("sketch_b"))
    across = hot.join(other, "band").where(F.expr("class_a < class_b") & _may_be_similar("sketch_a", "sketch_b", threshold))
    return usual.union(across.select("class_a", "class_b")).distinct()


def similar_classes(signed: Signed, threshold: float, broadcast_rows: int = 250_000) -> DataFrame:
    """class_a < class_b, similarity: pairs of classes with Jaccard at or above threshold.

    count bands of rows coordinates find the candidates. A pair of similarity s is missed with
    a chance near (1 - s^rows)^count. The list of classes with a candidate is broadcast up to
    broadcast_rows, and beyond that joined by a shuffle.
    """
    candidates = cut(candidate_pairs(signed.bands, threshold), "candidates")
    involved = candidates.select(F.col("class_a").alias("class")).union(candidates.select("class_b")).distinct()
    some = cut(signed.membership.join(involved, "class").groupBy("class").agg(F.min("id").alias("id")), "involved")
    sets = signed.members_of(F.broadcast(some) if some.count() <= broadcast_rows else some)
    of = lambda side: sets.select(F.col("class").alias(f"class_{side}"), F.col("members").alias(f"members_{side}"))
    checked = candidates.join(of("a"), "class_a").join(of("b"), "class_b")
    checked = checked.withColumn("_n", F.size(F.array_intersect("members_a", "members_b"))).select("class_a", "class_b", (F.col("_n") / (F.size("members_a") + F.size("members_b") - F.col("_n"))).alias("similarity"))
    return checked.where(F.col("similarity") >= threshold)


def spread(pairs: DataFrame, membership: DataFrame) -> DataFrame:
    """key_a < key_b: the pairs of records that pairs of classes stand for, and those within a class.

    n copies of one set give n (n - 1) / 2 rows; classes_and_links says the same in n.
    """
    members = membership.distinct()
    several = members.groupBy("class").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("class")
    own = members.join(several, "class", "left_semi")
    within = own.select("class", F.col("id").alias("x")).join(own.select("class", F.col("id").alias("y")), "class").where("x < y").select("x", "y")
    across = pairs.select("class_a", "class_b").join(members.select(F.col("class").alias("class_a"), F.col("id").alias("x")), "class_a").join(members.select(F.col("class").alias("class_b"), F.col("id").alias("y")), "class_b").where("x <> y").select("x", "y")
    return within.unionByName(across).select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))


def near_duplicates(signed: Signed, threshold: float = 0.8) -> DataFrame:
    """key_a < key_b: all pairs of records whose sets have intersection / union at or above threshold.

    A record that is repeated counts once. Empty sets are similar to nothing.
    """
    return spread(similar_classes(signed, threshold), signed.membership)


def classes_and_links(signed: Signed, threshold: float = 0.8) -> DataFrame:
    """key, class_key, copies, links: the class of each record, known by its smallest key, and how many other classes are similar to it.

    The form for collections with many copies: one row per record, whatever the size of its class.
    """
    pairs = similar_classes(signed, threshold)
    links = pairs.select(F.col("class_a").alias("class")).union(pairs.select("class_b")).groupBy("class").agg(F.count("*").alias("links"))
    members = signed.membership.distinct()
    known = members.groupBy("class").agg(F.min("id").alias("class_key"), F.count("*").alias("copies")).join(links, "class", "left")
    return members.join(known, "class").select(F.col("id").alias("key"), "class_key", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
