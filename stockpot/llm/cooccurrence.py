"""Problem 1: items that appear together.

Method. A blocked Gram matrix: the baskets of a block of records become a binary matrix
over the items of the block; the items met most form a dense block whose transpose-product
with itself is one matrix multiplication, the other items form sparse blocks whose products
are summed by outer products of their rows. The products of all record blocks are summed;
the diagonal holds the marginals, by which the counts are normalised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

#: Records and items of a block, items of its dense block, rows of one matrix product, and outer-product entries held at once.
RECORDS, ITEMS, DENSE, ROWS, ENTRIES = 65_536, 4_000_000, 512, 4_096, 2_000_000
#: The kind under which the number of records travels.
TOTAL = ""


def basket(items: Column) -> Column:
    """The distinct items of an array, trimmed and lower-cased; null and blank ones dropped."""
    clean = F.transform(items, lambda x: F.lower(F.regexp_replace(x, r"(?U)^\s+|\s+$", "")))
    return F.array_distinct(F.filter(clean, lambda x: x.isNotNull() & (x != "")))


def gram(codes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, count) of the upper triangle with the diagonal of X'X for binary baskets given row by row."""
    count = np.bincount(codes, minlength=width)
    dense_items = np.argsort(-count, kind="stable")[:DENSE]
    place = np.full(width, -1, np.int64)
    place[dense_items] = np.arange(len(dense_items))
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = place[codes]
    product = np.zeros((len(dense_items),) * 2)
    inside = at >= 0
    r, c = row[inside], at[inside]
    starts = np.searchsorted(r, np.arange(0, len(lengths) + ROWS, ROWS))
    for k in range(len(starts) - 1):
        block = np.zeros((ROWS, len(dense_items)), np.float32)
        block[r[starts[k] : starts[k + 1]] - k * ROWS, c[starts[k] : starts[k + 1]]] = 1
        product += block.T @ block
    i, j = np.nonzero(np.triu(product))
    a, b, n = [dense_items[i]], [dense_items[j]], [product[i, j].astype(np.int64)]
    # the products with a sparse item: each sparse entry meets the entries of its row
    first = np.concatenate(([0], np.cumsum(lengths)))
    sparse = np.flatnonzero(~inside)
    sizes = lengths[row[sparse]]
    ends = np.cumsum(sizes)
    bounds = [0, *np.searchsorted(ends, np.arange(ENTRIES, ends[-1] if len(ends) else 0, ENTRIES)), len(sparse)]
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if lo == hi:
            continue
        own, size = sparse[lo:hi], sizes[lo:hi]
        left = np.repeat(own, size)
        right = np.arange(len(left)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[row[own]], size)
        # a pair of two sparse items comes from both of them, and counts once
        keep = inside[right] | (codes[left] <= codes[right])
        pair, m = np.unique(codes[left[keep]].astype(np.int64) * width + codes[right[keep]], return_counts=True)
        a.append(pair // width)
        b.append(pair % width)
        n.append(m)
    return np.concatenate(a), np.concatenate(b), np.concatenate(n)


def _items(batch: pa.RecordBatch) -> int:
    return sum(len(lists.flatten()) for lists in batch.columns)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of no more items than a block may hold; one record is never parted."""
    if batch.num_rows < 2 or _items(batch) <= ITEMS:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from _pieces(batch.slice(0, half))
    yield from _pieces(batch.slice(half))


def _products(kinds: list[str]):
    schema = pa.schema([("item_kind", pa.string()), ("item_a", pa.string()), ("item_b", pa.string()), ("n", pa.int64())])

    def of_block(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches(batches)
        yield pa.RecordBatch.from_pylist([{"item_kind": TOTAL, "item_a": TOTAL, "item_b": TOTAL, "n": block.num_rows}], schema)
        for k, kind in enumerate(kinds):
            lists = pa.concat_arrays(block.column(k).chunks)
            lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
            coded = lists.flatten().dictionary_encode()
            if not len(coded):
                continue
            words = coded.dictionary
            a, b, n = gram(coded.indices.to_numpy(), lengths.astype(np.int64), len(words))
            for at in range(0, len(a), 100_000):
                x, y = words.take(pa.array(a[at : at + 100_000])), words.take(pa.array(b[at : at + 100_000]))
                swap = pa.compute.greater(x, y)
                yield pa.RecordBatch.from_arrays([pa.repeat(kind, len(x)), pa.compute.if_else(swap, y, x), pa.compute.if_else(swap, x, y), pa.array(n[at : at + 100_000])], schema=schema)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        held: list[pa.RecordBatch] = []
        records = items = 0
        for batch in (piece for whole in batches for piece in _pieces(whole)):
            size = _items(batch)
            if held and (records + batch.num_rows > RECORDS or items + size > ITEMS):
                yield from of_block(held)
                held, records, items = [], 0, 0
            held.append(batch)
            records, items = records + batch.num_rows, items + size
        if held:
            yield from of_block(held)

    return products


def cooccurrence(records: DataFrame, kinds: dict[str, str], min_count: int = 1) -> DataFrame:
    """item_kind, item_a < item_b, n_ab, n_a, n_b, n_records, lift for the arrays of a record.

    records: one row per record. kinds: item kind -> array column. lift is n_ab * N / (n_a * n_b),
    how many times as often as chance the two appear together. Pairs met less than min_count
    times are left out of the result, exactly, after all blocks are summed. A null array is an
    empty basket, repeated items count once, and an empty table gives no rows. Pairs of one
    frequent item meet its marginal by a join whose hot keys Spark splits.
    """
    baskets = records.select(*(F.coalesce(basket(F.col(c)), F.array().cast("array<string>")).alias(f"_{i}") for i, c in enumerate(kinds.values())))
    sums = baskets.mapInArrow(_products(list(kinds)), "item_kind string, item_a string, item_b string, n long").groupBy("item_kind", "item_a", "item_b").agg(F.sum("n").alias("n"))
    sums = cut(sums.where((F.col("item_a") == F.col("item_b")) | (F.col("n") >= min_count)), "gram")
    total = sums.where(F.col("item_kind") == TOTAL).first()
    single = sums.where((F.col("item_kind") != TOTAL) & (F.col("item_a") == F.col("item_b"))).select("item_kind", F.col("item_a").alias("item"), "n")
    pairs = sums.where(F.col("item_a") < F.col("item_b")).withColumnRenamed("n", "n_ab")
    pairs = pairs.join(single.select("item_kind", F.col("item").alias("item_a"), F.col("n").alias("n_a")), ["item_kind", "item_a"])
    pairs = pairs.join(single.select("item_kind", F.col("item").alias("item_b"), F.col("n").alias("n_b")), ["item_kind", "item_b"])
    return pairs.select("item_kind", "item_a", "item_b", "n_ab", "n_a", "n_b", F.lit(total.n if total else 0).cast("long").alias("n_records")).withColumn("lift", F.col("n_ab") * F.col("n_records") / (F.col("n_a") * F.col("n_b")))
