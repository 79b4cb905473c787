"""Problem 2: frequency of every distinct value, and in how many records it occurs.

Method. Heavy-light aggregation: a bounded sketch of each partition finds the terms that
may hold a large share of the rows; they are broadcast and their rows are counted in local
arrays where they lie. Only the rows of the other terms are shuffled, and the two tables are
united. That a record holds a heavy term in several partitions only the record can tell: of
heavy terms a partition sends one row a record, the set of their small codes, and the tasks
that gather these sets count in local arrays too. Counts are exact whichever way a term goes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def compact(record: Column) -> Column:
    """A record's text id as bytes, UUIDs in 16; different ids stay different."""
    return F.when(record.rlike(_UUID), F.unhex(F.replace(record, F.lit("-"), F.lit("")))).otherwise(F.concat(F.lit("t").cast("binary"), record.cast("binary")))


def _sketch(share: float):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        rows = lost = 0
        for batch in batches:
            rows += batch.num_rows
            met = pa.Table.from_batches([batch]).group_by(["field_name", "term"]).aggregate([([], "count_all")]).to_pydict()
            for field, term, n in zip(met["field_name"], met["term"], met["count_all"], strict=True):
                counts[field, term] += n
            if len(counts) > 8 / share:
                # what is given up here bounds the error of every count that is kept
                floor = sorted(counts.values(), reverse=True)[int(4 / share)]
                lost += floor
                counts = Counter({k: c - floor for k, c in counts.items() if c > floor})
        kept = [(*k, c + lost) for k, c in counts.items() if c + lost >= share * rows]
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["field_name", "term", "n"])

    return sketch


def heavy_terms(long: DataFrame, share: float = 0.002) -> list[tuple[str, str]]:
    """Terms that may hold at least share of the rows, the likeliest first; at most 2 / share of them.

    A term with that share of all rows has it in some partition, so none is missed.
    """
    found = long.select("field_name", "term").mapInArrow(_sketch(share), "field_name string, term string, n long")
    found = found.groupBy("field_name", "term").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "field_name", "term").limit(int(2 / share))
    return [(r.field_name, r.term) for r in found.collect()]


#: Rows whose records are gathered before they are sent on.
GATHERED = 400_000
PART = "record binary, codes binary, code int, n long"


def _code_sets(heavy: int):
    """From (code, record) rows: the set of codes of each record of some rows, and at last the occurrences of each code."""
    names = ["record", "codes", "code", "n"]

    def sets(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        coded = table.column(1).combine_chunks().dictionary_encode()
        pair = np.unique(coded.indices.to_numpy().astype(np.int64) * heavy + table.column(0).to_numpy())
        record, code = pair // heavy, (pair % heavy).astype("<u2")
        starts = np.flatnonzero(np.concatenate(([True], record[1:] != record[:-1])))
        offsets = pa.py_buffer(np.concatenate((starts, [len(code)])).astype(np.int32) * 2)
        packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(code)])
        none = len(starts)
        return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(record[starts])), packed, pa.nulls(none, pa.int32()), pa.nulls(none, pa.int64())], names)

    def code_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences = np.zeros(heavy, np.int64)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            occurrences += np.bincount(batch.column(0).to_numpy(), minlength=heavy)
            held.append(batch)
            if sum(b.num_rows for b in held) >= GATHERED:
                yield sets(held)
                held = []
        if held:
            yield sets(held)
        some = np.flatnonzero(occurrences)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.binary()), pa.nulls(len(some), pa.binary()), pa.array(some, pa.int32()), pa.array(occurrences[some])], names)

    return code_sets


def _count_records(heavy: int):
    """code, n: in how many records each code is, from rows sorted by record."""

    def count_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = np.zeros(heavy, np.int64)
        last, met = None, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            record, codes = batch.column(0), batch.column(1)
            same = pc.equal(record[1:], record[:-1]).to_numpy(zero_copy_only=False)
            run = np.concatenate(([0], np.cumsum(~same)))
            sizes = pc.binary_length(codes).to_numpy() // 2
            flat = np.frombuffer(b"".join(codes.to_pylist()), "<u2").astype(np.int64)
            pair = np.unique(np.repeat(run, sizes) * heavy + flat)
            # the first record may be the last of the batch before
            if last is not None and record[0].as_py() == last:
                pair = pair[~((pair < heavy) & np.isin(pair, met))]
                met = np.concatenate((met, pair[pair < heavy])) if run[-1] == 0 else pair[pair >= run[-1] * heavy] % heavy
            else:
                met = pair[pair >= run[-1] * heavy] % heavy
            last = record[-1].as_py()
            records += np.bincount(pair % heavy, minlength=heavy)
        some = np.flatnonzero(records)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(records[some])], ["code", "n"])

    return count_records


def term_frequency(long: DataFrame, share: float = 0.002) -> DataFrame:
    """field_name, term, occurrences, records: exact counts of rows and of distinct records per term.

    long: field_name, term, record; rows with a null term or record are no occurrences. Terms
    are compared as stored, the empty text being one. share: of the rows that a heavy term
    holds, 2^-15 at least. The pairs of other terms and records are made distinct by both
    together, so neither a hot term nor a hot record is one task's load.
    """
    if share < 2**-15:
        raise ValueError("codes of heavy terms have 16 bits")
    long = long.where("term is not null and record is not null").select("field_name", "term", "record")
    heavy = heavy_terms(long, share)
    codes = F.broadcast(long.sparkSession.createDataFrame([(f, t, i) for i, (f, t) in enumerate(heavy)], "field_name string, term string, code int"))
    coded = long.join(codes, ["field_name", "term"], "left").select("code", "field_name", "term", compact(F.col("record")).alias("record"))
    light = coded.where("code is null").groupBy("field_name", "term", "record").agg(F.count("*").alias("n")).groupBy("field_name", "term").agg(F.sum("n").alias("occurrences"), F.count("*").alias("records"))
    if not heavy:
        return light
    parts = cut(coded.where("code is not null").select("code", "record").mapInArrow(_code_sets(len(heavy)), PART), "heavy")
    occurrences = parts.where("code is not null").groupBy("code").agg(F.sum("n").alias("occurrences"))
    by_record = parts.where("record is not null").select("record", "codes").repartition("record").sortWithinPartitions("record")
    records = by_record.mapInArrow(_count_records(len(heavy)), "code int, n long").groupBy("code").agg(F.sum("n").alias("records"))
    return light.unionByName(codes.join(occurrences, "code").join(records, "code").select("field_name", "term", "occurrences", "records"))


def mark(records: Column, total: int, rare_below: int = 5, common_above: float = 0.1) -> Column:
    """rare, common or null; rare goes first where a small collection makes a term both."""
    return F.when(records < rare_below, "rare").when(records > F.lit(common_above) * total, "common")
