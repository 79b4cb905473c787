"""Problem 9: a mixture of sources with target shares of the total size.

Method. A multivariate-hypergeometric splitting tree: the sources' items are hashed into
blocks of one size; the blocks a source contributes are recursively divided between the halves
of the output shards by exact hypergeometric draws, so that every shard is an unbiased sample of
the mixture and no shard has a block more than another; the blocks of a source are permuted
and dealt out disjointly by these quotas, and each shard is shuffled locally. The one block that
a quota ends in is taken in part.

The driver splits as many blocks as it can hold among groups of shards. Where there are more
shards than that, each block has finer ones by a second hash, and the tree goes on below the
groups in tasks of their own, so that blocks stay smaller than shards at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpot.session import cut

#: Tokens of a shard if their number is not given.
SHARD = 50_000_000
#: Blocks of a shard, and blocks that the driver plans.
BLOCKS, PLANNED = 64, 65_536
#: Rows of the plan up to which it is broadcast.
BROADCAST_ROWS = 200_000


def quotas(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, int]:
    """The size each source contributes: its share of the total, at most max_repeat times what it has.

    Without a total, the largest at which every source that has items reaches its share. The
    shares of sources without items, or without a target, are zero; the others' are scaled up.
    """
    live = {s: t for s, t in targets.items() if sizes.get(s, 0) > 0 and t[0] > 0 and t[1] > 0}
    scale = sum(t[0] for t in live.values())
    if not live:
        return {}
    room = {s: sizes[s] * t[1] for s, t in live.items()}
    if total is None:
        total = int(min(room[s] / (t[0] / scale) for s, t in live.items()))
    return {s: min(room[s], round(total * t[0] / scale)) for s, t in live.items()}


def split_quotas(counts: np.ndarray, widths: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """How many blocks of each source every leaf gets: leaves x sources, summing to counts; a leaf's part goes by its width."""
    out = np.zeros((len(widths), len(counts)), np.int64)
    reach = np.concatenate(([0], np.cumsum(widths)))
    todo = [(0, len(widths), counts)]
    while todo:
        lo, hi, own = todo.pop()
        if hi - lo == 1:
            out[lo] = own
            continue
        mid = (lo + hi) // 2
        # the left part of the leaves takes its part of the blocks, drawn without replacement
        size = int(own.sum()) * int(reach[mid] - reach[lo]) // int(reach[hi] - reach[lo])
        drawn = rng.multivariate_hypergeometric(own, size, method="marginals") if size else np.zeros_like(own)
        todo += [(lo, mid, drawn), (mid, hi, own - drawn)]
    return out


def _hash(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def _deal(parts: list[tuple], counts: np.ndarray, names: list[str], widths: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[int, tuple]]:
    """(leaf, part) of every part (source, ...), the parts of a source permuted and dealt out by the tree."""
    dealt = split_quotas(counts, widths, rng)
    own: dict[str, list[tuple]] = {n: [] for n in names}
    for part in parts:
        own[part[0]].append(part)
    for j, name in enumerate(names):
        leaf_of = np.repeat(np.arange(len(widths)), dealt[:, j])
        for i, leaf in zip(rng.permutation(len(own[name])), leaf_of, strict=True):
            yield int(leaf), own[name][i]


def _fine(fine: int, bounds: np.ndarray, seed: int):
    """The finer blocks of each group's blocks, dealt to the group's shards."""

    def deal(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["part_of"].iloc[0])
        rows = sorted(frame[["source", "block", "use_no"]].itertuples(index=False, name=None))
        parts = [(source, block, use, sub) for source, block, use in rows for sub in range(fine)]
        names = sorted({p[0] for p in parts})
        counts = np.array([sum(r[0] == n for r in rows) * fine for n in names], np.int64)
        rng = np.random.Generator(np.random.PCG64([seed, group]))
        shards = np.arange(bounds[group], bounds[group + 1])
        plan = [(*p, int(shards[leaf])) for leaf, p in _deal(parts, counts, names, np.ones(len(shards), np.int64), rng)]
        return pd.DataFrame(plan, columns=["source", "block", "use_no", "sub", "shard"])

    return deal


def mix(items: DataFrame, targets: DataFrame, key: str = "doc_id", total: int | None = None, shards: int | None = None, seed: int = 17, planned: int = PLANNED, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """shard, pos, key, source, use_no, n_tokens: the mixture, each use of an item on a row of its own.

    items: key, source, n_tokens; targets: source, target_share, max_repeat. shards: by
    default one for each SHARD tokens, 16 at least, so each is small enough to shuffle. planned:
    blocks that the driver sees, whatever the data; all sources' blocks are of like size. A
    source is used in whole passes and one part of a pass; within a pass no item comes
    twice, so none is used more than max_repeat times. Quotas are met to within one item.
    Items with a null source or size, or of none, are left out, as are sources without a target.
    """
    wanted = {r.source: (float(r.target_share), int(r.max_repeat)) for r in targets.where("source is not null and target_share is not null and max_repeat is not null").collect()}
    sized = items.where("source is not null and n_tokens > 0").select(key, "source", "n_tokens")
    sized = sized.where(F.col("source").isin(list(wanted)))
    sizes = {r.source: r["size"] for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("size")).collect()}
    quota = {s: q for s, q in quotas(sizes, wanted, total).items() if q > 0}
    mixed = sum(quota.values())
    shards = shards or max(16, -(-mixed // SHARD))
    # blocks so small that a shard has many, but no more than the driver can plan
    natural = max(1, -(-mixed // (shards * BLOCKS)))
    size_of_block = max(natural, -(-(mixed + sum(sizes[s] for s in quota)) // planned))
    blocks = {s: -(-sizes[s] // size_of_block) for s in quota}
    groups = shards if size_of_block == natural else max(1, min(shards, mixed // (size_of_block * BLOCKS)))
    fine = -(-shards // groups)
    per_source = F.create_map(*(F.lit(x) for s, n in blocks.items() for x in (s, n)))[F.col("source")] if blocks else F.lit(1)
    sized = sized.where(F.col("source").isin(list(quota))).withColumn("block", F.pmod(_hash(F.lit(seed), key), per_source).cast("int"))
    sized = cut(sized.withColumn("sub", F.pmod(_hash(F.lit(seed + 1), key), F.lit(fine)).cast("int")), "sized")
    per_block: dict[str, list[tuple[int, int]]] = {s: [] for s in quota}
    for r in sized.groupBy("source", "block").agg(F.sum("n_tokens").alias("size")).collect():
        per_block[r.source].append((r.block, r["size"]))
    rng = np.random.Generator(np.random.PCG64(seed))
    names = sorted(quota)
    uses: list[tuple[str, int, int]] = []
    ends: list[tuple[str, int, int, int]] = []  # the block that a quota ends in, and how much of it is taken
    for source in names:
        own = sorted(per_block[source])
        rest, use = quota[source], 0
        while rest > 0:
            use += 1
            for i in rng.permutation(len(own)):
                block, size = own[i]
                if rest <= 0:
                    break
                uses.append((source, block, use))
                if size > rest:
                    ends.append((source, block, use, rest))
                rest -= size
    spark = sized.sparkSession
    bounds = np.array([g * shards // groups for g in range(groups + 1)])
    counts = np.array([sum(u[0] == n for u in uses) for n in names], np.int64)
    coarse = [(*part, leaf) for leaf, part in _deal(uses, counts, names, np.diff(bounds), rng)] if names else []
    plan = spark.createDataFrame(coarse, "source string, block int, use_no int, part_of int")
    if fine > 1:
        steps = cut(plan.groupBy("part_of").applyInPandas(_fine(fine, bounds, seed), "source string, block int, use_no int, sub int, shard int"), "plan")
    else:
        steps = plan.select("source", "block", "use_no", F.lit(0).alias("sub"), F.col("part_of").alias("shard"))
    used = sized.join(F.broadcast(steps) if len(coarse) * fine <= broadcast_rows else steps, ["source", "block", "sub"])
    # of a block in which a quota ends the first items in a hashed order are taken; one block a source
    partial = F.broadcast(spark.createDataFrame(ends, "source string, block int, use_no int, part long"))
    used = used.join(partial, ["source", "block", "use_no"], "left")
    before = Window.partitionBy("source", "block", "use_no").orderBy(_hash(F.lit(seed), "use_no", key), key).rowsBetween(Window.unboundedPreceding, -1)
    partly = used.where("part is not null").withColumn("_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).where("_before < part").drop("_before")
    every = used.where("part is null").unionByName(partly)
    local = Window.partitionBy("shard").orderBy(_hash(F.lit(seed), "shard", "use_no", key), key, "use_no")
    return every.withColumn("pos", F.row_number().over(local)).select("shard", "pos", key, "source", "use_no", "n_tokens")


def shares(mixture: DataFrame, items: DataFrame, targets: DataFrame, key: str = "doc_id") -> DataFrame:
    """source, target_share, max_repeat, available, used, actual_share, most_uses for every source with a target."""
    used = mixture.groupBy("source").agg(F.sum("n_tokens").alias("used"), F.max("use_no").alias("most_uses"))
    available = items.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    total = used.agg(F.sum("used").alias("total"))
    report = targets.join(available, "source", "left").join(used, "source", "left").join(F.broadcast(total))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return report.select("source", "target_share", "max_repeat", zero("available").alias("available"), zero("used").alias("used"), F.coalesce(F.col("used") / F.col("total"), F.lit(0.0)).alias("actual_share"), zero("most_uses").alias("most_uses"))
