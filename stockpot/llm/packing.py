"""Problem 8: filling containers of fixed capacity with items.

Method. Bounded-space online packing: each partition keeps a fixed number of open windows.
An item goes to the window where it fits best; if it fits none, the fullest window is
emitted and a new one opened. The windows still open at the end are merged among
partitions by the same rule, in rounds, largest first.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

#: Containers of one partition take numbers below this.
SPAN = 2**40


class Windows:
    """At most so many open windows, sorted by the room they have."""

    def __init__(self, capacity: int, most: int, first: int) -> None:
        self.capacity, self.most, self.next = capacity, most, first
        self.open: list[tuple[int, int]] = []  # (room, number)

    def place(self, size: int) -> tuple[int, int | None]:
        """The window that takes the item, and the one that was emitted for it."""
        at = bisect_left(self.open, (size, -1))
        emitted = None
        if at < len(self.open):
            room, number = self.open.pop(at)
        else:
            if len(self.open) >= self.most:
                emitted = self.open.pop(0)[1]
            room, number = self.capacity, self.next
            self.next += 1
        if room > size:
            insort(self.open, (room - size, number))
        return number, emitted


def _pack(capacity: int, most: int, key: str):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = Windows(capacity, most, TaskContext.get().partitionId() * SPAN)
        for frame in frames:
            rows = []
            for item, size in zip(frame[key], frame["n_tokens"], strict=True):
                pieces = max(1, -(-size // capacity))
                for piece in range(pieces):
                    part = min(capacity, size - piece * capacity)
                    rows.append((windows.place(part)[0], item, piece + 1, piece * capacity, part))
            yield pd.DataFrame(rows, columns=["container", key, "piece", "start", "n_tokens"])

    return pack


def _merge(capacity: int, most: int):
    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = Windows(capacity, most, TaskContext.get().partitionId() * SPAN)
        for frame in frames:
            groups = [windows.place(fill)[0] for fill in frame["fill"]]
            yield pd.DataFrame({"root": frame["root"], "fill": frame["fill"], "group": groups})

    return merge


def pack(items: DataFrame, key: str, capacity: int = 2048, windows: int = 64, full: float = 0.98, rounds: int = 2, per_task: int = 20_000) -> DataFrame:
    """container, key, piece, start, n_tokens: where each item, or each piece of a long one, goes.

    items: key and n_tokens. Only an item longer than the capacity is split, into pieces of
    the capacity and a rest; start is the offset of a piece in tokens. An item of no tokens
    takes no room and gets a container like any other. windows: open ones per partition.
    full: containers filled less than this are merged at the end. rounds: merges, the second among
    what other tasks left. per_task: containers that one merging task takes. Repeated keys are
    separate items; null sizes count as none.
    """
    schema = f"container long, `{key}` {dict(items.dtypes)[key]}, piece int, start long, n_tokens long"
    sized = items.select(key, F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("long").alias("n_tokens"))
    placed = cut(sized.mapInPandas(_pack(capacity, windows, key), schema), "packed")
    # the merges move containers, not items: a few numbers for each that has room left
    fills = placed.groupBy("container").agg(F.sum("n_tokens").alias("fill"))
    moves = cut(fills.where(F.col("fill") < full * capacity).select("container", F.col("container").alias("root"), "fill"), "loose")
    for turn in range(rounds):
        loose = moves.groupBy("root").agg(F.max("fill").alias("fill"))
        tasks = max(1, -(-loose.count() // per_task))
        spread = loose.repartition(tasks, F.xxhash64("root", F.lit(turn))).sortWithinPartitions(F.desc("fill"), "root")
        grouped = cut(spread.mapInPandas(_merge(capacity, 4 * windows), "root long, fill long, group long"), "grouped")
        # a merged container takes the least number of those in it
        group = grouped.groupBy("group").agg(F.min("root").alias("new"), F.sum("fill").alias("total"))
        step = grouped.join(group, "group").select("root", "new", "total")
        moves = cut(moves.join(step, "root").select("container", F.col("new").alias("root"), F.col("total").alias("fill")), "moves")
    target = moves.select("container", "root")
    return placed.join(target, "container", "left").select(F.coalesce("root", "container").alias("container"), key, "piece", "start", "n_tokens")
