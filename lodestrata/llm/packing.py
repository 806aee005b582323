"""Filling containers of fixed capacity with items of varying length (problem 9).

Bounded-space online best fit. A fixed number of containers is open; a bitset keyed by free space
finds the one that an item fills best with one shift. When a new one must open, the fullest closes.
Items are spread over tasks by a hash of their key, so no container crosses tasks and the open ones
left at a task's end are its only loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


class BestFit:
    """Open containers of one capacity. place gives the number of the container that takes the item."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.bits, self.open, self.opened = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _put(self, container: int, free: int) -> None:
        if free > 0:
            self.by_free.setdefault(free, []).append(container)
            self.bits |= 1 << free
            self.open += 1

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        container = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return container

    def place(self, size: int) -> int:
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            container = self._take(free)
        else:
            if size < self.capacity and self.open >= self.most_open:  # an item of the whole capacity opens none
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            container, free = self.opened, self.capacity
            self.opened += 1
        self._put(container, free - size)
        return container


def pack(sizes: DataFrame, containers: DataFrame, key: str = "doc_id", size: str = "n_tokens", most_open: int = 64, items_per_task: int = 50_000, max_kinds: int = 1000) -> DataFrame:
    """container, bin, key, start, length, capacity: where each piece of each item lies, for every kind of container.

    containers has container and capacity_tokens, max_kinds rows at most; more is an error, kinds
    with a null or non-positive capacity are left out. An item goes whole into one bin; only one
    larger than the capacity is split, into full bins and a rest. An item of null or no size takes
    no room: it has one row with a null bin and length 0. Items with a null key are packed like the
    others. Repeated keys are items of their own. A task packs about items_per_task of them, by a hash of the key, so
    rows of one key meet in a task. bin is unique within its kind; the result is the same for
    the same rows, however they are ordered.
    """
    rows = containers.where("container is not null and capacity_tokens > 0").select("container", "capacity_tokens").distinct().limit(max_kinds + 1).collect()
    if len(rows) > max_kinds:
        raise ValueError(f"more than {max_kinds} kinds of containers")
    kinds = sorted((str(c), int(n)) for c, n in rows)
    items = sizes.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("size"))
    kind_of_key = dict(items.dtypes)["key"]
    items = cut_lineage(items)  # the sizes are measured once; the table's footer has their number
    tasks = max(1, -(-items.count() // items_per_task))
    spread = items.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int")).repartitionById(tasks, "task").sortWithinPartitions("task", "key", "size")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools: dict[tuple[int, str], BestFit] = {}
        for frame in frames:
            out: list[tuple] = []
            for task, item, length in zip(frame["task"], frame["key"], frame["size"]):
                for name, capacity in kinds:
                    fit = tools.get((task, name)) or tools.setdefault((task, name), BestFit(capacity, most_open))
                    if not length:
                        out.append((name, None, item, 0, 0, capacity))
                    for start in range(0, length, capacity):
                        piece = min(capacity, length - start)
                        out.append((name, task << 40 | fit.place(piece), item, start, piece, capacity))
            table = pd.DataFrame(out, columns=["container", "bin", "key", "start", "length", "capacity"])
            yield table.astype({"bin": "Int64"})

    return spread.mapInPandas(run, f"container string, bin long, key {kind_of_key}, start long, length long, capacity long").withColumnRenamed("key", key)
