"""Fills containers of fixed capacity with items of varying length.

Both plans are made from the global histogram of item sizes, which has at most as many
rows as the capacity; items themselves never come to the driver. The named method
(length buckets by dynamic programming, batches inside a bucket) leaves an item longer
than half a container alone in it. The plan used by default therefore opens batches
size by size and tops their unused space up with smaller sizes, best fit first.
"""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut

#: Items that are ranked together.
ROWS_PER_SALT = 50_000


@dataclass
class Plan:
    """Where the items of each size go, by ranges of their rank within the size.

    Item r of a range lies in container ``first + (r - lo + skip) // per`` and starts at
    ``offset + (r - lo + skip) % per * stride``.
    """

    size: list[int]
    lo: list[int]
    skip: list[int]
    first: list[int]
    per: list[int]
    offset: list[int]
    stride: list[int]
    containers: int = 0

    @classmethod
    def empty(cls) -> Plan:
        return cls([], [], [], [], [], [], [])

    def put(self, size: int, lo: int, first: int, per: int, offset: int, stride: int, skip: int = 0) -> None:
        for name, value in (("size", size), ("lo", lo), ("skip", skip), ("first", first), ("per", per), ("offset", offset), ("stride", stride)):
            getattr(self, name).append(value)

    def arrays(self) -> dict[str, np.ndarray]:
        """By size and rank."""
        columns = {k: np.array(getattr(self, k), np.int64) for k in ("size", "lo", "skip", "first", "per", "offset", "stride")}
        order = np.lexsort((columns["lo"], columns["size"]))
        return {k: v[order] for k, v in columns.items()}


def bucket_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets with the least total padding up to the bounds.

    Dynamic programming over the sizes that occur; the best last bucket is found on
    the lower envelope of lines, so a bucket costs one pass over the sizes.
    """
    sizes = sorted(histogram)
    n = len(sizes)
    count, tokens = [0], [0]
    for s in sizes:
        count.append(count[-1] + histogram[s])
        tokens.append(tokens[-1] + s * histogram[s])
    cost = [0] + [float("inf")] * n
    came: list[list[int]] = []
    for _ in range(min(buckets, n)):
        new, back = [cost[0]] + [float("inf")] * n, [0] * (n + 1)
        hull: deque[tuple[int, float, int]] = deque()
        for j in range(1, n + 1):
            if cost[j - 1] < float("inf"):
                line = (-count[j - 1], cost[j - 1] + tokens[j - 1], j - 1)
                while len(hull) > 1 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
            if not hull:
                continue
            top = sizes[j - 1]
            while len(hull) > 1 and hull[1][0] * top + hull[1][1] <= hull[0][0] * top + hull[0][1]:
                hull.popleft()
            best = hull[0][0] * top + hull[0][1] + top * count[j] - tokens[j]
            new[j], back[j] = best, hull[0][2]
            if cost[j] <= best:
                new[j], back[j] = cost[j], -1
        came.append(back)
        cost = new
    bounds, j = [], n
    for back in reversed(came):
        if j == 0:
            break
        if back[j] == -1:
            continue
        bounds.append(sizes[j - 1])
        j = back[j]
    return bounds[::-1]


def bucket_plan(histogram: dict[int, int], capacity: int, buckets: int) -> Plan:
    """The named method: inside a bucket of bound U every container takes capacity // U items."""
    plan, first = Plan.empty(), 0
    low = 0
    for bound in bucket_bounds(histogram, buckets):
        per, rank = capacity // bound, 0
        for size in sorted((s for s in histogram if low < s <= bound), reverse=True):
            plan.put(size, 0, first, per, 0, bound, skip=rank)
            rank += histogram[size]
        first += -(-rank // per)
        low = bound
    plan.containers = first
    return plan


def best_fit_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Sizes from long to short; a size first goes where it leaves the least space, then opens containers.

    Containers in the same state form ranges of ids, so that the work depends on the
    number of sizes and not of items.
    """
    plan = Plan.empty()
    spaces: list[int] = []  # ascending unused spaces that occur
    ranges: dict[int, list[tuple[int, int]]] = {}  # by unused space: (first container, containers)

    def leave(space: int, first: int, many: int) -> None:
        if space <= 0 or many <= 0:
            return
        if space not in ranges:
            bisect.insort(spaces, space)
            ranges[space] = []
        ranges[space].append((first, many))

    fresh = 0
    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        at = bisect.bisect_left(spaces, size)
        while left and at < len(spaces):
            space = spaces[at]
            first, many = ranges[space].pop()
            if not ranges[space]:
                del ranges[space]
                spaces.pop(at)
            per = space // size
            full = min(many, left // per)
            if full:
                plan.put(size, rank, first, per, capacity - space, size)
                rank, left = rank + full * per, left - full * per
                leave(space - per * size, first, full)
            if full < many and 0 < left < per:
                plan.put(size, rank, first + full, per, capacity - space, size)
                leave(space - left * size, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(space, first + full, many - full)
            at = bisect.bisect_left(spaces, size)
        if left:
            per = capacity // size
            plan.put(size, rank, fresh, per, 0, size)
            full, rest = divmod(left, per)
            leave(capacity - per * size, fresh, full)
            fresh += full
            if rest:
                leave(capacity - rest * size, fresh, 1)
                fresh += 1
    plan.containers = fresh
    return plan


def pack(sizes: DataFrame, *, key: str, size: str, capacity: int, method: str = "best_fit", buckets: int = 64) -> DataFrame:
    """(key, piece_no, token_from, token_to, container_id, offset): every item's place.

    An item longer than ``capacity`` is split into full pieces and a rest; no other
    item is split, and no container holds more than ``capacity``. method: ``best_fit``,
    or ``buckets`` for the length buckets alone.

    Items of null, zero or negative size get no row; repeated rows are items of their
    own. Container ids count from 0 without gaps. Items are ranked within their size
    in parts by a hash of the key, so that a size that fills much of the table is
    ranked by many tasks; the parts' counts give the offsets. Other columns are not read.
    """
    if method not in ("best_fit", "buckets"):
        raise ValueError(method)
    total = F.col("total")
    items = sizes.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("total")).filter(total > 0)
    items = items.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((total - 1) / capacity))))
    items = items.select("key", (F.col("piece_no") + 1).cast("int").alias("piece_no"), (F.col("piece_no") * capacity).alias("token_from"), F.least(total, (F.col("piece_no") + 1) * capacity).alias("token_to"))
    items = cut(items.withColumn("size", F.col("token_to") - F.col("token_from")), "items")
    # At most ``capacity`` rows.
    histogram = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity) if method == "best_fit" else bucket_plan(histogram, capacity, buckets)
    salts = max(1, sum(histogram.values()) // ROWS_PER_SALT)
    items = items.withColumn("salt", F.pmod(F.xxhash64("key", "piece_no"), F.lit(salts)))
    parts = items.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select("size", "salt", (F.sum("n").over(W.partitionBy("size").orderBy("salt")) - F.col("n")).alias("before"))
    within = F.row_number().over(W.partitionBy("size", "salt").orderBy("key", "piece_no")) - 1
    ranked = items.withColumn("within", within).join(before, ["size", "salt"]).withColumn("rank", F.col("before") + F.col("within"))
    table = sizes.sparkSession.sparkContext.broadcast(plan.arrays())
    rows = ranked.select("key", "piece_no", "token_from", "token_to", "size", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = table.value
        sizes_at = np.searchsorted(p["size"], np.arange(capacity + 2))
        for batch in batches:
            s, r = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            lo, hi = sizes_at[s], sizes_at[s + 1]
            while True:  # last range of the size that begins at or before the rank
                open_ = hi - lo > 1
                if not open_.any():
                    break
                mid = (lo + hi) >> 1
                ok = open_ & (p["lo"][np.where(open_, mid, 0)] <= r)
                lo, hi = np.where(ok, mid, lo), np.where(open_ & ~ok, mid, hi)
            i = r - p["lo"][lo] + p["skip"][lo]
            container = p["first"][lo] + i // p["per"][lo]
            offset = p["offset"][lo] + i % p["per"][lo] * p["stride"][lo]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(container), pa.array(offset, pa.int32())], ["key", "piece_no", "token_from", "token_to", "container_id", "offset"])

    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(place, f"key {kind}, piece_no int, token_from bigint, token_to bigint, container_id bigint, offset int").withColumnRenamed("key", key)
