"""Pairs rows of two tables by nearest time of the same entity, within a tolerance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Rows that one co-group should hold.
ROWS_PER_SHARD = 200_000


def bisect_slices(times: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """First position in each slice [lo, hi) of ``times`` (ascending within it) whose time is not below the wanted one.

    All searches advance together, one halving at a time.
    """
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        below = open_ & (times[np.where(open_, mid, 0)] < wanted)
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)


def _codes(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    both = pa.concat_arrays([x for c in (a, b) for x in c.chunks]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return both[: len(a)].astype(np.int64), both[len(a) :].astype(np.int64)


def _match(tolerance: float):
    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"left_id": left["left_id"].slice(0, 0), "right_id": right["right_id"].slice(0, 0), "gap": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        le, re = _codes(left["entity"], right["entity"])
        lc, rc = left["cell"].to_numpy(), right["cell"].to_numpy()
        lt, rt = left["t"].to_numpy(), right["t"].to_numpy()
        # A dense number for every (entity, cell).
        _, dense = np.unique(np.stack([np.concatenate([le, re]), np.concatenate([lc, rc])]), axis=1, return_inverse=True)
        lk, rk = dense.reshape(-1)[: len(le)], dense.reshape(-1)[len(le) :]
        order = np.lexsort((rt, rk))
        rk, rt = rk[order], rt[order]
        lo, hi = np.searchsorted(rk, lk, "left"), np.searchsorted(rk, lk, "right")
        at = bisect_slices(rt, lo, hi, lt)
        far = np.full(len(lt), np.inf)
        last = len(rt) - 1
        after = np.where(at < hi, np.abs(lt - rt[np.minimum(at, last)]), far)
        before = np.where(at > lo, np.abs(lt - rt[np.maximum(at - 1, 0)]), far)
        right_ids = np.asarray(right["right_id"].to_pylist(), object)[order]
        pick = np.where(before <= after, at - 1, at)
        tie = np.flatnonzero((before == after) & np.isfinite(before))  # equally near on both sides
        pick[tie] = np.where(right_ids[at[tie]] < right_ids[at[tie] - 1], at[tie], at[tie] - 1)
        gap = np.minimum(before, after)
        keep = np.flatnonzero(gap <= tolerance)
        return pa.table({"left_id": left["left_id"].take(pa.array(keep)), "right_id": pa.array(right_ids[pick[keep]].tolist(), right.schema.field("right_id").type), "gap": pa.array(gap[keep])})

    return match


def nearest_in_time(left: DataFrame, right: DataFrame, *, entity: str, left_id: str, left_time: str, right_id: str, right_time: str, tolerance: float, cell: float | None = None, per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """(left_id, right_id, gap): for each left row the right row of the same entity with the least |time difference|, if at most ``tolerance``.

    Both tables are cut into cells of (entity, time range); a right row goes to every
    cell that its margin of ``tolerance`` reaches, so that each left row finds its
    neighbours in its own cell. A cell with more rows of both sides than a shard should hold is
    halved in time, as often as it takes but not below an eighth of the tolerance, with
    the same margin; where the left rows of a piece are still too many, they are dealt out by hash.
    Right rows of an entity at one time are one, so that such a piece is bounded by the resolution of the
    times. Cells are hashed to shards, whose number follows the number of rows, and the shards are co-grouped. Within a
    shard a binary search runs over all left rows at once and compares the two neighbouring times.

    Rows with a null entity, id or time, and NaN, match nothing. Repeated left rows
    count once. Of right rows at one time of an entity, and of two equally near, the
    least ``right_id`` is taken. Other columns are not read, whatever their names.
    """
    width = float(cell or max(60.0 * tolerance, 60.0))
    margin = tolerance * (1 + 1e-9) + 1e-6
    deepest = max(0, int(np.log2(max(width / max(tolerance / 8, 1e-3), 1.0))))
    at = F.col("t")
    # Ties and repeated rows are settled here, before anything is spread.
    points = (
        right.select(F.col(entity).alias("entity"), F.col(right_time).cast("double").alias("t"), F.col(right_id).alias("right_id"))
        .filter(F.col("entity").isNotNull() & at.isNotNull() & ~F.isnan("t") & F.col("right_id").isNotNull())
        .groupBy("entity", "t")
        .agg(F.min("right_id").alias("right_id"))
    )
    wanted = (
        left.select(F.col(entity).alias("entity"), F.col(left_time).cast("double").alias("t"), F.col(left_id).alias("left_id"))
        .filter(F.col("entity").isNotNull() & at.isNotNull() & ~F.isnan("t") & F.col("left_id").isNotNull())
        .distinct()
    )
    spark = left.sparkSession
    homed = wanted.withColumn("cell", F.floor(at / width))
    # Rows of both sides by cell, counted in one pass that gives the number of shards and the crowded cells.
    counts = homed.select("entity", "cell").unionByName(points.select("entity", F.floor(at / width).alias("cell"))).groupBy("entity", "cell").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(counts, "cells")
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_shard))
    halvings = F.least(F.ceil(F.log2(F.col("n") / per_shard)).cast("int"), F.lit(deepest)).alias("halvings")
    crowded = counts.filter(F.col("n") > per_shard).select("entity", "cell", halvings)
    deep = F.coalesce("halvings", F.lit(0))
    piece = lambda t: F.floor(t / (F.lit(width) / F.pow(F.lit(2.0), deep)))
    homed = homed.join(crowded, ["entity", "cell"], "left").withColumn("piece", piece(at))
    dense = homed.groupBy("entity", "cell", "piece").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_shard).select("entity", "cell", "piece", F.ceil(F.col("n") / per_shard).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    homed = homed.join(dense, ["entity", "cell", "piece"], "left").withColumn("part", F.pmod(F.xxhash64("left_id"), parts).cast("int"))
    spread = points.withColumn("cell", F.explode(F.sequence(F.floor((at - margin) / width), F.floor((at + margin) / width)))).join(crowded, ["entity", "cell"], "left")
    # Pieces of this cell alone: the neighbouring cells' are the neighbouring rows'.
    whole = F.pow(F.lit(2.0), deep).cast("bigint")
    first, last = F.greatest(piece(at - margin), F.col("cell") * whole), F.least(piece(at + margin), (F.col("cell") + 1) * whole - 1)
    spread = spread.withColumn("piece", F.explode(F.sequence(first, F.greatest(first, last))))
    spread = spread.join(dense, ["entity", "cell", "piece"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    shard = F.pmod(F.xxhash64("entity", "cell", "piece", "part"), F.lit(shards)).cast("int").alias("shard")
    spread = spread.select("entity", F.xxhash64("cell", "piece").alias("cell"), "t", "right_id", shard)
    homed = homed.select("entity", F.xxhash64("cell", "piece").alias("cell"), "t", "left_id", shard)
    schema = f"left_id {dict(homed.dtypes)['left_id']}, right_id {dict(spread.dtypes)['right_id']}, gap double"
    return homed.groupBy("shard").cogroup(spread.groupBy("shard")).applyInArrow(_match(tolerance), schema)
