"""Ordered series of distances: change detection, sections, peaks, thresholds.

The folds that can't be windows (Viterbi, progressive merging, refinement) run an
entity at a time over two or three numbers a row. A series is one video's frames,
whose number its duration bounds; :data:`MAX_SERIES` rows are a few hundred MB.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Path costs nearer than this are ties, whatever the order in which they were summed.
TIE = 1e-9
#: A longer series is an error, not a cut.
MAX_SERIES = 10_000_000


def consecutive_distances(df: DataFrame, *, entity: str, order: str, value: str) -> DataFrame:
    """Rows with ``d``: absolute difference to the value before, 0 for the first."""
    before = F.lag(value).over(W.partitionBy(entity).orderBy(order))
    return df.withColumn("d", F.coalesce(F.abs(F.col(value) - before), F.lit(0.0)))


def change_points(d: np.ndarray, stay: float = 0.97, least: float = 0.01, bulk: float = 0.75) -> np.ndarray:
    """Indices that a two-state model calls changes.

    Staying emits an exponential density whose scale is the mean of the distances up
    to the ``bulk`` quantile, at least ``least``; a change emits a uniform one and is
    never followed by another. The best path prefers staying on ties.
    """
    n = len(d)
    if not n:
        return np.zeros(0, np.int64)
    scale = max(float(d[d <= np.quantile(d, bulk)].mean()), least)
    same = -np.log(scale) - d / scale
    keep, leave = np.log(stay), np.log1p(-stay)
    from_change = np.zeros(n, bool)
    a, b = same[0], leave
    for t in range(1, n):
        from_change[t] = b > a + keep + TIE
        a, b = max(a + keep, b) + same[t], a + leave
    out, change = [], b > a + TIE
    for t in range(n - 1, -1, -1):
        if change:
            out.append(t)
            change = False
        elif t:
            change = bool(from_change[t])
    return np.array(out[::-1], np.int64)


def _by_series(df: DataFrame, entity: str, columns: list[str], fn, schema: str) -> DataFrame:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > MAX_SERIES:
            raise ValueError(f"a series has more than {MAX_SERIES} rows")
        return fn(rows)

    return df.select(entity, *columns).groupBy(entity).applyInPandas(run, schema)


def viterbi_changes(df: DataFrame, *, entity: str, order: str, distance: str, stay: float = 0.97, least: float = 0.01) -> DataFrame:
    """(entity, order): rows at which the series changes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        return rows.iloc[change_points(rows[distance].to_numpy(np.float64), stay, least)][[entity, order]]

    kinds = dict(df.dtypes)
    return _by_series(df, entity, [order, distance], run, f"{entity} {kinds[entity]}, {order} {kinds[order]}")


def sections(series: DataFrame, changes: DataFrame, *, entity: str, order: str) -> DataFrame:
    """(entity, section, start, end): rows between changes, end excluded, by 0-based position; position 0 always starts one."""
    by = W.partitionBy(entity).orderBy(order)
    at = series.select(entity, order, (F.row_number().over(by) - 1).alias("pos")).join(changes.select(entity, order).withColumn("_c", F.lit(1)), [entity, order], "left")
    at = at.withColumn("section", F.sum(F.when((F.col("_c") == 1) & (F.col("pos") > 0), 1).otherwise(0)).over(by))
    return at.groupBy(entity, "section").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))


def drop_short(rows: DataFrame, *, entity: str, least: int) -> DataFrame:
    """Sections shorter than ``least`` go to the section before; the first stays."""
    by = W.partitionBy(entity).orderBy("start")
    long = (F.col("end") - F.col("start") >= least) | F.lag("start").over(by).isNull()
    grouped = rows.withColumn("_long", long).withColumn("_g", F.sum(F.when(F.col("_long"), 1).otherwise(0)).over(by))
    return grouped.groupBy(entity, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(entity, (F.col("_g") - 1).alias("section"), "start", "end")


def keyframes(series: DataFrame, rows: DataFrame, *, entity: str, order: str, ink: str) -> DataFrame:
    """(entity, section, keyframe): position of the most ink two rows inside the section, the first on ties; the middle of one under five rows."""
    pos = series.select(entity, (F.row_number().over(W.partitionBy(entity).orderBy(order)) - 1).alias("pos"), F.col(ink).alias("_ink"))
    member = rows.select(entity, "section", "start", "end", F.explode(F.sequence("start", F.col("end") - 1)).alias("pos")).join(pos, [entity, "pos"])
    inner = (F.col("pos") >= F.col("start") + 2) & (F.col("pos") < F.col("end") - 2)
    best = F.max(F.when(inner, F.struct("_ink", (-F.col("pos")).alias("m"))))
    return member.groupBy(entity, "section", "start", "end").agg(best.alias("b")).select(entity, "section", F.when(F.col("end") - F.col("start") < 5, F.floor((F.col("start") + F.col("end")) / 2)).otherwise(-F.col("b.m")).alias("keyframe"))


def merge_progressive(rows: DataFrame, *, entity: str, order: str, ink: str, ratio: float = 0.70) -> DataFrame:
    """(entity, first, last, n): runs of rows in which each holds at least ``ratio`` of the ink set that stands for the run.

    The set of most ink stands for a run, the first on ties. An empty set is held by any.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        out: list[list] = []
        held: set = set()
        for o, marks in zip(frame[order], frame[ink]):
            marks = set(marks if marks is not None else [])
            if out and (not held or len(held & marks) / len(held) >= ratio):
                out[-1][1], out[-1][2] = o, out[-1][2] + 1
                held = marks if len(marks) > len(held) else held
            else:
                out.append([o, o, 1])
                held = marks
        return pd.DataFrame({entity: frame[entity].iloc[0], "first": [x[0] for x in out], "last": [x[1] for x in out], "n": [x[2] for x in out]})

    kinds = dict(rows.dtypes)
    return _by_series(rows, entity, [order, ink], run, f"{entity} {kinds[entity]}, first {kinds[order]}, last {kinds[order]}, n int")


def key_position(sizes: np.ndarray, start: int, end: int) -> int:
    """The position that stands for [start, end): of the most ink two rows inside, the first on ties; the middle of a span under five rows."""
    if end - start < 5:
        return (start + end) // 2
    return start + 2 + int(np.argmax(sizes[start + 2 : end - 2]))


def merge_sections(rows: DataFrame, series: DataFrame, *, entity: str, order: str, ink: str, ratio: float = 0.70) -> DataFrame:
    """(entity, start, end, builds): sections (entity, section, start, end) of a series of ink sets, progressive ones merged.

    A section joins the one before if its key row holds at least ``ratio`` of that one's key ink.
    A merged section's key row is found anew over its whole span. An empty set is held by any.
    """
    joined = series.select(F.col(entity).alias("_e"), order, ink)
    kinds = dict(rows.dtypes)

    def run(sections_: pd.DataFrame, frames: pd.DataFrame) -> pd.DataFrame:
        if len(frames) > MAX_SERIES:
            raise ValueError(f"a series has more than {MAX_SERIES} rows")
        frames = frames.sort_values(order)
        marks = frames[ink].to_numpy()
        sizes = np.array([0 if m is None else len(m) for m in marks], np.int64)
        at = lambda span: set(marks[key_position(sizes, *span)]) if sizes[key_position(sizes, *span)] else set()
        out: list[list] = []
        for start, end in sorted(zip(sections_["start"], sections_["end"])):
            held = at(out[-1][:2]) if out else set()
            if out and (not held or len(held & at((start, end))) / len(held) >= ratio):
                out[-1][1], out[-1][2] = end, out[-1][2] + 1
            else:
                out.append([start, end, 1])
        return pd.DataFrame(out, columns=["start", "end", "builds"]).assign(**{entity: sections_[entity].iloc[0]})[[entity, "start", "end", "builds"]] if out else pd.DataFrame({entity: [], "start": [], "end": [], "builds": []})

    left = rows.select(entity, "start", "end").groupBy(entity)
    return left.cogroup(joined.groupBy("_e")).applyInPandas(run, f"{entity} {kinds[entity]}, start int, end int, builds int")


def peaks(df: DataFrame, *, entity: str, order: str, value: str, threshold: Column) -> DataFrame:
    """(entity, order): the greatest row of each run at or above the threshold, the first on ties; an entity's first row starts none."""
    by = W.partitionBy(entity).orderBy(order)
    x = df.select(entity, order, value, threshold.alias("_t")).withColumn("_high", (F.col(value) >= F.col("_t")) & F.lag(order).over(by).isNotNull())
    x = x.withColumn("_run", F.sum(F.when(F.col("_high") & ~F.coalesce(F.lag("_high").over(by), F.lit(False)), 1).otherwise(0)).over(by))
    best = x.filter("_high").withColumn("_n", F.row_number().over(W.partitionBy(entity, "_run").orderBy(F.col(value).desc(), order)))
    return best.filter("_n = 1").select(entity, order)


def propose_boundaries(df: DataFrame, *, entity: str, order: str, distance: str, quantile: float = 0.92, gap: int = 30, skip: int = 3, rounds: int = 8) -> DataFrame:
    """(entity, order): peaks over the quantile, then the greatest rows inside gaps longer than ``gap``, ``skip`` from their ends, for at most ``rounds`` rounds."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        d = rows[distance].to_numpy(np.float64)
        high = d >= np.quantile(d, quantile)
        high[0] = False
        found, i = set(), 0
        while i < len(d):
            if high[i]:
                j = i
                while j < len(d) and high[j]:
                    j += 1
                found.add(i + int(np.argmax(d[i:j])))
                i = j
            else:
                i += 1
        for _ in range(rounds):
            edges, new = [0, *sorted(found), len(d)], set()
            for a, b in zip(edges, edges[1:]):
                if b - a > gap and b - skip > a + skip:
                    new.add(a + skip + int(np.argmax(d[a + skip : b - skip])))
            if new <= found:
                break
            found |= new
        return rows.iloc[sorted(found)][[entity, order]]

    kinds = dict(df.dtypes)
    return _by_series(df, entity, [order, distance], run, f"{entity} {kinds[entity]}, {order} {kinds[order]}")


def runs(df: DataFrame, *, entity: str, order: str, distance: str, quantile: float, least: int) -> DataFrame:
    """(entity, run, first, last, n): split where order jumps or the distance reaches the quantile; contiguous runs under ``least`` rows join the run before."""
    by = W.partitionBy(entity).orderBy(order)
    cut = df.groupBy(entity).agg(F.percentile(distance, quantile).alias("_q"))
    x = df.select(entity, order, distance).join(cut, entity)
    x = x.withColumn("_jump", F.coalesce(F.col(order) - F.lag(order).over(by) > 1, F.lit(True))).withColumn("_new", F.when(F.col("_jump") | (F.col(distance) >= F.col("_q")), 1).otherwise(0))
    x = x.withColumn("_run", F.sum("_new").over(by))
    y = x.groupBy(entity, "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"), F.max(F.struct((-F.col(order)).alias("o"), "_jump"))["_jump"].alias("_jump"))
    keep = F.when(F.col("_jump") | (F.col("n") >= least), 1).otherwise(0)
    y = y.withColumn("run", F.sum(keep).over(W.partitionBy(entity).orderBy("_run")))
    return y.groupBy(entity, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))


def otsu_threshold(df: DataFrame, *, entity: str, value: str, bins: int = 256) -> DataFrame:
    """(entity, cut): Otsu's threshold over the values scaled by their greatest one; 0 where that isn't positive. The first best bin counts."""
    top = df.groupBy(entity).agg(F.max(value).alias("_top"))
    b = df.select(entity, value).filter(F.col(value).isNotNull()).join(top, entity).filter("_top > 0")
    b = b.groupBy(entity, "_top", F.least(F.greatest(F.floor(F.col(value) / F.col("_top") * (bins - 1)), F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    up, whole = W.partitionBy(entity).orderBy("bin"), W.partitionBy(entity)
    n, s = F.col("n"), F.col("n") * F.col("bin")
    b = b.select("*", F.sum(n).over(up).alias("w0"), F.sum(s).over(up).alias("s0"), F.sum(n).over(whole).alias("w"), F.sum(s).over(whole).alias("s"))
    w1 = F.col("w") - F.col("w0")
    difference = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / F.nullif(w1, F.lit(0))
    between = F.coalesce(F.round(F.col("w0") * w1 * difference * difference / F.col("w") / F.col("w"), 9), F.lit(0.0))
    best = b.withColumn("_v", between).groupBy(entity, "_top").agg(F.max(F.struct("_v", (-F.col("bin")).alias("m"))).alias("best"))
    return top.join(best.select(entity, (-F.col("best.m") / (bins - 1) * F.col("_top")).alias("cut")), entity, "left").select(entity, F.coalesce("cut", F.lit(0.0)).alias("cut"))


def series_profile(df: DataFrame, *, entity: str, value: str) -> DataFrame:
    """Per entity: n, Otsu cut, share above it, p99/p1 separation of both sides, values in between, outliers of the lower side (over 8 median deviations, above ten rows)."""
    x = df.select(entity, F.col(value).alias("_v")).filter("_v IS NOT NULL").join(otsu_threshold(df, entity=entity, value=value), entity).withColumn("_hi", F.col("_v") > F.col("cut"))
    low, high = F.when(~F.col("_hi"), F.col("_v")), F.when(F.col("_hi"), F.col("_v"))
    stats = x.groupBy(entity, "cut").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("_hi").cast("double")).alias("high_ratio"), F.percentile(low, 0.99).alias("_p99"), F.percentile(high, 0.01).alias("_p1"), F.median(low).alias("_med"), F.count(low).alias("_low"))
    y = x.join(stats.select(entity, "_p99", "_med", "_low"), entity)
    mads = y.filter(~F.col("_hi")).groupBy(entity).agg(F.median(F.abs(F.col("_v") - F.col("_med"))).alias("_mad"))
    y = y.join(mads, entity, "left").withColumn("_scale", F.when(F.col("_mad") > 0, F.col("_mad")).otherwise(1e-6))
    odd = (F.col("_low") > 10) & ~F.col("_hi") & ((F.col("_v") - F.col("_med")) / F.col("_scale") > 8.0)
    counts = y.groupBy(entity).agg(F.count_if((F.col("_v") > F.col("_p99")) & ~F.col("_hi")).alias("between"), F.count_if(odd).alias("outliers"))
    separation = F.when(F.col("_p99") > 0, F.coalesce(F.col("_p1") / F.col("_p99"), F.lit(0.0))).otherwise(0.0)
    return stats.join(counts, entity).select(entity, "n", "cut", "high_ratio", separation.alias("separation"), "between", "outliers")


def median_vectors(df: DataFrame, *, entity: str, order: str, vector: str, stride: int = 1) -> DataFrame:
    """(entity, median): element-wise median of every ``stride``-th vector of an entity, the first one included. Vectors of another length than the entity's longest have no say beyond theirs."""
    numbered = df.select(entity, vector, (F.row_number().over(W.partitionBy(entity).orderBy(order)) - 1).alias("_i")).filter(F.col("_i") % stride == 0)
    parts = numbered.select(entity, F.posexplode(vector).alias("_p", "_x")).groupBy(entity, "_p").agg(F.median(F.col("_x").cast("double")).alias("_m"))
    return parts.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_m"))), lambda x: x["_m"]).alias("median"))


def median_distances(df: DataFrame, medians: DataFrame, *, entity: str, vector: str, scale: float = 1.0) -> DataFrame:
    """Rows with ``distance``: the mean absolute difference to the entity's median, divided by ``scale``; null where the lengths differ."""
    from .grouping import mean_abs_difference

    return df.join(medians, entity, "left").withColumn("distance", mean_abs_difference(F.col(vector), F.col("median")) / scale).drop("median")
