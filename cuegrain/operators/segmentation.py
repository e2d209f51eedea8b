"""Topic segmentation of timed text and its measures."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import text as T
from ..session import cut
from .intervals import asof, overlaps


def _packed(lengths: np.ndarray, least: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(totals after, blocks closed) of a run of lengths for every total before it; a total that reaches ``least`` closes its block."""
    total, closed = state.copy(), np.zeros(len(state), np.int64)
    for n in lengths.tolist():
        total += n
        full = total >= least
        closed += full
        total[full] = 0
    return total, closed


def _numbers(lengths: np.ndarray, least: int, total: int, block: int) -> np.ndarray:
    """The block of every length, from a total and a block number at the start."""
    out = np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        out[i] = block
        total += n
        if total >= least:
            total, block = 0, block + 1
    return out


def blocks(cues: DataFrame, *, entity: str, order: str, time: str, text: str, least: int) -> DataFrame:
    """(entity, block, t, text): cues in order, joined until a block has ``least`` characters; the rest is a block too.

    Where a block ends depends on all cues before it. Cues are laid out by ranges of (entity, order), so
    that a long entity lies in several stretches. A stretch is first worked out for every total it may
    begin with (fewer than ``least``), then the stretches' few results are carried along an
    entity, and each stretch numbers its cues from what it really begins with.
    """
    laid = cues.select(F.col(entity).alias("e"), F.col(order).alias("o"), F.col(time).alias("t"), F.coalesce(text, F.lit("")).alias("x")).repartitionByRange("e", "o")
    laid = cut(laid.withColumn("stretch", F.spark_partition_id()), "laid")
    kinds = dict(laid.dtypes)
    lengths = laid.select("e", "stretch", "o", F.length("x").alias("n"))

    def work_out(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("o")
        total, closed = _packed(rows["n"].to_numpy(), least, np.arange(max(least, 1)))
        return pd.DataFrame({"e": rows["e"].iloc[:1].astype(object), "stretch": rows["stretch"].iloc[:1], "total": [total], "closed": [closed]})

    def carry(rows: pd.DataFrame) -> pd.DataFrame:
        total = block = 0
        starts = []
        for after, closed in zip(*(rows.sort_values("stretch")[c] for c in ("total", "closed"))):
            starts.append((total, block))
            total, block = int(after[total]), block + int(closed[total])
        return pd.DataFrame({"e": rows["e"].astype(object), "stretch": sorted(rows["stretch"]), "total0": [t for t, _ in starts], "block0": [b for _, b in starts]})

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("o")
        found = _numbers(rows["n"].to_numpy(), least, int(rows["total0"].iloc[0]), int(rows["block0"].iloc[0]))
        return pd.DataFrame({"e": rows["e"].astype(object), "o": rows["o"], "block": found.astype("int32")})

    worked = lengths.groupBy("e", "stretch").applyInPandas(work_out, f"e {kinds['e']}, stretch int, total array<bigint>, closed array<bigint>")
    starts = worked.groupBy("e").applyInPandas(carry, f"e {kinds['e']}, stretch int, total0 bigint, block0 bigint")
    numbered = lengths.join(starts, ["e", "stretch"]).groupBy("e", "stretch").applyInPandas(number, f"e {kinds['e']}, o {kinds['o']}, block int")
    parts = laid.join(numbered, ["e", "o"]).groupBy("e", "block").agg(F.array_sort(F.collect_list(F.struct("o", "x"))).alias("p"), F.min_by("t", "o").alias("t"))
    return parts.select(F.col("e").alias(entity), "block", "t", F.array_join(F.transform("p", lambda x: x["x"]), "").alias("text"))


#: Neighbouring blocks that are scored together, and blocks that one task's group should hold.
RANGE, BLOCKS_PER_SHARD = 64, 20_000


def _grams(text: str, n: int) -> np.ndarray:
    cps = np.frombuffer("".join((text or "").split()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(cps) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(cps) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x110000) + cps[i : i + len(out)]
    return out


def _gap_sums(window: int, n: int):
    def run(table: pa.Table) -> pa.Table:
        entity = table["entity"].combine_chunks()
        code = entity.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        part, block = table["part"].to_numpy(), table["block"].to_numpy()
        order = np.lexsort((block, part, code))
        texts = table["text"].to_pylist()
        edges = np.flatnonzero(np.diff(code[order]) | np.diff(part[order])) + 1
        rows, sums = [], []
        for group in np.split(order, edges):
            grams = [_grams(texts[r], n) for r in group]
            _, ids = np.unique(np.concatenate(grams), return_inverse=True)
            where = np.repeat(np.arange(len(group)), [len(g) for g in grams])
            width = int(ids.max(initial=-1)) + 1
            running = np.zeros((len(group) + 1, width), np.int64)
            np.add.at(running, (where + 1, ids), 1)
            running = running.cumsum(0)
            own = np.flatnonzero((block[group] // RANGE == part[group]) & (np.arange(len(group)) < len(group) - 1))
            left = running[own + 1] - running[np.maximum(own + 1 - window, 0)]
            right = running[np.minimum(own + 1 + window, len(group))] - running[own + 1]
            rows.append(group[own])
            sums.append(np.stack([(left * right).sum(1), (left * left).sum(1), (right * right).sum(1)]))
        at = np.concatenate(rows)
        ab, aa, bb = np.concatenate(sums, axis=1)
        return pa.table({"entity": entity.take(pa.array(at)), "i": pa.array(block[at], pa.int32()), "ab": ab, "aa": aa, "bb": bb})

    return run


def gap_scores(block_rows: DataFrame, *, entity: str, window: int, n: int = 2) -> DataFrame:
    """(entity, i, t_next, score): cosine of the n-gram counts of up to ``window`` blocks left of and right of each gap; n is at most 3.

    A sum of counts has the same cosine as their mean. Blocks, numbered without gaps, go to ranges of
    neighbours with a margin of ``window``, and ranges by hash to shards, so that an entity that
    holds much of the data is spread; counts are exact integers.
    """
    blocks_ = cut(block_rows.select(entity, "block", "t", "text"), "blocks")
    shards = max(int(blocks_.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks_.count() // BLOCKS_PER_SHARD))
    b = F.col("block")
    parts = F.explode(F.sequence(F.greatest(F.floor((b - window) / RANGE), F.lit(0)), F.floor((b + window) / RANGE)))
    spread = blocks_.select(F.col(entity).alias("entity"), b.cast("bigint").alias("block"), "text", parts.alias("part"))
    spread = spread.withColumn("shard", F.pmod(F.xxhash64("entity", "part"), F.lit(shards)).cast("int"))
    sums = spread.groupBy("shard").applyInArrow(_gap_sums(window, n), f"entity {dict(spread.dtypes)['entity']}, i int, ab bigint, aa bigint, bb bigint").withColumnRenamed("entity", entity)
    gaps = blocks_.select(entity, b.alias("i"), F.lead("t").over(W.partitionBy(entity).orderBy("block")).alias("t_next")).filter("t_next IS NOT NULL")
    cosine = F.when((F.col("aa") > 0) & (F.col("bb") > 0), F.round(F.col("ab") / F.sqrt(F.col("aa").cast("double") * F.col("bb")), 9)).otherwise(0.0)
    return gaps.join(sums, [entity, "i"], "left").select(entity, "i", "t_next", F.coalesce(cosine, F.lit(0.0)).alias("score"))


def depth_cuts(scores: DataFrame, *, entity: str, order: str, score: str, alpha: float) -> DataFrame:
    """Rows of ``scores`` that are cuts, with their ``depth``: valleys deeper than mean + alpha * population deviation.

    Depth is the rise to the peak that an unbroken climb reaches on either side; it
    comes from window functions alone. Entities with fewer than three scores have none.
    """
    up, down = W.partitionBy(entity).orderBy(order), W.partitionBy(entity).orderBy(F.col(order).desc())
    s = F.col(score)
    x = scores.withColumn("_l", F.sum(F.when(F.lag(s).over(up) < s, 1).otherwise(0)).over(up)).withColumn("_r", F.sum(F.when(F.lag(s).over(down) < s, 1).otherwise(0)).over(down))
    x = x.withColumn("_left", F.max(s).over(W.partitionBy(entity, "_l"))).withColumn("_right", F.max(s).over(W.partitionBy(entity, "_r")))
    x = x.withColumn("depth", F.round(F.col("_left") - s + F.col("_right") - s, 9))
    whole = W.partitionBy(entity)
    d = F.col("depth")
    x = x.withColumn("_cut", F.round(F.avg(d).over(whole) + alpha * F.stddev_pop(d).over(whole), 9)).withColumn("_p", F.lag(d).over(up)).withColumn("_n", F.lead(d).over(up))
    return x.filter((d > F.col("_cut")) & (d >= F.col("_p")) & (d >= F.col("_n"))).select(*scores.columns, "depth")


def topic_boundaries(cues: DataFrame, *, entity: str, order: str, time: str, text: str, block_chars: int = 40, window: int = 3, alpha: float = 0.75) -> DataFrame:
    """(entity, t): starts of topics. Entities with fewer than four blocks have none."""
    b = blocks(cues, entity=entity, order=order, time=time, text=text, least=block_chars)
    b = b.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(entity))).filter("_n >= 4").drop("_n")
    return depth_cuts(gap_scores(b, entity=entity, window=window), entity=entity, order="i", score="score", alpha=alpha).select(entity, F.col("t_next").alias("t"))


def keep_min_length(boundaries: Column, duration: Column, least: float) -> Column:
    """Greedy: a boundary is kept if it's ``least`` after the one kept before and before the end."""
    zero = F.struct(F.lit(0.0).alias("last"), F.array().cast("array<double>").alias("out"))

    def step(state: Column, t: Column) -> Column:
        keep = (t - state["last"] >= least) & (duration - t >= least)
        return F.struct(F.when(keep, t).otherwise(state["last"]).alias("last"), F.when(keep, F.concat(state["out"], F.array(t))).otherwise(state["out"]).alias("out"))

    return F.aggregate(F.array_sort(boundaries), zero, step, lambda s: s["out"])


def uniform_cuts(count: Column, end: Column) -> Column:
    """``count`` equally spaced cuts inside (0, end)."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: end * i / (count + 1))).otherwise(F.array().cast("array<double>"))


def fixed_cuts(period: float, end: Column) -> Column:
    """Cuts at every multiple of ``period`` below the end."""
    n = F.ceil(end / period).cast("int") - 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i * F.lit(period))).otherwise(F.array().cast("array<double>"))


def boundary_flags(units: DataFrame, cuts: DataFrame, *, entity: str, unit: str, start: str, cut: str) -> DataFrame:
    """(entity, unit, flag): 1 for the unit that holds a cut, unless it's the entity's last one.

    A cut lies in the last unit that starts at or before it.
    """
    u = units.select(entity, unit, start)
    hit = asof(cuts.select(entity, F.col(cut).alias("_cut")).distinct(), u, entity=entity, time="_cut", mark_time=start, value=[unit]).select(entity, unit).filter(F.col(unit).isNotNull()).distinct().withColumn("_hit", F.lit(1))
    last = F.lead(unit).over(W.partitionBy(entity).orderBy(start, unit)).isNull()
    return u.withColumn("_last", last).join(hit, [entity, unit], "left").select(entity, unit, F.when(F.col("_last"), 0).otherwise(F.coalesce("_hit", F.lit(0))).alias("flag"))


def default_window(units: Column, boundaries: Column) -> Column:
    """Half the mean segment length in units, half-even rounded, at least 1."""
    return F.greatest(F.lit(1), F.bround(units / (boundaries + 1) / 2).cast("int"))


def window_diff(reference: Column, hypothesis: Column, k: Column, weighted: bool = False) -> Column:
    """WindowDiff of two flag arrays of one length: share of the n-k+1 windows whose counts differ.

    weighted sums the differences. Null where the lengths differ or k isn't in 1..n.
    Prefix sums make it linear.
    """
    return _window_diff(reference, hypothesis, k, F.lit(weighted))


@F.pandas_udf(DoubleType())
def _window_diff(reference: pd.Series, hypothesis: pd.Series, k: pd.Series, weighted: pd.Series) -> pd.Series:
    out: list[float | None] = []
    for a, b, size, sums in zip(reference, hypothesis, k, weighted):
        if a is None or b is None or size is None or len(a) != len(b) or not 1 <= size <= len(a):
            out.append(None)
            continue
        # Differences first, so that one array of prefix sums is enough.
        total = np.concatenate([[0], np.cumsum(np.nan_to_num(np.asarray(a, float)) - np.nan_to_num(np.asarray(b, float)))])
        gaps = np.abs(total[int(size) :] - total[: -int(size)])
        out.append(float(gaps.sum() if sums else (gaps > 0).sum()) / len(gaps))
    return pd.Series(out, dtype=object)


def boundary_matches(predicted: DataFrame, truth: DataFrame, *, entity: str, time: str, tolerance: float) -> DataFrame:
    """(entity, p, g): one-to-one pairs within ``tolerance``, greedily by difference, then by order of the predicted and of the true.

    Only pairs within the tolerance are formed. Greedy choice is by runs: pairs more than the
    tolerance apart can't compete, so each run of neighbouring times is settled by itself.
    """
    number = W.partitionBy(entity).orderBy(time)
    p = predicted.select(entity, time).filter(F.col(time).isNotNull()).withColumn("pi", F.row_number().over(number)).withColumnRenamed(time, "p")
    g = truth.select(entity, time).filter(F.col(time).isNotNull()).withColumn("gi", F.row_number().over(number)).withColumnRenamed(time, "g")
    pairs = overlaps(p, g, entity=entity, a_span=("p", "p"), b_span=("g", "g"), pad=tolerance * (1 + 1e-9)).withColumn("d", F.abs(F.col("p") - F.col("g"))).filter(F.col("d") <= tolerance).drop("overlap")
    order = W.partitionBy(entity).orderBy("p", "g")
    runs = pairs.withColumn("run", F.sum(F.when(F.col("p") - F.lag("p").over(order) <= 2 * tolerance, 0).otherwise(1)).over(order))

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["d", "pi", "gi"])
        used_p, used_g, keep = set(), set(), []
        for i, (pi, gi) in enumerate(zip(rows["pi"], rows["gi"])):
            if pi not in used_p and gi not in used_g:
                used_p.add(pi)
                used_g.add(gi)
                keep.append(i)
        return rows.iloc[keep][[entity, "p", "g"]]

    return runs.groupBy(entity, "run").applyInPandas(settle, f"{entity} {dict(p.dtypes)[entity]}, p double, g double")


def boundary_scores(predicted: DataFrame, truth: DataFrame, *, entity: str, time: str, tolerance: float) -> DataFrame:
    """(entity, tp, fp, fn, precision, recall, f1) of every entity with a boundary of either kind."""
    pairs = boundary_matches(predicted, truth, entity=entity, time=time, tolerance=tolerance)
    count = lambda df, name: df.filter(F.col(time).isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias(name))
    x = count(predicted, "np").join(count(truth, "ng"), entity, "full_outer").join(pairs.groupBy(entity).agg(F.count(F.lit(1)).alias("tp")), entity, "left").fillna(0)
    x = x.withColumn("precision", F.when(F.col("np") > 0, F.col("tp") / F.col("np")).otherwise(F.when(F.col("ng") == 0, 1.0).otherwise(0.0)))
    x = x.withColumn("recall", F.when(F.col("ng") > 0, F.col("tp") / F.col("ng")).otherwise(F.when(F.col("np") == 0, 1.0).otherwise(0.0)))
    both = F.col("precision") + F.col("recall")
    return x.select(entity, "tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("ng") - F.col("tp")).alias("fn"), "precision", "recall", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0).alias("f1"))


def merge_accuracy(found: DataFrame, wanted: DataFrame, *, entity: str, predicted: str, true: str) -> DataFrame:
    """(n, accuracy): share of the entities in both tables whose counts are equal."""
    both = found.select(entity, predicted).join(wanted.select(entity, true), entity)
    return both.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col(predicted) == F.col(true)).cast("int")), 9).alias("accuracy"))


def tolerance_coverage(tolerance: float, count: Column, lo: Column, hi: Column) -> Column:
    """Share of [lo, hi] that lies within the tolerance of ``count`` cuts, at most 1; 1 for an empty span."""
    return F.when(hi <= lo, 1.0).otherwise(F.least(F.lit(1.0), 2 * tolerance * count / (hi - lo)))


#: Blocks that a segment may span: at 40 characters each several hours of speech.
LONGEST_SEGMENT = 1_000


def dp_segments(texts: list[str], prior: float, candidates: list[int] | None = None, n: int = 2, longest: int = LONGEST_SEGMENT) -> list[int]:
    """Cuts (indices into texts) with the least description length, the earliest of equal ones.

    A segment costs the code length of its n-grams under add-one smoothed frequencies
    over the whole vocabulary, plus ``prior``; it spans at most ``longest`` texts, or one step between
    candidates. candidates: cuts that are allowed; default all. What a step adds to the open segments
    changes only where one of its n-grams occurs, so all of them grow at once, by sums over earlier
    occurrences. Costs are whole multiples of a small unit: equal ones stay equal in whatever order they are added up.
    """
    if len(texts) < 2:
        return []
    nodes = np.array(sorted({0, len(texts), *(c for c in (candidates if candidates is not None else range(1, len(texts))) if 0 < c < len(texts))}), np.int64)
    steps, ids = len(nodes) - 1, {}

    def grams(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram, step) of all n-grams of the steps from a to b."""
        part = texts[nodes[a] : nodes[b]]
        owner = np.repeat(np.arange(len(part)), [len(t) for t in part])
        cps = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        code = np.zeros(max(len(cps) - n + 1, 0), np.int64)
        inside = owner[: len(code)] == owner[n - 1 :]
        if n <= 3:
            for i in range(n):
                code = (code << 21) | cps[i : i + len(code)]
            code = code[inside]
        else:
            code = np.array([ids.setdefault(t[i : i + n], len(ids)) for t in part for i in range(len(t) - n + 1)], np.int64)
        return code, np.searchsorted(nodes, nodes[a] + owner[: len(inside)][inside], "right") - 1

    lot = 2 * max(longest, 500)
    lots = [(s, min(s + lot, steps)) for s in range(0, steps, lot)]
    vocabulary, totals = np.zeros(0, np.int64), np.zeros(steps + 1, np.int64)
    for s, e in lots:
        code, step = grams(s, e)
        vocabulary = np.union1d(vocabulary, code)
        totals[s + 1 : e + 1] = np.bincount(step - s, minlength=e - s)
    k, totals = max(len(vocabulary), 1), np.cumsum(totals)
    low = np.minimum(np.searchsorted(nodes, nodes[1:] - longest), np.arange(steps))  # where a segment to the end of a step may begin
    most, whole = int((totals[1:] - totals[low]).max()), int(totals[-1])
    room = lambda bits, x: bits - int(np.ceil(np.log2(2 + x)))
    unit = 2.0 ** min(30, room(61, whole * np.log(whole + k) + abs(prior) * steps), room(51, most * np.log(most + k) + most))
    weight = np.rint(np.arange(most + 2) * np.log(np.arange(most + 2) + 1.0) * unit).astype(np.int64)
    best, back, held, fixed = np.zeros(steps + 1, np.int64), np.zeros(steps + 1, np.int64), np.zeros(steps, np.int64), int(round(prior * unit))
    for s, e in lots:
        code, step = grams(int(low[s]), e)
        _, code = np.unique(code, return_inverse=True)
        keys, times = np.unique(code.reshape(-1) * (steps + 1) + step, return_counts=True)  # by n-gram, then by step
        at = keys % (steps + 1)
        before = np.concatenate([[0], np.cumsum(times)])
        first = np.searchsorted(keys, keys - at + low[at]) if len(at) else at
        order = np.argsort(at, kind="stable")
        bounds = np.searchsorted(at[order], np.arange(s, e + 1))
        for b in range(s + 1, e + 1):
            own, lo = order[bounds[b - 1 - s] : bounds[b - s]], low[b - 1]
            if len(own):
                count = own - first[own] + 1
                ends = np.cumsum(count)
                i = np.arange(ends[-1]) + np.repeat(first[own] - ends + count, count)
                had = np.repeat(before[own], count) - before[i]
                more = weight[had + np.repeat(times[own], count)] - weight[had]
                last = more[ends - 1]
                more[:-1] -= more[1:]
                more[ends - 1] = last
                held[lo:b] += np.cumsum(np.bincount(at[i] - lo, weights=more, minlength=b - lo)[::-1])[::-1].astype(np.int64)
            total = totals[b] - totals[lo:b]
            offer = best[lo:b] - held[lo:b] + np.rint(total * np.log(total + k) * unit).astype(np.int64) + fixed
            i = int(np.argmin(offer))
            best[b], back[b] = offer[i], lo + i
    path, at = [], int(back[-1])
    while at:
        path.append(int(nodes[at]))
        at = int(back[at])
    return path[::-1]


def description_length_cuts(block_rows: DataFrame, *, entity: str, prior: float, candidates: DataFrame | None = None) -> DataFrame:
    """(entity, cut): least-cost cuts between blocks, an entity at a time; its blocks by :data:`LONGEST_SEGMENT` costs are looked at.

    candidates (entity, cut): where cuts are allowed; default everywhere.
    """
    kinds = dict(block_rows.dtypes)
    schema = f"{entity} {kinds[entity]}, cut int"

    def cuts(rows: pd.DataFrame, allowed: list[int] | None) -> pd.DataFrame:
        rows = rows.sort_values("block")
        found = dp_segments(["".join(t.split()) for t in rows["text"]], prior, allowed)
        return pd.DataFrame({entity: pd.Series([rows[entity].iloc[0]] * len(found), dtype=object), "cut": pd.Series(found, dtype="int32")})

    whole = block_rows.select(entity, "block", "text").groupBy(entity)
    if candidates is None:
        return whole.applyInPandas(lambda rows: cuts(rows, None), schema)
    allowed = candidates.select(F.col(entity).alias("_e"), "cut").groupBy("_e")
    return whole.cogroup(allowed).applyInPandas(lambda rows, at: cuts(rows, at["cut"].tolist()) if len(rows) else pd.DataFrame({entity: pd.Series([], dtype=object), "cut": pd.Series([], dtype="int32")}), schema)
