"""Series-level surveys of profiles, model results as tables, and small row operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .grouping import mean_abs_difference
from .intervals import overlaps

# Limits of a survey.
BASELINE, DEVIATION, DRIFT, MARGIN = 0.811, 0.20, 0.06, 0.05
SEPARATION, DENSITY, MIDBAND = 3.0, 3.0, 0.15


def single_mode(ratio: Column) -> Column:
    """Whether nearly all or nearly none is above the cut."""
    return (ratio < MARGIN) | (ratio > 1 - MARGIN)


def series_baseline(profiles: DataFrame, *, series: str, ratio: str) -> DataFrame:
    """(series, baseline): mean of 1 - ratio over a series' profiles; a series without any has :data:`BASELINE`."""
    return profiles.groupBy(series).agg(F.coalesce(F.avg(1 - F.col(ratio)), F.lit(BASELINE)).alias("baseline"))


def mismatches(profiles: DataFrame, *, series: str) -> DataFrame:
    """(series, problem, value): least separation of two-mode profiles, greatest density, mean share in between, where beyond the limits. Profiles have ratio, separation, density, midband."""
    x = profiles.groupBy(series).agg(F.min(F.when(~single_mode(F.col("ratio")), F.col("separation"))).alias("_sep"), F.max("density").alias("_den"), F.avg("midband").alias("_mid"))
    problem = lambda name, value, bad: F.when(bad, F.struct(F.lit(name).alias("problem"), F.round(value, 6).alias("value")))
    found = F.array(problem("separation", F.col("_sep"), F.col("_sep") < SEPARATION), problem("density", F.col("_den"), F.col("_den") > DENSITY), problem("midband", F.col("_mid"), F.col("_mid") > MIDBAND))
    return x.select(series, F.explode(F.filter(found, lambda p: p.isNotNull())).alias("_p")).select(series, "_p.*")


def deviations(profiles: DataFrame, baselines: DataFrame, *, series: str, ratio: str) -> DataFrame:
    """(series, mean, baseline): series whose mean of 1 - ratio is more than :data:`DEVIATION` off."""
    x = profiles.groupBy(series).agg(F.avg(1 - F.col(ratio)).alias("mean")).join(baselines, series, "left").withColumn("baseline", F.coalesce("baseline", F.lit(BASELINE)))
    return x.filter(F.abs(F.col("mean") - F.col("baseline")) > DEVIATION)


def background_drift(profiles: DataFrame, *, group: str, key: str, order: str, fingerprint: str) -> DataFrame:
    """(key, nearest, distance): profiles that differ by at least :data:`DRIFT` from every earlier one of their group.

    A group is a series, whose episodes are few; each profile meets the earlier ones of its own series.
    """
    a = profiles.select(group, F.col(key).alias("key"), F.col(order).alias("_o"), F.col(fingerprint).alias("_f"))
    b = a.select(group, F.col("key").alias("nearest"), F.col("_o").alias("_o2"), F.col("_f").alias("_f2"))
    pairs = a.join(b, group).filter("_o2 < _o").withColumn("distance", mean_abs_difference(F.col("_f"), F.col("_f2"))).filter("distance IS NOT NULL")
    best = pairs.groupBy("key").agg(F.min(F.struct("distance", "nearest")).alias("b"))
    return best.select(F.col("key").alias(key), "b.nearest", "b.distance").filter(F.col("distance") >= DRIFT)


def outcome_counts(targets: DataFrame, *, skipped: DataFrame, key: str, outcome: str) -> DataFrame:
    """(outcome, n): targets by outcome; those on the skip list count as known_skip."""
    skip = skipped.select(key).distinct().withColumn("_s", F.lit(True))
    return targets.join(skip, key, "left").groupBy(F.when(F.col("_s"), "known_skip").otherwise(F.coalesce(outcome, F.lit("failed"))).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def exit_code(outcomes: DataFrame) -> int:
    """1 where there were targets and none succeeded, else 0. outcomes (outcome, n): a few rows."""
    counts = {r["outcome"]: r["n"] for r in outcomes.collect()}
    asked = sum(n for outcome, n in counts.items() if outcome != "known_skip")
    return int(asked > 0 and not counts.get("succeeded"))


def manifest_differences(now: DataFrame, then: DataFrame, *, key: str) -> DataFrame:
    """(key, field, now, then): cells of two manifests that differ; a key that one lacks differs in every field."""
    fields = [c for c in now.columns if c != key]
    cells = lambda df, name: df.select(key, F.explode(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.col(c).cast("string") for c in fields]))).alias("field", name))
    both = cells(now, "now").join(cells(then, "then"), [key, "field"], "full_outer")
    return both.filter(~F.col("now").eqNullSafe(F.col("then")))


def label_agreement(rows: DataFrame, *, groups: list[str], own: str, other: str) -> DataFrame:
    """Per group: n, mean of both measures, and the share in which the other one is greater."""
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(own), 6).alias("own"), F.round(F.avg(other), 6).alias("other"), F.round(F.avg((F.col(other) > F.col(own)).cast("int")), 6).alias("other_fits_better"))


def barren(segments: DataFrame, *, entity: str, blocks: str, share: float = 0.3, least: int = 5) -> DataFrame:
    """(entity, n, ratio): entities of at least ``least`` segments of which more than ``share`` have no block."""
    x = segments.groupBy(entity).agg(F.count(F.lit(1)).alias("n"), F.avg((F.coalesce(blocks, F.lit(0)) == 0).cast("int")).alias("ratio"))
    return x.filter((F.col("n") >= least) & (F.col("ratio") > share))


#: Claims of a key that travel with a text at once, and characters that are searched together.
CLAIMS_AT_ONCE, TEXT_CHARS = 500, 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets)."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def supports(texts: list[str], groups: np.ndarray, claims: list[str], claim_groups: np.ndarray) -> np.ndarray:
    """For every claim, none empty and none twice, the number of texts of its group that contain it.

    Hashes of all places grow by one character at a time together with those of the claims. From the third
    character on only places go on that begin like a claim of their group; what is found by its hash is
    compared character by character.
    """
    cps, at = _codes(texts)
    said, said_at = _codes(claims)
    sizes, owner = np.diff(said_at), np.repeat(np.arange(len(texts)), np.diff(at))
    grow = lambda h, c: (x := (h ^ (c.astype(np.uint64) + np.uint64(1))) * _ODD) ^ (x >> np.uint64(29))
    start = lambda g: (g.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    place, h = np.arange(len(cps)), start(groups)[owner]
    mine, own = np.arange(len(claims)), start(claim_groups)
    found = [np.zeros(0, np.int64)]
    for n in range(1, int(sizes.max(initial=0)) + 1):
        fits, longer = place + n <= at[1:][owner[place]], sizes[mine] >= n
        place, mine = place[fits], mine[longer]
        h, own = grow(h[fits], cps[place + n - 1]), grow(own[longer], said[said_at[mine] + n - 1])
        if n == min(3, sizes.min()):
            begun = np.zeros(1 << 22, bool)
            begun[own >> np.uint64(42)] = True
            near = begun[h >> np.uint64(42)]
            place, h = place[near], h[near]
        whole = sizes[mine] == n
        if whole.any() and len(place):
            order = np.argsort(own[whole])
            known, which = own[whole][order], mine[whole][order]
            k = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[k] == h
            i, c = place[hit], which[k[hit]]
            same = np.ones(len(i), bool)
            for x in range(n):
                same &= cps[i + x] == said[said_at[c] + x]
            found.append(np.unique(owner[i[same]] * len(claims) + c[same]))
    return np.bincount(np.concatenate(found) % max(len(claims), 1), minlength=len(claims))


def claim_support(claims: DataFrame, texts: DataFrame, *, key: str, claim: str, text: str) -> DataFrame:
    """(key, claim, n): number of texts of the key that contain the claim.

    Each text meets the claims of its key as lists of at most :data:`CLAIMS_AT_ONCE`, and a batch of texts is searched for
    all of them in one pass. Nothing is made of a text but its counts. Empty claims have no text.
    """
    kinds = dict(claims.dtypes)
    own = claims.select(F.col(key).alias("k"), F.col(claim).alias("claim")).filter(F.col(key).isNotNull() & (F.length(claim) > 0)).distinct()
    own = own.withColumn("part", F.floor((F.row_number().over(W.partitionBy("k").orderBy("claim")) - 1) / CLAIMS_AT_ONCE).cast("int"))
    lists = own.groupBy("k", "part").agg(F.collect_list("claim").alias("claims"))
    met = texts.select(F.col(key).alias("k"), F.col(text).alias("text")).filter(F.col(text).isNotNull()).join(lists, "k").select("k", "part", "claims", "text")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(3).to_pylist()
            coded, part = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
            total, begin = np.cumsum([len(t) for t in rows]), 0
            while begin < len(rows):
                end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + TEXT_CHARS, "right")))
                _, first, groups = np.unique(np.stack([coded[begin:end], part[begin:end]]), axis=1, return_index=True, return_inverse=True)
                taken = batch.column(2).take(pa.array(first + begin))
                which, listed = taken.value_parent_indices().to_numpy(), taken.flatten()
                n = supports(rows[begin:end], groups.reshape(-1), listed.to_pylist(), which)
                seen = np.flatnonzero(n)
                keys = batch.column(0).take(pa.array((first + begin)[which[seen]]))
                yield pa.RecordBatch.from_arrays([keys, listed.take(pa.array(seen)), pa.array(n[seen])], ["k", "claim", "n"])
                begin = end

    counts = met.mapInArrow(search, f"k {kinds[key]}, claim string, n bigint").groupBy(F.col("k").alias(key), F.col("claim").alias(claim)).agg(F.sum("n").alias("n"))
    return claims.distinct().join(counts, [key, claim], "left").fillna(0, ["n"]).select(*claims.columns, "n")


def cross_check(terms: DataFrame, first: DataFrame, second: DataFrame, *, entity: str, term: str, span: tuple[str, str], cue_span: tuple[str, str], text: str, pad: float = 0.0) -> DataFrame:
    """One row of counts: terms (entity, term, span) whose two readings in time hold both, one, or neither of them, alike or not; recall of errors that differ, and share sent to review."""

    spans = terms.select(entity, *span).distinct()  # the terms of one time are heard in one text

    def heard(cues: DataFrame, name: str) -> DataFrame:
        c = cues.select(entity, F.col(cue_span[0]).alias("_cs"), F.col(cue_span[1]).alias("_ce"), F.col(text).alias("_x"))
        pairs = overlaps(spans, c, entity=entity, a_span=span, b_span=("_cs", "_ce"), pad=pad)
        joined = pairs.groupBy(entity, *span).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_cs", "_x"))), lambda s: F.coalesce(s["_x"], F.lit(""))), "").alias(name))
        return spans.join(joined, [entity, *span], "left").fillna("", [name])

    x = terms.join(heard(first, "_a").join(heard(second, "_b"), [entity, *span]), [entity, *span])
    a, b = F.contains(F.col("_a"), F.col(term)), F.contains(F.col("_b"), F.col(term))
    n = x.agg(F.count_if(a & b).alias("both"), F.count_if(a != b).alias("one"), F.count_if(~a & ~b & (F.col("_a") != F.col("_b"))).alias("differ"), F.count_if(~a & ~b & (F.col("_a") == F.col("_b"))).alias("same"), F.count(F.lit(1)).alias("n"))
    errors = F.col("one") + F.col("differ") + F.col("same")
    return n.select("both", "one", "differ", "same", F.round(F.when(errors > 0, (F.col("one") + F.col("differ")) / errors), 9).alias("recall"), F.round(F.when(F.col("n") > 0, (F.col("one") + F.col("differ")) / F.col("n")), 9).alias("review"))


def annotation_problems(boundaries: DataFrame, ends: DataFrame, *, entity: str, end: str) -> DataFrame:
    """(entity, problem, n): undecided, repeated or out-of-range boundaries (entity, t, status), and missing annotators."""
    x = boundaries.join(ends, entity, "left")
    ok = F.col("status") == "confirmed"
    counts = x.groupBy(entity).agg(
        F.count_if(F.col("status") == "proposed").alias("pending"),
        (F.count_if(ok & F.col("t").isNotNull()) - F.count_distinct(F.when(ok, F.col("t")))).alias("repeated"),
        F.count_if(ok & ((F.col("t") <= 0) | (F.col("t") >= F.col(end)))).alias("outside"),
        F.count_if(T.strip_space(F.coalesce("annotator", F.lit(""))) == "").alias("unsigned"),
    )
    rows = counts.select(entity, F.explode(F.array(*[F.struct(F.lit(k).alias("problem"), F.col(k).alias("n")) for k in ("pending", "repeated", "outside", "unsigned")])).alias("p"))
    return rows.select(entity, "p.*").filter("n > 0")


def separation(pairs: DataFrame, *, entity: str, distance: str, merged: str) -> DataFrame:
    """(entity, merged_pairs, greatest_merged, apart_pairs, least_apart)."""
    m = F.col(merged)
    return pairs.groupBy(entity).agg(F.count_if(m).alias("merged_pairs"), F.max(F.when(m, F.col(distance))).alias("greatest_merged"), F.count_if(~m).alias("apart_pairs"), F.min(F.when(~m, F.col(distance))).alias("least_apart"))


def cross_episode_rejects(nearest: DataFrame, *, limit: float, references: int, least: int = 2) -> DataFrame:
    """Rows (with score) so near to another episode's that they recur; with fewer than ``least`` reference episodes none, and an error log is the caller's."""
    return nearest.filter((F.lit(references) >= least) & (F.col("score") < limit))


def apply_payload(rows: DataFrame, payload: str) -> DataFrame:
    """Slide columns from a model's payload struct: text only where it's a slide, a reason only where it isn't."""
    p = F.col(payload)
    clean = lambda c: F.nullif(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", ""), F.lit(""))
    slide = F.coalesce(p["is_slide"], F.lit(False))
    names = set(rows.select(p).schema[0].dataType.names)
    description = clean(p["description"]) if "description" in names else F.lit(None).cast("string")
    return rows.withColumn("slide_text", F.when(slide, clean(p["slide_text"]))).withColumn("layout_description", F.when(slide, description)).withColumn("reject_reason", F.when(~slide, F.coalesce(clean(p["reject_reason"]), F.lit("未說明"))))


def apply_to_segments(segments: DataFrame, results: DataFrame, *, key: str) -> DataFrame:
    """Segments with the result's is_slide applied: no slide means mode speaker_only and no reference."""
    x = segments.join(results.select(key, F.col("is_slide").alias("_is")), key, "left")
    off = F.col("_is").eqNullSafe(False)
    return x.withColumn("mode", F.when(off, "speaker_only").otherwise(F.col("mode"))).withColumn("slide_ref", F.when(~off, F.col("slide_ref"))).drop("_is")


def split_spec(spec: Column, providers: list[str]) -> Column:
    """struct(provider, model) of provider:model, cut at the first colon; null for an unknown provider or an empty model."""
    provider, model = F.substring_index(spec, ":", 1), F.substr(spec, F.instr(spec, ":") + 1)
    return F.when((F.instr(spec, ":") > 0) & provider.isin(providers) & (model != ""), F.struct(provider.alias("provider"), model.alias("model")))


def run_model(items: DataFrame, cache: DataFrame, keys: list[str], call: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Results of all items: from the cache where all keys are equal, else by ``call`` on Arrow batches. schema names the keys and the result's columns; the cache has the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(call, batches)

    misses = items.join(cache.select(*keys).distinct(), keys, "left_anti").mapInArrow(run, schema)
    hits = cache.dropDuplicates(keys).join(items.select(*keys).distinct(), keys, "left_semi")
    return hits.select(*misses.columns).unionByName(misses)


def mask_stats(rows: DataFrame, *, key: str, mask: str, width: int) -> DataFrame:
    """(key, ink, coverage, x_spread, y_spread, top_share) of flat boolean masks, row by row of ``width``."""
    x = rows.select(key, F.size(mask).alias("_n"), F.posexplode(mask).alias("_p", "_v")).withColumn("_x", F.col("_p") % width).withColumn("_y", F.floor(F.col("_p") / width))
    ink = F.coalesce(F.col("_v"), F.lit(False))
    height = F.col("_n") / width
    spread = lambda c: F.coalesce(F.stddev_pop(F.when(ink, F.col(c))), F.lit(0.0))
    return x.groupBy(key, "_n").agg(F.count_if(ink).alias("ink"), F.avg(ink.cast("int")).alias("coverage"), spread("_x").alias("x_spread"), spread("_y").alias("y_spread"), F.coalesce(F.avg(F.when(ink, (F.col("_y") < height / 2).cast("int"))), F.lit(0.0)).alias("top_share")).drop("_n")


def debug_report(segments: DataFrame, verdicts: DataFrame, *, entity: str) -> DataFrame:
    """(entity, markdown): a report for people: a heading with time and link by segment, and a line by block with its verdict."""
    lines = verdicts.groupBy(entity, "segment_id").agg(F.array_sort(F.collect_list(F.struct("block_index", F.concat_ws(" ", F.lit("-"), F.concat(F.lit("["), F.col("status"), F.lit("]")), F.concat(F.col("type"), F.lit(":")), F.coalesce("text", F.lit(""))).alias("line")))).alias("b"))
    head = F.concat(F.lit("## "), T.clock(F.col("t_start")), F.lit(" "), F.col("segment_id"), F.lit(" ("), T.deep_link(F.col("url"), F.col("t_start")), F.lit(")\n"))
    body = F.array_join(F.transform(F.coalesce("b", F.array().cast("array<struct<block_index:int,line:string>>")), lambda x: x["line"]), "\n")
    parts = segments.join(lines, [entity, "segment_id"], "left").select(entity, "t_start", "segment_id", F.concat(head, body).alias("x"))
    return parts.groupBy(entity).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t_start", "segment_id", "x"))), lambda r: r["x"]), "\n\n").alias("markdown"))
