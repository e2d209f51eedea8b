"""Stages in one piece: model payloads to blocks, batched model calls, rendering with its sinks, surveys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..session import cut
from ..sources.keyed import KeyedTable
from . import provenance as P
from . import survey as V

#: What a model returns for a segment.
PAYLOAD = "struct<summary:string,terms:array<string>,content_blocks:array<struct<type:string,text:string,provenance_kind:string>>,corrections:array<struct<before:string,after:string>>>"


class StageFailed(RuntimeError):
    """A stage stops with what it found."""


# -- payloads --------------------------------------------------------------------------


def parse_payload(rows: DataFrame, column: str, schema: str = PAYLOAD) -> DataFrame:
    """Rows with ``payload`` (the JSON text as a struct) and ``json_ok``: whether the text was a JSON object."""
    parsed = F.from_json(F.col(column), schema)
    return rows.withColumn("payload", parsed).withColumn("json_ok", F.coalesce(F.get_json_object(column, "$").startswith("{"), F.lit(False)))


def reference(kind: Column, slide_id: Column, start: Column, end: Column) -> Column:
    """The reference that a block gets from the pipeline, whatever the model wrote: the slide, or the time in seconds."""
    return F.when(kind == "slide_ocr", slide_id).otherwise(F.format_string("%.1fs-%.1fs", start, end))


def understood_blocks(rows: DataFrame, *, key: str = "segment_id") -> DataFrame:
    """(key, block_index, type, kind, text, ref, dropped) of rows (key, payload, slide_id, slide_text, transcript, t_start, t_end).

    dropped says why a block isn't kept, or is null: no kind of source; a slide's text
    where there's no slide; a transcript where it's blank; a type or kind that isn't
    known, or no text. block_index counts the kept ones. Null payloads have no block.
    """
    b = rows.select("*", F.posexplode("payload.content_blocks").alias("_i", "_b"))
    kind, type_, blank = F.col("_b.provenance_kind"), F.col("_b.type"), lambda c: T.strip_space(F.coalesce(c, F.lit(""))) == ""
    dropped = (
        F.when(F.coalesce(kind, F.lit("")) == "", "no_kind")
        .when((kind == "slide_ocr") & (F.coalesce("slide_text", F.lit("")) == ""), "no_slide")
        .when((kind == "transcript") & blank(F.col("transcript")), "no_transcript")
        .when(~kind.isin("slide_ocr", "transcript") | ~F.coalesce(type_.isin(list(fixed.MIN_SIMILARITY_BY_TYPE)), F.lit(False)) | F.col("_b.text").isNull(), "malformed")
    )
    b = b.withColumn("dropped", dropped)
    index = F.when(F.col("dropped").isNull(), F.count_if(F.col("dropped").isNull()).over(W.partitionBy(key).orderBy("_i")) - 1)
    ref = reference(kind, F.col("slide_id"), F.col("t_start"), F.col("t_end"))
    text = F.regexp_replace("_b.text", r"(?U)^\s+|\s+$", "")
    return b.select(key, F.col("_i").alias("position"), index.cast("int").alias("block_index"), type_.alias("type"), kind.alias("kind"), text.alias("text"), F.when(F.col("dropped").isNull(), ref).alias("ref"), "dropped")


def understand(segments: DataFrame, cache: DataFrame, call: Callable[[pd.DataFrame, str | None], pd.DataFrame], *, entity: str, key: str, order: str, fingerprint: str, size: int = 3) -> DataFrame:
    """(entity, key, result, summary, source) of every segment that has a result.

    An entity's segments go to the model in batches of ``size`` in their order. A batch whose
    segments are all in the cache (key, fingerprint, result, summary) is not sent; else it's
    sent whole, and segments that the answer lacks are sent one by one. call(batch, summary
    before) gives (key, result, summary); a call that raises leaves its batch without results.
    The summary of the last result is carried to the next batch, so that an
    entity is one sequence of calls by nature. source: cache, batch or refill.
    """
    kinds = dict(segments.dtypes)
    held = cache.dropDuplicates([key, fingerprint]).select(F.col(key).alias("_k"), F.col(fingerprint).alias("_f"), F.col("result").alias("_result"), F.col("summary").alias("_summary"), F.lit(True).alias("_hit"))
    rows = segments.join(held, (F.col(key) == F.col("_k")) & (F.col(fingerprint) == F.col("_f")), "left").drop("_k", "_f")
    columns = [entity, key, "result", "summary", "source"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        out: list[tuple] = []
        before = None

        def ask(part: pd.DataFrame, source: str) -> set:
            try:
                got = call(part, before)
            except Exception:  # noqa: BLE001 - the model's, which leaves the batch empty
                return set()
            mine = got[got[key].isin(part[key])]
            out.extend((part[entity].iloc[0], k, r, s, source) for k, r, s in zip(mine[key], mine["result"], mine["summary"]))
            return set(mine[key])

        for start in range(0, len(frame), max(1, size)):
            batch = frame.iloc[start : start + max(1, size)]
            if batch["_hit"].eq(True).all():
                out.extend((e, k, r, s, "cache") for e, k, r, s in zip(batch[entity], batch[key], batch["_result"], batch["_summary"]))
            else:
                asked = batch.drop(columns=["_hit", "_result", "_summary"])
                found = ask(asked, "batch")
                missing = asked[~asked[key].isin(found)]
                if found and len(batch) > 1:
                    for i in range(len(missing)):
                        ask(missing.iloc[i : i + 1], "refill")
            before = out[-1][3] if out else before
        return pd.DataFrame(out, columns=columns)

    return rows.groupBy(entity).applyInPandas(run, f"{entity} {kinds[entity]}, {key} {kinds[key]}, result string, summary string, source string")


# -- rendering -------------------------------------------------------------------------


def unverified_rows(verdicts: DataFrame) -> DataFrame:
    """What a person looks at: every block whose status isn't verified."""
    columns = ["video_id", "segment_id", "block_index", "type", "status", F.round("similarity", 4).alias("similarity"), F.round("copy_ratio", 4).alias("copy_ratio"), "missing", "wrong_source", "depends_on_correction", "reason"]
    return verdicts.filter(F.col("status") != P.VERIFIED).select(*columns)


def provenance_records(verdicts: DataFrame, segments: DataFrame) -> DataFrame:
    """A record of each video: verdicts, causes of failure, and how much was written. segments (video_id, segment_id, t_start, t_end, transcript)."""
    counts = P.video_verdicts(verdicts).select("video_id", F.col("total").alias("blocks_checked"), (F.col("total") - F.col("unverified")).alias("verified"), F.round("pass_rate", 4).alias("pass_rate"), "needs_review", "wrong_source", "depends_on_correction", "unresolved")
    symbols = verdicts.groupBy("video_id").agg(F.count_if((F.col("status") != P.VERIFIED) & (F.size("fabricated_symbols") > 0)).alias("with_fabricated_symbols"))
    return counts.join(symbols, "video_id").join(P.content_yield(segments, verdicts), "video_id", "left")


def low_yield(records: DataFrame, least: float = fixed.MIN_CHARS_PER_1K_SOURCE) -> DataFrame:
    """Records of videos for which almost nothing was written."""
    return records.filter(F.col("chars_per_1k_source") < least)


@dataclass
class Sinks:
    """Where rendering writes, keyed by video_id."""

    unverified: KeyedTable
    provenance: KeyedTable
    chunks: KeyedTable
    reports: KeyedTable | None = None


def render(blocks: DataFrame, segments: DataFrame, sinks: Sinks) -> DataFrame:
    """Checks blocks and writes unverified rows, records, chunks and reports, in that order; returns the records.

    A video's rows take the place of those of its last run, in the sinks where it has none now
    as well. Videos whose yield is below the floor stop the stage after the records are
    written and before any chunk is. segments (video_id, segment_id, t_start, t_end, transcript, url).
    """
    verdicts = cut(P.relax_copies(P.check_blocks(blocks)), "verdicts")
    videos = segments.select("video_id").distinct()
    sinks.unverified.replace(unverified_rows(verdicts), videos)
    records = cut(provenance_records(verdicts, segments), "records")
    sinks.provenance.replace(records, videos)
    low = low_yield(records).orderBy("video_id").select("video_id", "chars_per_1k_source").limit(5).collect()  # for the message
    if low:
        raise StageFailed(f"too little was written, e.g. for {[tuple(r) for r in low]}")
    sinks.chunks.replace(P.build_chunks(verdicts), videos)
    if sinks.reports:
        sinks.reports.replace(V.debug_report(segments, verdicts, entity="video_id"), videos)
    return records


# -- surveys ---------------------------------------------------------------------------


def video_profiles(series: DataFrame, sections: DataFrame, *, entity: str, fps: float) -> DataFrame:
    """series (of signals.series_profile) with sections' dwell times (median, least, greatest) and density a minute. sections (entity, start, end) in frames.

    Adds transition_ratio, the share of rows in between. An entity without sections dwells 0.
    """
    d = (F.col("end") - F.col("start")) / fps
    dwell = sections.groupBy(entity).agg(F.median(d).alias("dwell_median"), F.min(d).alias("dwell_min"), F.max(d).alias("dwell_max"), F.count(F.lit(1)).alias("section_count"))
    x = series.join(dwell, entity, "left").fillna(0.0, ["dwell_median", "dwell_min", "dwell_max"]).fillna(0, ["section_count"])
    x = x.withColumn("duration", F.col("n") / fps).withColumn("density", F.col("section_count") / F.greatest(F.col("duration") / 60, F.lit(1e-6)))
    return x.withColumn("transition_ratio", F.col("between") / F.col("n"))


def survey(profiles: DataFrame, baselines: DataFrame, table: KeyedTable | None = None, *, series: str = "series_id") -> tuple[DataFrame, int]:
    """(problems, exit code) of a survey of profiles (video_id, series, ratio, separation, density, midband, order, fingerprint).

    Writes the profiles to ``table`` by video, where given. problems (series, problem, value): where
    the limits are passed, where the mean leaves the baseline, and new backgrounds. The code is 3 where
    a series is beyond the limits, else 0.
    """
    if table is not None:
        table.replace(profiles)
    beyond = V.mismatches(profiles, series=series)
    off = V.deviations(profiles, baselines, series=series, ratio="ratio").select(series, F.lit("deviation").alias("problem"), F.round("mean", 6).alias("value"))
    drift = V.background_drift(profiles, group=series, key="video_id", order="order", fingerprint="fingerprint").join(profiles.select("video_id", series), "video_id").select(series, F.lit("background").alias("problem"), F.round("distance", 6).alias("value"))
    beyond = cut(beyond, "survey")
    return beyond.unionByName(off).unionByName(drift), 3 if beyond.head(1) else 0


# -- references between episodes -------------------------------------------------------


def reference_counts(kept: DataFrame, *, entity: str) -> DataFrame:
    """(entity, references): for every entity of ``kept`` the number of other entities in it."""
    own = kept.select(entity).filter(F.col(entity).isNotNull()).distinct()
    return own.join(F.broadcast(own.agg((F.count(F.lit(1)) - 1).alias("references"))))


def recurring(nearest: DataFrame, kept: DataFrame, *, entity: str, limit: float, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rejected, unjudged): rows of ``nearest`` (entity, score) so near to another entity's that they recur, and entities with fewer than ``least`` others to tell by."""
    counts = reference_counts(kept, entity=entity)
    judged = nearest.join(counts, entity)
    rejected = judged.filter((F.col("references") >= least) & (F.col("score") < limit)).drop("references")
    return rejected, nearest.select(entity).distinct().join(counts.filter(F.col("references") >= least), entity, "left_anti")
