"""Whole stages composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut
from . import intervals as I
from . import segmentation as S
from . import signals as Sg


def align_segments(cues: DataFrame, ends: DataFrame, slides: DataFrame, *, entity: str, least: float = 5.0, alpha: float = 0.75, block_chars: int = 40) -> DataFrame:
    """Segments (entity, w_index, segment_id, t_start, t_end, mode, slide_id, cues, transcript, boundary_method) of timed cues.

    cues (entity, cue, t_start, t_end, text), ends (entity, duration), slides (entity, slide_id, s_start, s_end).
    Topic boundaries, thinned to ``least`` seconds, cut each entity's time; a window
    takes the cues whose midpoint it holds, the slide that it overlaps most, and its cues' texts in order.
    """
    topics = S.topic_boundaries(cues, entity=entity, order="cue", time="t_start", text="text", block_chars=block_chars, alpha=alpha)
    thinned = topics.join(ends, entity).groupBy(entity, "duration").agg(F.collect_list("t").alias("_t")).select(entity, F.explode(S.keep_min_length(F.col("_t"), F.col("duration"), least)).alias("t"))
    # Used three times below; written once.
    windows = cut(I.windows_between(thinned, ends, entity=entity, time="t", end="duration"), "windows")
    assigned = I.assign_to_windows(cues, windows, entity=entity, cue="cue", span=("t_start", "t_end"))
    parts = cues.join(assigned, "cue").groupBy(entity, "w_index").agg(F.array_sort(F.collect_list(F.struct("t_start", "cue", F.coalesce("text", F.lit("")).alias("x")))).alias("p"))
    named = windows.withColumn("_w", F.concat_ws("#", entity, F.format_string("%03d", F.col("w_index").cast("int"))))
    shown = I.best_overlap(named, slides, entity=entity, a_id="_w", a_span=("w_start", "w_end"), b_id="slide_id", b_span=("s_start", "s_end"))
    x = named.join(parts, [entity, "w_index"], "left").join(shown, "_w", "left")
    return x.select(
        entity,
        "w_index",
        F.col("_w").alias("segment_id"),
        F.col("w_start").alias("t_start"),
        F.col("w_end").alias("t_end"),
        F.when(F.col("slide_id").isNull(), "speaker_only").otherwise("slide").alias("mode"),
        "slide_id",
        F.coalesce(F.transform("p", lambda c: c["cue"]), F.array().cast("array<string>")).alias("cues"),
        F.coalesce(F.array_join(F.transform("p", lambda c: c["x"]), ""), F.lit("")).alias("transcript"),
        F.when(F.col("w_index") == 0, "video_bounds").otherwise("topic_shift").alias("boundary_method"),
    )


def detect_slides(frames: DataFrame, ends: DataFrame, *, entity: str, order: str, ink: str, fps: float = 1.0, stay: float = 0.97, least_change: float = 0.01, contained: float = 0.70, least_seconds: float = 3.0) -> DataFrame:
    """Slides (entity, section, slide_id, t_start, t_end, keyframe_t, progressive) of frames (entity, order, ink: array of set marks).

    Distances of consecutive ink sets, change points, progressive merging by the
    sections' key frames, short sections absorbed, times at frame middles clipped to [0, duration].
    progressive: the slide was built up in several sections.
    """
    from .grouping import jaccard_distance

    by = W.partitionBy(entity).orderBy(order)
    d = frames.withColumn("d", F.coalesce(jaccard_distance(F.col(ink), F.lag(ink).over(by)), F.lit(0.0))).withColumn("size", F.size(ink))
    rows = Sg.sections(d, Sg.viterbi_changes(d, entity=entity, order=order, distance="d", stay=stay, least=least_change), entity=entity, order=order)
    spans = Sg.merge_sections(rows, frames, entity=entity, order=order, ink=ink, ratio=contained)
    long = Sg.drop_short(spans, entity=entity, least=max(1, round(least_seconds * fps)))
    built = long.select(entity, "section", F.col("start").alias("_a"), F.col("end").alias("_b")).join(spans, entity).filter((F.col("start") >= F.col("_a")) & (F.col("end") <= F.col("_b"))).groupBy(entity, "section").agg(F.max("builds").alias("_builds"))
    out = long.join(built, [entity, "section"]).join(Sg.keyframes(d, long, entity=entity, order=order, ink="size"), [entity, "section"]).join(ends, entity)
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.col("duration"))
    return out.select(entity, "section", F.format_string("slide_%03d", F.col("section").cast("int")).alias("slide_id"), clip(F.col("start") / fps).alias("t_start"), clip(F.col("end") / fps).alias("t_end"), clip((F.col("keyframe") + 0.5) / fps).alias("keyframe_t"), (F.col("_builds") > 1).alias("progressive"))


def alpha_sweep(scores: DataFrame, alphas: list[float], *, entity: str) -> DataFrame:
    """(alpha, entity, t) of depth cuts of gap scores at every alpha."""
    out = None
    for alpha in alphas:
        cuts = S.depth_cuts(scores, entity=entity, order="i", score="score", alpha=alpha).select(F.lit(alpha).alias("alpha"), entity, F.col("t_next").alias("t"))
        out = cuts if out is None else out.unionByName(cuts)
    return out


def closest_alpha(swept: DataFrame, wanted: DataFrame, alphas: list[float], *, entity: str) -> DataFrame:
    """(entity, alpha, cuts): for each entity of ``wanted`` (entity, n) the alpha whose number of cuts is closest, the least on ties."""
    grid = wanted.select(entity, "n", F.explode(F.array(*[F.lit(a) for a in alphas])).alias("alpha"))
    counts = grid.join(swept.groupBy(entity, "alpha").agg(F.count(F.lit(1)).alias("c")), [entity, "alpha"], "left").fillna(0, ["c"])
    best = counts.groupBy(entity).agg(F.min(F.struct(F.abs(F.col("c") - F.col("n")).alias("d"), "alpha", F.col("c").alias("cuts"))).alias("b"))
    return best.select(entity, "b.alpha", "b.cuts")


def swap_sources(blocks: DataFrame, arms: dict[str, str]) -> DataFrame:
    """(arm, type, n, pass_rate): block gates with each arm's column as the source."""
    from .provenance import VERIFIED, check_blocks

    out = None
    for arm, column in arms.items():
        v = check_blocks(blocks.withColumn("transcript", F.col(column)).withColumn("slide_text", F.lit(None).cast("string")).withColumn("kind", F.lit("transcript")).withColumn("corrected", F.lit(None).cast("string")))
        r = v.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("status") == VERIFIED).cast("int")), 9).alias("pass_rate")).select(F.lit(arm).alias("arm"), "type", "n", "pass_rate")
        out = r if out is None else out.unionByName(r)
    return out
