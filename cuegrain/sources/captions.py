"""Caption files, targets and playlists as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

_TIME = r"(\d{2}:\d{2}:\d{2}[.,]\d{3})"


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of WebVTT or SRT files, one row each."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content"))


def parse_captions(files: DataFrame, *, entity: str, content: str) -> DataFrame:
    """(entity, index, t_start, t_end, text): cues of caption texts.

    A timing line opens a cue; header, note and style lines and a bare number before
    any text are skipped; tags go, white space becomes one blank, entities are
    resolved; cues without text are dropped. A file without timing gives no cue.
    """
    lines = files.select(entity, F.posexplode(F.split(F.regexp_replace(content, "\r\n?", "\n"), "\n")).alias("_i", "_l")).withColumn("_l", F.trim(F.regexp_replace("_l", r"(?U)^\s+|\s+$", "")))
    timing = F.regexp_like("_l", F.lit(f"{_TIME}\\s*-->\\s*{_TIME}"))
    x = lines.withColumn("_t", timing).withColumn("_cue", F.sum(F.when(F.col("_t"), 1).otherwise(0)).over(W.partitionBy(entity).orderBy("_i")))
    x = x.filter("_cue > 0 AND _l <> ''").filter(~F.regexp_like("_l", F.lit("^(WEBVTT|NOTE|STYLE|Kind:|Language:)")))
    parts = x.groupBy(entity, "_cue").agg(F.max(F.when(F.col("_t"), F.col("_l"))).alias("_time"), F.array_sort(F.collect_list(F.when(~F.col("_t"), F.struct("_i", "_l")))).alias("_p"))
    body = F.transform("_p", lambda p: p["_l"])
    # Only leading bare numbers are skipped: those before any text of the cue.
    start = F.aggregate(body, F.struct(F.lit(False).alias("on"), F.array().cast("array<string>").alias("out")), lambda s, v: F.struct((s["on"] | ~F.regexp_like(v, F.lit("^[0-9]+$"))).alias("on"), F.when(s["on"] | ~F.regexp_like(v, F.lit("^[0-9]+$")), F.concat(s["out"], F.array(v))).otherwise(s["out"]).alias("out")), lambda s: s["out"])
    times = F.regexp_extract_all("_time", F.lit(_TIME), 1)
    cues = parts.select(entity, "_cue", T.clock_seconds(F.get(times, F.lit(0))).alias("t_start"), T.clock_seconds(F.get(times, F.lit(1))).alias("t_end"), T.clean_caption(F.array_join(start, " ")).alias("text")).filter("text <> ''")
    return cues.select(entity, (F.row_number().over(W.partitionBy(entity).orderBy("_cue")) - 1).alias("index"), "t_start", "t_end", "text")


def collapse_rolling(cues: DataFrame, *, entity: str) -> DataFrame:
    """Captions that grow word by word become one: a cue whose text, without blanks, begins with the one before joins it.

    The text is the earliest one that equals the run's last without blanks.
    """
    by = W.partitionBy(entity).orderBy("index")
    bare = F.replace("text", F.lit(" "), F.lit(""))
    x = cues.withColumn("_b", bare).withColumn("_new", F.coalesce(~F.startswith(F.col("_b"), F.lag("_b").over(by)), F.lit(True)))
    x = x.withColumn("_g", F.sum(F.when(F.col("_new"), 1).otherwise(0)).over(by))
    groups = x.groupBy(entity, "_g").agg(F.min_by("t_start", "index").alias("t_start"), F.max_by("t_end", "index").alias("t_end"), F.max_by("_b", "index").alias("_last"), F.array_sort(F.collect_list(F.struct("index", "_b", "text"))).alias("_c"))
    text = F.element_at(F.filter("_c", lambda c: c["_b"] == F.col("_last")), 1)["text"]
    return groups.select(entity, (F.row_number().over(W.partitionBy(entity).orderBy("_g")) - 1).alias("index"), "t_start", "t_end", text.alias("text"))


def parse_target(target: Column) -> Column:
    """struct(video_id, playlist_id) of an id or a link; null parts where there's none."""
    found = lambda p: F.nullif(F.regexp_extract(target, p, 1), F.lit(""))
    bare = F.regexp_like(F.trim(target), F.lit("^[A-Za-z0-9_-]{11}$"))
    listed = F.regexp_like(target, F.lit("^(PL|UU|OL)"))
    playlist = found(r"[?&]list=([A-Za-z0-9_-]+)")
    video = found(r"(?:v=|youtu\.be/|/shorts/|/embed/)([A-Za-z0-9_-]{11})")
    return F.struct(F.when(bare, F.trim(target)).when(listed, F.lit(None).cast("string")).otherwise(video).alias("video_id"), F.when(bare, playlist).when(listed, F.trim(target)).otherwise(playlist).alias("playlist_id"))


def expand_playlist(items: DataFrame, *, playlist: str, entries: str) -> DataFrame:
    """(playlist, video_id, episode_index): entries in order, numbered from 1; null ones are skipped but keep their number."""
    return items.select(playlist, F.posexplode(entries).alias("_i", "video_id")).filter("video_id IS NOT NULL").select(playlist, "video_id", (F.col("_i") + 1).alias("episode_index"))


def pick_caption(tracks: DataFrame, *, entity: str, lang: str, manual: str, order: list[str]) -> DataFrame:
    """(entity, lang, manual): a manual track in the preferred language, else an automatic one; none of another language."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(lang))
    best = tracks.filter(rank > 0).groupBy(entity).agg(F.min(F.struct((~F.col(manual)).alias("auto"), rank.alias("rank"), F.col(lang).alias("lang"))).alias("b"))
    return best.select(entity, F.col("b.lang").alias("lang"), (~F.col("b.auto")).alias("manual"))


def pick_source(cues: DataFrame, *, entity: str, source: str, order: list[str], expected: DataFrame | None = None) -> DataFrame:
    """Each entity's cues of the first source that has any, ends at least 0.01 after starts. An entity of ``expected`` without cues is an error."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(source))
    best = cues.filter(rank > 0).groupBy(entity).agg(F.min(rank).alias("_best"))
    if expected is not None:
        without = expected.select(entity).distinct().join(best, entity, "left_anti").limit(5).collect()  # for the message
        if without:
            raise ValueError(f"no cues for {[r[0] for r in without]}")
    return cues.join(best, entity).filter(rank == F.col("_best")).drop("_best").withColumn("t_end", F.greatest(F.col("t_end"), F.col("t_start") + 0.01))
