"""Checks of derived text blocks against their sources, and what is made of the verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T

VERIFIED, UNVERIFIED, COPY = "verified", "unverified", "degenerate_copy"


def by_type(kind: Column, table: dict[str, float], default: float) -> Column:
    """A parameter by content type."""
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(kind == name, F.lit(value)).otherwise(out)
    return out


def resolve_source(kind: Column, slide_text: Column, transcript: Column) -> Column:
    """The slide's text for kind slide_ocr, else the raw transcript; '' where it's missing."""
    return F.coalesce(F.when(kind == "slide_ocr", slide_text).otherwise(transcript), F.lit(""))


def status_of(similarity: Column, threshold: Column, source_ratio: Column, missing: Column, copy_ratio: Column) -> tuple[Column, Column]:
    """(status, reason); the first gate that fails decides: source too short, too unlike, entities missing, copied."""
    gates = [(source_ratio < fixed.MIN_SOURCE_RATIO, "short_source", UNVERIFIED), (similarity < threshold, "unlike", UNVERIFIED), (F.size(missing) > 0, "entities", UNVERIFIED), (copy_ratio >= fixed.COPY_SIMILARITY, "copy", COPY)]
    status, reason = F.lit(VERIFIED), F.lit("")
    for failed, why, result in reversed(gates):
        status, reason = F.when(failed, result).otherwise(status), F.when(failed, why).otherwise(reason)
    return status, reason


def _source_ratio(text: Column, source: Column) -> Column:
    return F.when(T.strip_space(text) == "", 0.0).otherwise(F.length(T.strip_space(source)) / F.greatest(F.length(T.strip_space(text)), F.lit(1)))


def check_blocks(blocks: DataFrame) -> DataFrame:
    """Verdicts of blocks (video_id, segment_id, block_index, type, kind, text, slide_text, transcript, corrected).

    Adds source, similarity, copy_ratio, missing, status, reason, wrong_source (the
    segment's other source fits, and more than twice as well), depends_on_correction
    (only the corrected transcript would pass) and fabricated_symbols. A block's bigrams
    are built once for its comparison with all three texts.

    Null texts count as ''. Repeated rows keep a row each. Other columns are kept unless
    their names clash, in which case they are replaced.
    """
    blank = lambda c: F.coalesce(c, F.lit(""))
    limit = by_type(F.col("type"), fixed.MIN_SIMILARITY_BY_TYPE, fixed.MIN_SIMILARITY)
    other = blank(F.when(F.col("kind") == "slide_ocr", F.col("transcript")).otherwise(F.col("slide_text")))
    x = blocks.withColumn("text", blank(F.col("text"))).withColumn("source", resolve_source(F.col("kind"), F.col("slide_text"), F.col("transcript")))
    x = x.withColumn("_in", T.containments(F.col("text"), F.col("source"), other, blank(F.col("corrected"))))
    x = x.withColumn("similarity", F.col("_in")[0]).withColumn("copy_ratio", T.common_substring_ratio(F.col("text"), F.col("source")))
    x = x.withColumn("missing", T.unsupported_entities(F.col("text"), F.col("source")))
    status, reason = status_of(F.col("similarity"), limit, _source_ratio(F.col("text"), F.col("source")), F.col("missing"), F.col("copy_ratio"))
    x = x.withColumn("status", status).withColumn("reason", reason)
    failed = F.col("status") == UNVERIFIED
    x = x.withColumn("wrong_source", failed & (T.strip_space(other) != "") & (F.col("_in")[1] >= limit) & (F.col("_in")[1] > 2 * F.col("similarity")))
    corrected = blank(F.col("corrected"))
    retry = failed & (F.col("kind") == "transcript") & (T.strip_space(corrected) != "") & ~corrected.eqNullSafe(F.col("transcript"))
    again = (_source_ratio(F.col("text"), corrected) >= fixed.MIN_SOURCE_RATIO) & (F.col("_in")[2] >= limit) & (F.size(T.unsupported_entities(F.col("text"), corrected)) == 0)
    x = x.withColumn("depends_on_correction", F.when(retry, again).otherwise(F.lit(False)))
    return x.withColumn("fabricated_symbols", T.unsupported_symbols(F.col("text"), F.col("source"))).drop("_in")


def relax_copies(verdicts: DataFrame) -> DataFrame:
    """Copied blocks count as verified where the video copies no more of that type than its limit allows."""
    w = W.partitionBy("video_id", "type")
    share = F.count_if(F.col("status") == COPY).over(w) / F.count(F.lit(1)).over(w)
    allowed = share <= by_type(F.col("type"), fixed.MAX_COPY_BY_TYPE, 1.0)
    return verdicts.withColumn("status", F.when((F.col("status") == COPY) & allowed, VERIFIED).otherwise(F.col("status")))


def video_verdicts(verdicts: DataFrame) -> DataFrame:
    """Per video: total, unverified, ratio, pass rate, review mark (over 0.05), causes of failure, and blocks with symbols that their source lacks."""
    bad = F.col("status") != VERIFIED
    ratio = F.count_if(bad) / F.count(F.lit(1))
    return verdicts.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(bad).alias("unverified"),
        F.round(ratio, 9).alias("ratio"),
        F.round(1 - ratio, 9).alias("pass_rate"),
        (ratio > 0.05).alias("needs_review"),
        F.count_if(bad & F.col("wrong_source")).alias("wrong_source"),
        F.count_if(bad & F.col("depends_on_correction")).alias("depends_on_correction"),
        F.count_if(bad & ~F.col("wrong_source") & ~F.col("depends_on_correction")).alias("unresolved"),
        F.count_if(F.size("fabricated_symbols") > 0).alias("with_symbols"),
    )


def overall_rate(videos: DataFrame) -> DataFrame:
    """Ratio of sums over all videos; 0 blocks give 0."""
    total, bad = F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("unverified"), F.lit(0))
    return videos.agg(total.alias("total"), bad.alias("unverified"), F.round(F.when(total > 0, (total - bad) / total).otherwise(0.0), 9).alias("pass_rate"))


def content_yield(segments: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per video: segments, those with blocks, blocks, blocks per segment, characters per minute and per 1,000 of source. Rounded half-even."""
    b = blocks.groupBy("video_id", "segment_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.length("text")).alias("chars"))
    s = segments.join(b, ["video_id", "segment_id"], "left")
    minutes, source = F.greatest(F.sum(F.col("t_end") - F.col("t_start")) / 60, F.lit(1e-9)), F.sum(F.length(F.coalesce("transcript", F.lit(""))))
    blocks_n, chars, used = F.coalesce(F.sum("blocks"), F.lit(0)), F.coalesce(F.sum("chars"), F.lit(0)), F.count("blocks")
    return s.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("segments"),
        used.alias("with_result"),
        blocks_n.alias("blocks"),
        F.bround(F.when(used > 0, blocks_n / used).otherwise(0.0), 2).alias("blocks_per_segment"),
        F.bround(chars / minutes, 1).alias("chars_per_minute"),
        F.bround(F.when(source > 0, chars * 1000 / source).otherwise(0.0), 1).alias("chars_per_1k_source"),
    )


def build_chunks(verdicts: DataFrame, most: int = 800) -> DataFrame:
    """Verified blocks as chunks (chunk_id, video_id, segment_id, block_index, type, text, content_sha, referential).

    Plain text, cut at sentences into at most ``most`` characters. The id carries the
    piece's number from the second one on. Blocks without text give none.
    """
    plain = verdicts.filter(F.col("status") == VERIFIED).withColumn("_plain", T.strip_markdown(F.col("text"))).filter("_plain <> ''")
    pieces = plain.select("video_id", "segment_id", "block_index", "type", F.posexplode(T.split_long(F.col("_plain"), most)).alias("_k", "text"))
    ident = F.concat("segment_id", F.format_string("#b%02d", F.col("block_index").cast("int")), F.when(F.col("_k") > 0, F.concat(F.lit("-"), F.col("_k").cast("string"))).otherwise(""))
    return pieces.select(ident.alias("chunk_id"), "video_id", "segment_id", "block_index", "type", "text", T.content_sha(F.col("text")).alias("content_sha"), T.referential_phrases(F.col("text")).alias("referential"))
