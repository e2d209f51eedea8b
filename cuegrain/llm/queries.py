"""Queries of the problems tagged llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grouping import connected_components
from ..registry import Registry, load
from ..session import cut
from . import sql
from .canon import look_alike_pairs, one_form
from .lexicon import encode, token_sizes
from .minmax import expand_pairs, near_duplicates
from .nearest import nearest_in_time
from .packing import pack
from .repeats import repeated_share
from .split import split_oversized
from .stuffing import keyword_pages

REGISTRY = Registry()


@REGISTRY.add("p2_found", sql.P2)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each confirmed boundary with the segment that starts nearest, within 10 seconds."""
    marks = load(spark, sf_dir, "golden_boundaries").filter("status = 'confirmed' AND t IS NOT NULL")
    segments = load(spark, sf_dir, "segments")
    found = nearest_in_time(marks, segments, entity="video_id", left_id="boundary_id", left_time="t", right_id="segment_id", right_time="t_start", tolerance=10.0)
    return found.select(F.col("left_id").alias("boundary_id"), F.col("right_id").alias("segment_id")).distinct()


@REGISTRY.add("p3_found", sql.P3)
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of transcripts of more than 500 characters."""
    pieces = split_oversized(load(spark, sf_dir, "segments"), key="segment_id", text="transcript_raw", t_start="t_start", t_end="t_end")
    return pieces.select("segment_id", "piece_no", "char_from", "char_to").distinct()


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = load(spark, sf_dir, "segments").select(F.lit("segment").alias("kind"), F.col("segment_id").alias("key"), F.col("video_id").alias("entity"), F.col("transcript_raw").alias("text"))
    slides = load(spark, sf_dir, "slide_raw").select(F.lit("slide").alias("kind"), F.col("read_id").alias("key"), F.col("video_id").alias("entity"), F.col("parsed.slide_text").alias("text"))
    return segments.unionByName(slides)


@REGISTRY.add("p4_found", sql.P4)
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a video that look the same in other characters."""
    return look_alike_pairs(_texts(spark, sf_dir)).withColumnRenamed("kind", "rec_kind")


@REGISTRY.add("p4_forms", sql.P4_FORMS)
def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its one form."""
    return one_form(_texts(spark, sf_dir)).select(F.col("kind").alias("rec_kind"), "key", "form").distinct()


@REGISTRY.add("p5_found", sql.P5)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of slide reads with largely the same text."""
    links, members = near_duplicates(load(spark, sf_dir, "slide_out"), key="read_id", text="parsed.slide_text")
    return expand_pairs(links, members).select(F.col("a").alias("read_a"), F.col("b").alias("read_b")).distinct()


@REGISTRY.add("p5_groups", sql.P5_GROUPS)
def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every read of a page with its group, the least read that it's linked to, and the links of its text to different texts."""
    links, members = near_duplicates(load(spark, sf_dir, "slide_out"), key="read_id", text="parsed.slide_text")
    links = cut(links.select("a", "b"), "links")
    groups = connected_components(links)
    count = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    out = members.join(groups.withColumnRenamed("node", "rep"), "rep", "left").join(count, "rep", "left")
    return out.select(F.col("key").alias("read_id"), F.coalesce("component", "rep").alias("page"), F.coalesce("links", F.lit(0)).alias("links"))


@REGISTRY.add("p6_found", sql.P6)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments whose transcript repeats itself for at least 0.30 of its letters and digits."""
    shares = repeated_share(load(spark, sf_dir, "segments"), key="segment_id", text="transcript_raw")
    return shares.filter("kept > 0 AND share >= 0.30").select("segment_id").distinct()


@REGISTRY.add("p7_ids")
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(load(spark, sf_dir, "documents"), key="doc_id", text="text")


def _packed(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    sizes = token_sizes(load(spark, sf_dir, "documents"), key="doc_id", text="text")
    return pack(sizes, key="doc_id", size="tokens", capacity=4096, method=method)


@REGISTRY.add("p8_pack")
def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in containers of 4,096 tokens."""
    return _packed(spark, sf_dir, "best_fit")


@REGISTRY.add("p8_buckets")
def p8_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the named method alone, for comparison."""
    return _packed(spark, sf_dir, "buckets")


@REGISTRY.add("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mainly keywords, links, tags or labels."""
    return keyword_pages(load(spark, sf_dir, "documents"), key="doc_id", text="text").filter("spam").select("doc_id").distinct()
