"""Queries of provenance, chunks, corrections, states, quota, constraints and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..operators import corrections as C
from ..operators import invariants as V
from ..operators import provenance as P
from ..operators import state as St
from ..registry import Registry, load
from ..sources import captions
from ..sources.keyed import KeyedTable
from ..session import scratch
from .text import _FORMS, _SQL_ENTITIES, reads, sql_containment, sql_grams, sql_longest_common, sql_markdown, sql_split_long, sql_strip
from .timeline import cues, ends

REGISTRY = Registry()


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived blocks: descriptions of slides, the next segment of a video, and corrected transcripts.

    Every block carries the slide's text and the transcript that belong to it, of which one is its source.
    """
    none = F.lit(None).cast("string")
    part = lambda index, kind, source, text: (F.lit(index).alias("block_index"), F.lit(kind).alias("type"), F.lit(source).alias("kind"), F.col(text).alias("text"))
    kept = reads(spark, sf_dir)
    seg = load(spark, sf_dir, "segments").select("segment_id", "video_id", "slide_ref", "transcript_raw", "transcript_corrected").distinct()
    shown = kept.groupBy("video_id", F.col("slide_id").alias("slide_ref")).agg(F.min("slide_text").alias("slide_text"))
    said_at = seg.filter("slide_ref IS NOT NULL").groupBy("video_id", F.col("slide_ref").alias("slide_id")).agg(F.min("transcript_raw").alias("transcript"))
    slides = kept.filter("description IS NOT NULL").join(said_at, ["video_id", "slide_id"], "left").select("video_id", F.col("read_id").alias("segment_id"), *part(0, "圖表描述", "slide_ocr", "description"), "slide_text", "transcript", none.alias("corrected")).distinct()
    seg = seg.withColumn("_n", F.lead("transcript_raw").over(W.partitionBy("video_id").orderBy("segment_id"))).join(shown, ["video_id", "slide_ref"], "left")
    said = seg.filter("_n IS NOT NULL").select("video_id", "segment_id", *part(1, "口頭延伸", "transcript", "_n"), "slide_text", F.col("transcript_raw").alias("transcript"), F.col("_n").alias("corrected"))
    own = seg.filter("transcript_corrected IS NOT NULL").select("video_id", "segment_id", *part(2, "白話解說", "transcript", "transcript_corrected"), "slide_text", F.col("transcript_raw").alias("transcript"), F.col("transcript_corrected").alias("corrected"))
    return slides.unionByName(said).unionByName(own)


_BLOCKS = """sg AS (SELECT DISTINCT segment_id, video_id, slide_ref, transcript_raw, transcript_corrected FROM segments),
so AS (SELECT DISTINCT video_id, slide_id, read_id, parsed.slide_text AS slide_text, parsed.description AS description FROM slide_out),
sh AS (SELECT video_id, slide_id AS slide_ref, min(slide_text) AS slide_text FROM so GROUP BY ALL),
sa AS (SELECT video_id, slide_ref AS slide_id, min(transcript_raw) AS transcript FROM sg WHERE slide_ref IS NOT NULL GROUP BY ALL),
sn AS (SELECT *, lead(transcript_raw) OVER (PARTITION BY video_id ORDER BY segment_id) AS n FROM sg LEFT JOIN sh USING (video_id, slide_ref)),
bl AS (SELECT DISTINCT video_id, read_id AS segment_id, 0 AS block_index, '圖表描述' AS type, description AS text, coalesce(slide_text, '') AS source, coalesce(transcript, '') AS other, NULL AS corrected FROM so LEFT JOIN sa USING (video_id, slide_id) WHERE description IS NOT NULL
  UNION ALL SELECT video_id, segment_id, 1, '口頭延伸', n, coalesce(transcript_raw, ''), coalesce(slide_text, ''), n FROM sn WHERE n IS NOT NULL
  UNION ALL SELECT video_id, segment_id, 2, '白話解說', transcript_corrected, coalesce(transcript_raw, ''), coalesce(slide_text, ''), transcript_corrected FROM sn WHERE transcript_corrected IS NOT NULL)"""

_LIMIT = "CASE type WHEN '圖表描述' THEN 0.0 WHEN '口頭延伸' THEN 0.05 ELSE 0.10 END"


def _gate(src: str, g: str) -> str:
    return f"CASE WHEN CASE WHEN x = '' THEN 0.0 ELSE length({src}) / greatest(length(x), 1) END < 0.15 THEN 'short_source' WHEN {sql_containment('gt', g)} < {_LIMIT} THEN 'unlike' WHEN len(list_filter(ent, lambda e: len(list_filter(coalesce({_FORMS}[e], [e]), lambda w: contains({src}, w))) = 0)) > 0 THEN 'entities' ELSE '' END"


def sql_gates(rows: str) -> str:
    """CTEs that end in rl: verdicts of the blocks that ``rows`` names (video_id, segment_id, block_index, type, text, source, other, corrected)."""
    return f"""cl AS (SELECT *, row_number() OVER () AS k, {sql_strip('text')} AS x, {sql_strip('source')} AS s, {sql_strip('other')} AS o, {sql_strip("coalesce(corrected, '')")} AS c, {_SQL_ENTITIES.format(x='text')} AS ent FROM {rows}),
{sql_longest_common('cl')},
gr AS (SELECT *, {sql_grams('x')} AS gt, {sql_grams('s')} AS gs, {sql_grams('o')} AS go, {sql_grams('c')} AS gc, coalesce(n, 0) / greatest(length(x), 1) AS copied FROM cl LEFT JOIN lc USING (k)),
ga AS (SELECT *, {_gate('s', 'gs')} AS gate FROM gr),
vd AS (SELECT *, CASE WHEN gate = '' AND copied >= 0.98 THEN 'copy' ELSE gate END AS reason, gate <> '' AND block_index > 0 AND c <> '' AND corrected IS DISTINCT FROM source AND {_gate('c', 'gc')} = '' AS dep,
  gate <> '' AND o <> '' AND {sql_containment('gt', 'go')} >= {_LIMIT} AND {sql_containment('gt', 'go')} > 2 * {sql_containment('gt', 'gs')} AS wrong FROM ga),
rl AS (SELECT *, CASE WHEN reason = '' THEN 'verified' WHEN reason <> 'copy' THEN 'unverified' WHEN avg((reason = 'copy')::INT) OVER (PARTITION BY video_id, type) <= CASE type WHEN '圖表描述' THEN 0.5 ELSE 0.8 END THEN 'verified' ELSE 'degenerate_copy' END AS status FROM vd)"""


_GATES = f"{_BLOCKS}, {sql_gates('bl')}"


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the blocks, copies relaxed by type."""
    return P.relax_copies(P.check_blocks(blocks(spark, sf_dir)))


@REGISTRY.add("block_gates", f"WITH {_GATES} SELECT segment_id, block_index, round({sql_containment('gt', 'gs')}, 9) AS similarity, reason, CASE reason WHEN '' THEN 'verified' WHEN 'copy' THEN 'degenerate_copy' ELSE 'unverified' END AS status, dep AS depends_on_correction FROM vd")
def block_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first gate that each block fails."""
    v = P.check_blocks(blocks(spark, sf_dir))
    return v.select("segment_id", "block_index", F.round("similarity", 9).alias("similarity"), "reason", "status", "depends_on_correction")


@REGISTRY.add("block_verdicts", f"WITH {_GATES} SELECT segment_id, block_index, type, round({sql_containment('gt', 'gs')}, 9) AS similarity, round(copied, 9) AS copy_ratio, list_sort(list_distinct(list_filter(ent, lambda e: len(list_filter(coalesce({_FORMS}[e], [e]), lambda w: contains(s, w))) = 0))) AS missing, status, reason, wrong AS wrong_source, dep AS depends_on_correction FROM rl")
def block_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full verdicts, copies relaxed by type."""
    return verdicts(spark, sf_dir).select("segment_id", "block_index", "type", F.round("similarity", 9).alias("similarity"), F.round("copy_ratio", 9).alias("copy_ratio"), "missing", "status", "reason", "wrong_source", "depends_on_correction")


@REGISTRY.add("block_symbols")
def block_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols of blocks that their sources lack."""
    v = verdicts(spark, sf_dir).filter(F.size("fabricated_symbols") > 0)
    return v.select("segment_id", "block_index", "fabricated_symbols")


_VIDEO_VERDICTS = f"{_GATES}, vv AS (SELECT video_id, count(*) AS total, count(*) FILTER (status <> 'verified') AS bad, count(*) FILTER (status <> 'verified' AND wrong) AS wrong, count(*) FILTER (status <> 'verified' AND dep) AS dep, count(*) FILTER (status <> 'verified' AND NOT dep AND NOT wrong) AS rest FROM rl GROUP BY video_id)"


@REGISTRY.add("video_verdicts", f"WITH {_VIDEO_VERDICTS} SELECT video_id, total, bad AS unverified, round(bad / total, 9) AS ratio, round(1 - bad / total, 9) AS pass_rate, bad / total > 0.05 AS needs_review, wrong AS wrong_source, dep AS depends_on_correction, rest AS unresolved FROM vv")
def video_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per video; the count of symbols, which SQL can't find, is that of block_symbols."""
    return P.video_verdicts(verdicts(spark, sf_dir)).drop("with_symbols")


@REGISTRY.add("overall_rate", f"WITH {_VIDEO_VERDICTS} SELECT sum(total) AS total, sum(bad) AS unverified, round(sum(total - bad) / sum(total), 9) AS pass_rate FROM vv")
def overall_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.overall_rate(video_verdicts(spark, sf_dir))


@REGISTRY.add(
    "content_yield",
    f"""WITH {_BLOCKS}, se AS (SELECT DISTINCT segment_id, video_id, t_start, t_end, transcript_raw FROM segments),
    b AS (SELECT video_id, segment_id, count(*) AS n, sum(length(text)) AS ch FROM bl GROUP BY ALL),
    j AS (SELECT se.video_id, n, ch, t_end - t_start AS d, length(coalesce(transcript_raw, '')) AS l FROM se LEFT JOIN b USING (video_id, segment_id)),
    k AS (SELECT video_id, count(*) AS segments, count(n) AS used, coalesce(sum(n), 0) AS blocks, coalesce(sum(ch), 0) AS ch, greatest(sum(d) / 60, 1e-9) AS m, sum(l) AS l FROM j GROUP BY video_id)
    SELECT video_id, segments, used AS with_result, blocks, round_even(CASE WHEN used > 0 THEN blocks / used ELSE 0.0 END, 2) AS blocks_per_segment, round_even(ch / m, 1) AS chars_per_minute, round_even(CASE WHEN l > 0 THEN ch * 1000 / l ELSE 0.0 END, 1) AS chars_per_1k_source FROM k""",
)
def content_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.content_yield(cues(spark, sf_dir).withColumnRenamed("text", "transcript"), blocks(spark, sf_dir))


@REGISTRY.add(
    "chunks",
    f"""WITH {_GATES}, pl AS (SELECT segment_id, block_index, type, {sql_markdown('text')} AS p FROM rl WHERE status = 'verified'), pc AS (SELECT segment_id, block_index, type, {sql_split_long('p', 800)} AS p FROM pl WHERE p <> ''),
    un AS (SELECT segment_id, block_index, type, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS k FROM pc)
    SELECT segment_id || printf('#b%02d', block_index) || CASE WHEN k > 0 THEN '-' || k ELSE '' END AS chunk_id, segment_id, type, length(x) AS n_chars, substr(sha256(x), 1, 16) AS content_sha, list_sort(list_distinct(regexp_extract_all(x, '({'|'.join(fixed.REFERENTIAL)})'))) AS referential FROM un""",
)
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the blocks that pass the gates."""
    c = P.build_chunks(verdicts(spark, sf_dir))
    return c.select("chunk_id", "segment_id", "type", F.length("text").alias("n_chars"), "content_sha", "referential")


@REGISTRY.add(
    "replaced_orders",
    """SELECT o_custkey, count(*) AS n, round(sum(CASE WHEN o_custkey % 7 = 0 THEN 0.0 ELSE o_totalprice END), 2) AS total FROM orders WHERE NOT (o_custkey % 7 = 0 AND o_orderstatus <> 'O') AND o_custkey % 11 <> 0 GROUP BY o_custkey""",
)
def replaced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table after a write of all rows, a replacement of some customers' rows and a deletion of others'."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    table = KeyedTable(spark, scratch(spark, "keyed"), "o_custkey", "o_custkey bigint, o_orderkey bigint, o_orderstatus string, o_totalprice double", buckets=16)
    table.replace(o)
    some = o.filter("o_custkey % 7 = 0")
    table.replace(some.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.lit(0.0)), some)
    table.drop(o.filter("o_custkey % 11 = 0").select("o_custkey"))
    return table.read().groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# -- corrections ------------------------------------------------------------------------

_TERMS = "te AS (SELECT DISTINCT unnest(regexp_extract_all(parsed.slide_text, '[一-鿿]+')) AS term FROM slide_out WHERE parsed.slide_text IS NOT NULL)"


@REGISTRY.add("slide_lexicon", f"WITH {_TERMS} SELECT term FROM te WHERE length(term) BETWEEN 3 AND 12")
def slide_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.lexicon(reads(spark, sf_dir), text="slide_text")


@REGISTRY.add("proposed_corrections")
def proposed_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of transcripts that are nearly a lexicon term of 3 to 12 characters."""
    s = load(spark, sf_dir, "segments").filter("transcript_raw IS NOT NULL").select("segment_id", "transcript_raw").distinct()
    return C.propose(s, slide_lexicon(spark, sf_dir), key="segment_id", text="transcript_raw", similarity=0.75)


@REGISTRY.add(
    "read_set_scores",
    """WITH a AS (SELECT DISTINCT read_id, parsed.slide_text AS t FROM slide_raw), e AS (SELECT DISTINCT read_id, parsed.slide_text AS t FROM slide_out),
    n AS (SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM e)) AS tp, (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM e) AS ne),
    p AS (SELECT *, CASE WHEN na > 0 THEN tp / na ELSE (ne = 0)::INT END AS p, CASE WHEN ne > 0 THEN tp / ne ELSE (na = 0)::INT END AS r FROM n)
    SELECT tp, na - tp AS fp, ne - tp AS fn, round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 9) AS f1 FROM p""",
)
def read_set_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reads against kept reads as sets of (read, text)."""
    pick = lambda t: load(spark, sf_dir, t).select("read_id", F.col("parsed.slide_text").alias("t"))
    return C.set_scores(pick("slide_raw"), pick("slide_out"))


@REGISTRY.add("slide_class_accuracy", "WITH j AS (SELECT DISTINCT r.read_id, r.parsed.is_slide AS p, o.parsed.is_slide AS g FROM slide_raw r JOIN slide_out o USING (read_id)) SELECT count(*) AS n, round(avg((p = g)::INT), 9) AS accuracy FROM j WHERE p IS NOT NULL AND g IS NOT NULL")
def slide_class_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of the two reads on what is a slide."""
    raw, out = (load(spark, sf_dir, t).select("read_id", F.col("parsed.is_slide").alias(n)) for t, n in (("slide_raw", "p"), ("slide_out", "g")))
    j = raw.join(out, "read_id").distinct().filter("p IS NOT NULL AND g IS NOT NULL")
    return j.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("p") == F.col("g")).cast("int")), 9).alias("accuracy"))


@REGISTRY.add("read_time_error", "WITH j AS (SELECT DISTINCT r.read_id, r.sec AS p, o.sec AS g FROM slide_raw r JOIN slide_out o USING (read_id)) SELECT round(quantile_cont(abs(p - g), 0.5), 9) AS median_error, [round(x, 9) FOR x IN quantile_cont(abs(p - g), [0.0, 0.25, 0.5, 0.75, 1.0])] AS five FROM j WHERE p IS NOT NULL AND g IS NOT NULL")
def read_time_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median absolute error and five-number summary of read times."""
    raw, out = (load(spark, sf_dir, t).select("read_id", F.col("sec").alias(n)) for t, n in (("slide_raw", "p"), ("slide_out", "g")))
    d = raw.join(out, "read_id").distinct().select(F.abs(F.col("p") - F.col("g")).alias("d")).filter("d IS NOT NULL")
    five = F.percentile("d", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return d.agg(F.round(F.percentile("d", 0.5), 9).alias("median_error"), five.alias("five")).select("median_error", F.transform("five", lambda x: F.round(x, 9)).alias("five"))


# -- states and quota -------------------------------------------------------------------

_STAGES = ", ".join(f"'{s}'" for s in fixed.STAGE_NEEDS)
_STATES = f"st AS (SELECT video_id, stage, arg_max({{status: status, params_hash: params_hash}}, row(saved_at, status, coalesce(params_hash, ''))) AS b FROM stage_records WHERE stage IN ({_STAGES}) GROUP BY ALL), cs AS (SELECT video_id, stage, b.status AS status, b.params_hash AS params_hash FROM st), wn AS (SELECT stage, min(params_hash) AS want FROM stage_records WHERE stage IN ({_STAGES}) GROUP BY stage)"


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = load(spark, sf_dir, "stage_records").select("video_id", "stage", "status", "params_hash", "saved_at", *[F.lit(None).cast("string").alias(c) for c in ("finished_at", "error", "note")])
    return St.current_states(log)


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = load(spark, sf_dir, "stage_records")
    return log.filter(F.col("stage").isin(list(fixed.STAGE_NEEDS))).groupBy("stage").agg(F.min("params_hash").alias("want"))


@REGISTRY.add("stage_closure", f"""WITH RECURSIVE d(stage, need) AS (VALUES {", ".join(f"('{s}', '{u}')" for s, up in fixed.STAGE_NEEDS.items() for u in up)}),
c AS (SELECT need AS stage, stage AS affected FROM d UNION SELECT c.stage, d.stage FROM c JOIN d ON d.need = c.affected) SELECT stage, affected FROM c""")
def stage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.stage_graph(spark)


@REGISTRY.add("current_states", f"WITH {_STATES} SELECT cs.video_id, cs.stage, status, params_hash, coalesce(status = 'done' AND params_hash = want, false) AS satisfied FROM cs JOIN wn USING (stage)")
def current_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _states(spark, sf_dir).join(_wanted(spark, sf_dir), "stage")
    return s.select("video_id", "stage", "status", "params_hash", St.satisfied(F.col("status"), F.col("params_hash"), F.col("want")).alias("satisfied"))


_AFFECTED = ", ".join(f"('{s}', '{x}')" for s, d in St.downstream().items() for x in [s, *d])


@REGISTRY.add("stale_stages", f"WITH {_STATES}, af(stage, affected) AS (VALUES {_AFFECTED}), h AS (SELECT DISTINCT video_id, affected AS stage FROM cs JOIN wn USING (stage) JOIN af USING (stage) WHERE params_hash IS NOT NULL AND params_hash <> want) SELECT video_id, stage FROM cs JOIN h USING (video_id, stage)")
def stale_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages to run again once every stage wants its least parameter hash."""
    return St.stale_stages(_states(spark, sf_dir), _wanted(spark, sf_dir))


@REGISTRY.add("ready_videos", f"WITH {_STATES} SELECT cs.video_id FROM cs JOIN wn USING (stage) WHERE stage = 'S3' AND status = 'done' AND params_hash = want AND video_id IN (SELECT video_id FROM segments)")
def ready_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.ready_for(_states(spark, sf_dir), _wanted(spark, sf_dir), "S3", load(spark, sf_dir, "segments"))


@REGISTRY.add(
    "cached_reads",
    """WITH i AS (SELECT DISTINCT read_id, substr(sha256(read_id || '|' || parsed.slide_text), 1, 16) AS fp FROM slide_raw), c AS (SELECT DISTINCT read_id, substr(sha256(read_id || '|' || parsed.slide_text), 1, 16) AS fp FROM slide_out)
    SELECT read_id, EXISTS (SELECT 1 FROM c WHERE c.read_id = i.read_id AND c.fp = i.fp) AS hit FROM i""",
)
def cached_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which first reads a cache of kept reads answers."""
    pick = lambda t: reads(spark, sf_dir, t).select("read_id", T.fingerprint(F.col("read_id"), F.col("slide_text")).alias("fp")).distinct()
    hits, misses = St.cache_split(pick("slide_raw"), pick("slide_out"), ["read_id", "fp"])
    return hits.select("read_id", F.lit(True).alias("hit")).unionByName(misses.select("read_id", F.lit(False).alias("hit")))


_DAY = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')::DATE"


@REGISTRY.add(
    "quota_usage",
    f"""WITH u AS (SELECT {_DAY} AS d, event_type AS model, count(*) AS requests FROM events GROUP BY ALL),
    l AS (SELECT event_type AS model, arg_max(greatest(1, value::INT), row(ts, greatest(1, value::INT))) AS lim FROM events WHERE event_type = 'error' AND value IS NOT NULL GROUP BY ALL)
    SELECT d AS quota_day, model, requests, coalesce(lim, 20) AS "limit", floor(coalesce(lim, 20) * 0.9)::INT AS safe_limit, greatest(0, floor(coalesce(lim, 20) * 0.9)::INT - requests) AS remaining FROM u LEFT JOIN l USING (model)""",
)
def quota_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by day and model, and what is left; errors tell the limit."""
    e = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    seen = e.filter("event_type = 'error' AND value IS NOT NULL").select(F.col("event_type").alias("model"), F.greatest(F.lit(1), F.round("value").cast("int")).alias("limit"), F.col("ts").alias("observed_at"))
    return St.remaining(St.usage_by_day(e, time="ts", model="event_type"), St.observed_limits(seen))


@REGISTRY.add("quota_resets", f"SELECT DISTINCT {_DAY} AS quota_day, (({_DAY} + 1)::TIMESTAMP AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC') AS reset_at FROM events")
def quota_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("ts").cast("timestamp")
    return load(spark, sf_dir, "events").select(St.quota_day(t).alias("quota_day"), St.next_reset(t).alias("reset_at")).distinct()


@REGISTRY.add("allowed_requests", f"SELECT event_id, row_number() OVER (PARTITION BY {_DAY} ORDER BY ts, event_id) <= 200 AS allowed FROM events")
def allowed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a request is among the first 200 of its quota day."""
    e = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return St.within_budget(e, time="ts", order="event_id", budget=200).select("event_id", "allowed")


# -- constraints --------------------------------------------------------------------------


@REGISTRY.add(
    "violations",
    f"""WITH c AS (SELECT DISTINCT segment_id, video_id, t_start, t_end FROM segments), e AS (SELECT video_id, max(duration) AS d FROM videos WHERE duration IS NOT NULL GROUP BY video_id),
    o AS (SELECT c.*, lag(t_end) OVER w AS b, lead(segment_id) OVER w IS NULL AS last FROM c WINDOW w AS (PARTITION BY video_id ORDER BY t_start, segment_id)),
    m AS (SELECT video_id, unnest(cue_indices) AS m FROM (SELECT DISTINCT segment_id, video_id, cue_indices FROM segments)),
    r AS (SELECT DISTINCT segment_id, video_id, slide_ref FROM segments WHERE slide_ref IS NOT NULL), t AS (SELECT DISTINCT video_id, slide_id FROM slide_out)
    SELECT 'disjoint' AS rule, video_id AS entity, segment_id AS detail FROM o WHERE t_start < b - 1e-6
    UNION ALL SELECT 'gap_before', video_id, segment_id FROM o JOIN e USING (video_id) WHERE t_start - coalesce(b, 0.0) > 1
    UNION ALL SELECT 'gap_at_end', video_id, segment_id FROM o JOIN e USING (video_id) WHERE last AND d - t_end > 1
    UNION ALL SELECT 'held_twice', video_id, m::VARCHAR FROM m GROUP BY video_id, m HAVING count(*) > 1
    UNION ALL SELECT 'slide_ref', video_id, segment_id FROM r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.video_id = r.video_id AND t.slide_id = r.slide_ref)
    UNION ALL SELECT 'boundary_video', video_id, boundary_id::VARCHAR FROM (SELECT DISTINCT video_id, boundary_id FROM golden_boundaries) g WHERE video_id NOT IN (SELECT video_id FROM videos)
    UNION ALL SELECT 'out_of_range', video_id, segment_id FROM c LEFT JOIN e USING (video_id) WHERE t_start < 0 OR t_end <= t_start OR coalesce(t_end > d + 1, false)
    UNION ALL SELECT 'blank_transcript', video_id, segment_id FROM (SELECT DISTINCT segment_id, video_id, transcript_raw FROM segments) s WHERE {sql_strip("coalesce(transcript_raw, '')")} = ''""",
)
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All violations of the segments' and boundaries' constraints."""
    c, e = cues(spark, sf_dir), ends(spark, sf_dir)
    seg = load(spark, sf_dir, "segments").select("segment_id", "video_id", "cue_indices", "slide_ref").distinct()
    span = dict(entity="video_id", key="segment_id", span=("t_start", "t_end"))
    slides = load(spark, sf_dir, "slide_out").select("video_id", "slide_id")
    golden = load(spark, sf_dir, "golden_boundaries").select("video_id", "boundary_id").distinct()
    return V.check_all(
        V.disjoint(c, **span),
        V.covering(c, e, **span, end="duration"),
        V.assigned_once(seg, entity="video_id", members="cue_indices"),
        V.resolvable(seg, slides, on={"video_id": "video_id", "slide_ref": "slide_id"}, rule="slide_ref", entity="video_id", key="segment_id"),
        V.resolvable(golden, load(spark, sf_dir, "videos"), on={"video_id": "video_id"}, rule="boundary_video", entity="video_id", key="boundary_id"),
        V.in_range(c, e, **span, end="duration"),
        V.not_blank(c, column="text", rule="blank_transcript", entity="video_id", key="segment_id"),
    )


@REGISTRY.add(
    "chunk_violations",
    """WITH d AS (SELECT DISTINCT doc_id::VARCHAR AS chunk_id, video_id, lang, text, substr(sha256(CASE WHEN doc_id % 5 = 0 THEN coalesce(text, '') || '!' ELSE text END), 1, 16) AS sha FROM documents)
    SELECT 'incomplete' AS rule, video_id AS entity, chunk_id AS detail FROM d WHERE video_id IS NULL OR lang IS NULL OR text IS NULL UNION ALL SELECT 'hash', video_id, chunk_id FROM d WHERE sha IS DISTINCT FROM substr(sha256(text), 1, 16)""",
)
def chunk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks: fields that lack, and hashes (of every fifth) that aren't the text's."""
    d = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "video_id", "lang", "text", "doc_id").distinct()
    d = d.withColumn("content_sha", T.content_sha(F.when(F.col("doc_id") % 5 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text"))))
    return V.complete_chunks(d.drop("doc_id"), required=["video_id", "lang", "text"])


# -- sources ----------------------------------------------------------------------------


@REGISTRY.add("video_targets", "SELECT DISTINCT video_id, nullif(regexp_extract(url, 'v=([A-Za-z0-9_-]{11})', 1), '') AS target FROM videos")
def video_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "videos").select("video_id", captions.parse_target(F.col("url"))["video_id"].alias("target")).distinct()


@REGISTRY.add(
    "caption_cues",
    f"""WITH c AS (SELECT DISTINCT segment_id, video_id, floor(t_start)::INT AS a, floor(t_end)::INT AS b, trim(regexp_replace(regexp_replace(transcript_raw, '<[^>]+>', '', 'g'), '[\\s\\x{{0B}}\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g')) AS x FROM segments WHERE transcript_raw IS NOT NULL)
    SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY segment_id) - 1 AS index, a::DOUBLE AS t_start, b::DOUBLE AS t_end, length(x) AS n_chars FROM c WHERE x <> ''""",
)
def caption_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption files made of the transcripts, read again."""
    c = cues(spark, sf_dir).filter("text IS NOT NULL")
    stamp = lambda s: F.concat(T.clock(F.col(s)), F.lit(".000"))
    cue = F.concat_ws("\n", F.concat(stamp("t_start"), F.lit(" --> "), stamp("t_end")), F.regexp_replace("text", r"[\r\n]+", " "), F.lit(""))
    files = c.groupBy("video_id").agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_id", cue.alias("x")))), lambda r: r["x"]), "\n")).alias("content"))
    return captions.parse_captions(files, entity="video_id", content="content").select("video_id", "index", "t_start", "t_end", F.length("text").alias("n_chars"))


@REGISTRY.add(
    "picked_captions",
    """WITH v AS (SELECT DISTINCT video_id, caption_lang, has_manual_caption, has_auto_caption FROM videos),
    t AS (SELECT video_id, caption_lang AS lang, true AS m FROM v WHERE has_manual_caption UNION ALL SELECT video_id, caption_lang, false FROM v WHERE has_auto_caption),
    k AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY NOT m, CASE lang WHEN 'zh-TW' THEN 1 WHEN 'zh-Hant' THEN 2 ELSE 3 END) AS n FROM t WHERE lang IN ('zh-TW', 'zh-Hant', 'zh'))
    SELECT video_id, lang, m AS manual FROM k WHERE n = 1""",
)
def picked_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = load(spark, sf_dir, "videos").select("video_id", F.col("caption_lang").alias("lang"), F.explode(F.array(F.when(F.col("has_manual_caption"), True), F.when(F.col("has_auto_caption"), False))).alias("manual")).filter("manual IS NOT NULL").distinct()
    return captions.pick_caption(v, entity="video_id", lang="lang", manual="manual", order=["zh-TW", "zh-Hant", "zh"])


@REGISTRY.add(
    "series_rollup",
    """WITH v AS (SELECT DISTINCT video_id, series_id, has_manual_caption, duration FROM videos)
    SELECT coalesce(series_id, '?') AS series, has_manual_caption AS manual, grouping(coalesce(series_id, '?'), has_manual_caption) AS level, count(*) AS videos, round(sum(duration), 3) AS seconds FROM v GROUP BY ROLLUP (coalesce(series_id, '?'), has_manual_caption)""",
)
def series_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos and time by series and kind of captions, with totals."""
    v = load(spark, sf_dir, "videos").select("video_id", F.coalesce("series_id", F.lit("?")).alias("series"), F.col("has_manual_caption").alias("manual"), "duration").distinct()
    return v.rollup("series", "manual").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("videos"), F.round(F.sum("duration"), 3).alias("seconds"))


@REGISTRY.add(
    "archive_manifest",
    """WITH s AS (SELECT DISTINCT segment_id, video_id, coalesce(transcript_corrected, transcript_raw, '') AS t, coalesce(len(cue_indices), 0) AS c FROM segments)
    SELECT video_id, count(*) AS segments, sum(c) AS cues, sum(length(t)) AS chars FROM s GROUP BY video_id""",
)
def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "segments").select("segment_id", "video_id", F.coalesce("transcript_corrected", "transcript_raw", F.lit("")).alias("t"), F.coalesce(F.size(F.coalesce("cue_indices", F.array().cast("array<int>"))), F.lit(0)).alias("c")).distinct()
    return s.groupBy("video_id").agg(F.count(F.lit(1)).alias("segments"), F.sum("c").alias("cues"), F.sum(F.length("t")).alias("chars"))


@REGISTRY.add("term_index", "WITH p AS (SELECT DISTINCT read_id, video_id, string_split_regex(parsed.slide_text, '[\\s\\x{0B}，、。；：:;,.（）()【】「」|/]+') AS parts FROM slide_out WHERE parsed.slide_text IS NOT NULL), u AS (SELECT DISTINCT read_id, video_id, unnest(parts) AS term FROM p), c AS (SELECT video_id, term, count(*) AS n FROM u WHERE length(term) BETWEEN 2 AND 12 GROUP BY ALL) SELECT video_id, term, n, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, term) AS place FROM c")
def term_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of each video's slides by frequency."""
    t = reads(spark, sf_dir).filter("slide_text IS NOT NULL").select("read_id", "video_id", F.explode(T.terms(F.col("slide_text"), limit=1_000_000)).alias("term")).distinct()
    c = t.groupBy("video_id", "term").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("place", F.row_number().over(W.partitionBy("video_id").orderBy(F.col("n").desc(), "term")))
