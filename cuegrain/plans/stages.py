"""Queries of stages in one piece, transitions of states, and small operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corrections as C
from ..operators import grouping as G
from ..operators import intervals as I
from ..operators import invariants as V
from ..operators import segmentation as S
from ..operators import signals as Sg
from ..operators import stages as K
from ..operators import state as St
from ..operators import survey as Y
from ..registry import Registry, load
from ..session import scratch
from ..sources import captions
from ..sources.keyed import KeyedTable, lines_without
from .composed import _TRIM
from .pipeline import _GATES, _STATES, _VIDEO_VERDICTS, _states, _wanted, archive_manifest, blocks, verdicts
from .signals import _CHANGE_SECTIONS, series
from .text import reads, sql_containment
from .timeline import _CUES, _ENDS, cues, ends, marks

REGISTRY = Registry()


# -- payloads and calls ----------------------------------------------------------------


@REGISTRY.add(
    "understood_blocks",
    """WITH r AS (SELECT DISTINCT read_id, slide_id, sec, parsed.is_slide AS i, parsed.slide_text AS s, parsed.description AS d, parsed.reject_reason AS j FROM slide_out WHERE parsed IS NOT NULL),
    b AS (SELECT read_id, slide_id, sec, i, s, d, unnest([{p: 0, t: '圖表描述', x: d, k: 'slide_ocr'}, {p: 1, t: '白話解說', x: j, k: 'transcript'}, {p: 2, t: 'other', x: s, k: 'slide_ocr'}, {p: 3, t: '口頭延伸', x: d, k: ''}, {p: 4, t: '口頭延伸', x: 'A ' || s, k: 'transcript'}]) AS b FROM r),
    c AS (SELECT *, CASE WHEN b.k = '' THEN 'no_kind' WHEN b.k = 'slide_ocr' AND (NOT i OR coalesce(s, '') = '') THEN 'no_slide' WHEN b.k = 'transcript' AND trim(regexp_replace(coalesce(d, ''), '\\s+', '', 'g')) = '' THEN 'no_transcript' WHEN b.t = 'other' OR b.x IS NULL THEN 'malformed' END AS dropped FROM b)
    SELECT read_id, b.p AS position, CASE WHEN dropped IS NULL THEN count(*) FILTER (dropped IS NULL) OVER (PARTITION BY read_id, slide_id, sec, i, s, d ORDER BY b.p) - 1 END AS block_index, b.t AS type, b.k AS kind, length(b.x) > 0 AS has_text, CASE WHEN dropped IS NULL THEN CASE b.k WHEN 'slide_ocr' THEN slide_id ELSE printf('%.1fs-%.1fs', sec, sec + 1) END END AS ref, dropped FROM c""",
)
def understood_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that a model's answers hold, and why others are dropped."""
    r = load(spark, sf_dir, "slide_out").filter("parsed IS NOT NULL").select("read_id", "slide_id", "sec", "parsed.*").distinct()
    part = lambda kind, text, source: F.struct(F.lit(kind).alias("type"), text.alias("text"), F.lit(source).alias("provenance_kind"))
    answer = F.to_json(F.struct(F.array(part("圖表描述", F.col("description"), "slide_ocr"), part("白話解說", F.col("reject_reason"), "transcript"), part("other", F.col("slide_text"), "slide_ocr"), part("口頭延伸", F.col("description"), ""), part("口頭延伸", F.concat(F.lit("A "), F.col("slide_text")), "transcript")).alias("content_blocks")))
    rows = r.select("read_id", "slide_id", F.when(F.col("is_slide"), F.col("slide_text")).alias("slide_text"), F.col("description").alias("transcript"), F.col("sec").alias("t_start"), (F.col("sec") + 1).alias("t_end"), answer.alias("answer"))
    rows = rows.withColumn("key", F.concat_ws("|", "read_id", F.xxhash64("answer", "t_start").cast("string")))
    b = K.understood_blocks(K.parse_payload(rows, "answer"), key="key")
    return b.select(F.regexp_extract("key", r"^(.*)\|-?\d+$", 1).alias("read_id"), "position", "block_index", "type", "kind", (F.length("text") > 0).alias("has_text"), "ref", "dropped")


@REGISTRY.add(
    "batched_understanding",
    """WITH s AS (SELECT DISTINCT segment_id, video_id, coalesce(transcript_raw, '') AS x, transcript_corrected IS NOT NULL AS hit FROM segments),
    b AS (SELECT *, (row_number() OVER (PARTITION BY video_id ORDER BY segment_id) - 1) // 3 AS b FROM s),
    w AS (SELECT *, bool_and(hit) OVER p AS kept, count(*) OVER p AS n, bool_or(length(x) % 7 <> 0) OVER p AS answered FROM b WINDOW p AS (PARTITION BY video_id, b)),
    r AS (SELECT segment_id, length(x)::VARCHAR AS result, CASE WHEN kept THEN 'cache' WHEN n = 1 OR length(x) % 7 <> 0 THEN 'batch' WHEN answered THEN 'refill' END AS source FROM w)
    SELECT segment_id, CASE source WHEN 'cache' THEN 'kept ' ELSE '' END || result AS result, source FROM r WHERE source IS NOT NULL""",
)
def batched_understanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in batches of three through a stand-in for a model that answers with a length and leaves some out."""
    s = load(spark, sf_dir, "segments").select("segment_id", "video_id", F.coalesce("transcript_raw", F.lit("")).alias("text"), "transcript_corrected").distinct().withColumn("fp", T.fingerprint(F.col("segment_id"), F.col("text")))
    cache = s.filter("transcript_corrected IS NOT NULL").select("segment_id", "fp", F.concat(F.lit("kept "), F.length("text").cast("string")).alias("result"), F.lit("").alias("summary"))

    def call(batch: pd.DataFrame, before: str | None) -> pd.DataFrame:
        size = batch["text"].str.len()
        answered = batch[(size % 7 != 0) | (len(batch) == 1)]
        return pd.DataFrame({"segment_id": answered["segment_id"], "result": answered["text"].str.len().astype(str), "summary": f"after {before}"})

    return K.understand(s.drop("transcript_corrected"), cache, call, entity="video_id", key="segment_id", order="segment_id", fingerprint="fp").select("segment_id", "result", "source")


# -- rendering --------------------------------------------------------------------------


@REGISTRY.add("unverified_rows", f"WITH {_GATES} SELECT segment_id, block_index, type, status, round({sql_containment('gt', 'gs')}, 4) AS similarity, wrong AS wrong_source, dep AS depends_on_correction, reason FROM rl WHERE status <> 'verified'")
def unverified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks for a person to look at."""
    return K.unverified_rows(verdicts(spark, sf_dir)).select("segment_id", "block_index", "type", "status", "similarity", "wrong_source", "depends_on_correction", "reason")


@REGISTRY.add(
    "rendered_records",
    f"""WITH {_VIDEO_VERDICTS}, {_CUES}, bq AS (SELECT video_id, segment_id, count(*) AS n, sum(length(text)) AS ch FROM bl GROUP BY ALL),
    yl AS (SELECT c.video_id, count(*) AS segments, sum(ch) AS ch, sum(length(coalesce(c.text, ''))) AS l FROM c LEFT JOIN bq USING (video_id, segment_id) GROUP BY ALL)
    SELECT video_id, total AS blocks_checked, total - bad AS verified, round(1 - bad / total, 4) AS pass_rate, wrong AS wrong_source, dep AS depends_on_correction, rest AS unresolved, segments, round_even(CASE WHEN l > 0 THEN coalesce(ch, 0) * 1000 / l ELSE 0.0 END, 1) AS chars_per_1k_source FROM vv JOIN yl USING (video_id)""",
)
def rendered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendering into its sinks, twice, as a second run replaces the first; the records as they are then read."""
    segments = cues(spark, sf_dir).withColumnRenamed("text", "transcript").withColumn("url", F.lit("https://video.example/"))
    b = blocks(spark, sf_dir)
    v = verdicts(spark, sf_dir)
    kinds = lambda df: ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    from ..operators.provenance import build_chunks

    schemas = {"unverified": kinds(K.unverified_rows(v)), "provenance": kinds(K.provenance_records(v, segments)), "chunks": kinds(build_chunks(v)), "reports": "video_id string, markdown string"}
    at = scratch(spark, "render")
    sinks = K.Sinks(**{name: KeyedTable(spark, f"{at}/{name}", "video_id", schema) for name, schema in schemas.items()})
    for _ in range(2):
        K.render(b, segments, sinks)
    return sinks.provenance.read().select("video_id", "blocks_checked", "verified", "pass_rate", "wrong_source", "depends_on_correction", "unresolved", "segments", "chars_per_1k_source")


@REGISTRY.add("label_agreement", f"WITH {_GATES}, m AS (SELECT status, type, {sql_containment('gt', 'gs')} AS a, {sql_containment('gt', 'go')} AS b FROM rl) SELECT status, type, count(*) AS n, round(avg(a), 6) AS own, round(avg(b), 6) AS other, round(avg((b > a)::INT), 6) AS other_fits_better FROM m GROUP BY ALL")
def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How blocks of each verdict agree with their source and with the segment's other text."""
    v = verdicts(spark, sf_dir)
    other = F.coalesce(F.when(F.col("kind") == "slide_ocr", F.col("transcript")).otherwise(F.col("slide_text")), F.lit(""))
    return Y.label_agreement(v.withColumn("other", T.containment(F.col("text"), other)), groups=["status", "type"], own="similarity", other="other")


# -- states -----------------------------------------------------------------------------

_BELOW = """RECURSIVE nd(stage, need) AS (VALUES {needs}), af AS (SELECT need AS stage, stage AS affected FROM nd UNION SELECT af.stage, nd.stage FROM af JOIN nd ON nd.need = af.affected)"""


def _below() -> str:
    from ..functions import fixed

    return _BELOW.format(needs=", ".join(f"('{s}', '{u}')" for s, up in fixed.STAGE_NEEDS.items() for u in up))


@REGISTRY.add(
    "synced_states",
    f"""WITH {_below()}, {_STATES}, chg AS (SELECT video_id, stage FROM cs JOIN wn USING (stage) WHERE params_hash IS NOT NULL AND params_hash <> want),
    lo AS (SELECT DISTINCT video_id, affected AS stage FROM chg JOIN af USING (stage))
    SELECT video_id, stage, CASE WHEN lo.stage IS NOT NULL THEN 'pending' ELSE status END AS status, CASE WHEN lo.stage IS NULL AND chg.stage IS NULL THEN params_hash END AS params_hash FROM cs LEFT JOIN lo USING (video_id, stage) LEFT JOIN chg USING (video_id, stage)""",
)
def synced_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States once changed parameters have been written back: saved as new versions and read again."""
    s = _states(spark, sf_dir)
    log = St.saved(s, St.synced(s, _wanted(spark, sf_dir)).drop("invalidated"), F.lit("2100-01-01").cast(dict(s.dtypes)["saved_at"]))
    return St.current_states(log).select("video_id", "stage", "status", "params_hash")


@REGISTRY.add(
    "marked_states",
    f"""WITH {_below()}, {_STATES}, ev AS (SELECT video_id, stage, CASE status WHEN 'failed' THEN 'done' WHEN 'skipped' THEN 'stale' ELSE 'failed' END AS event FROM cs WHERE stage IN ('S1a', 'S3')),
    lo AS (SELECT DISTINCT video_id, stage FROM (SELECT video_id, stage FROM ev WHERE event = 'stale' UNION SELECT video_id, affected FROM ev JOIN af USING (stage) WHERE event = 'stale')),
    st2 AS (SELECT video_id, stage, lo.stage IS NOT NULL AS gone, event, status, params_hash FROM cs LEFT JOIN ev USING (video_id, stage) LEFT JOIN lo USING (video_id, stage))
    SELECT video_id, stage, CASE WHEN event IN ('done', 'failed') THEN event WHEN gone THEN 'pending' ELSE status END AS status, CASE WHEN event = 'done' THEN 'new' WHEN event = 'failed' THEN params_hash WHEN gone THEN NULL ELSE params_hash END AS params_hash FROM st2""",
)
def marked_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States after some stages were done, failed or found stale."""
    s = _states(spark, sf_dir)
    none = lambda c: F.lit(None).cast("string").alias(c)
    event = F.when(F.col("status") == "failed", "done").when(F.col("status") == "skipped", "stale").otherwise("failed")
    e = s.filter("stage IN ('S1a', 'S3')").select("video_id", "stage", event.alias("event"), F.lit("new").alias("params_hash"), none("finished_at"), none("error"), none("note"))
    return St.current_states(St.saved(s, St.marked(s, e), F.lit("2100-01-01").cast(dict(s.dtypes)["saved_at"]))).select("video_id", "stage", "status", "params_hash")


# -- surveys ----------------------------------------------------------------------------


@REGISTRY.add(
    "video_profiles",
    f"""WITH RECURSIVE {_CHANGE_SECTIONS}, w AS (SELECT user_id, median(("end" - start) / 1.0) AS m, min("end" - start) AS lo, max("end" - start) AS hi, count(*) AS n FROM f GROUP BY ALL), c AS (SELECT user_id, count(*) AS rows FROM x GROUP BY ALL)
    SELECT user_id, round(m, 6) AS dwell_median, lo::DOUBLE AS dwell_min, hi::DOUBLE AS dwell_max, n AS section_count, round(n / (rows / 60), 6) AS density FROM w JOIN c USING (user_id)""",
)
def video_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dwell times and density of each series' sections, beside its profile."""
    s = series(spark, sf_dir)
    rows = Sg.drop_short(Sg.sections(s, Sg.viterbi_changes(s, entity="user_id", order="event_id", distance="d"), entity="user_id", order="event_id"), entity="user_id", least=3)
    p = K.video_profiles(Sg.series_profile(s, entity="user_id", value="value"), rows, entity="user_id", fps=1.0)
    return p.select("user_id", F.round("dwell_median", 6).alias("dwell_median"), "dwell_min", "dwell_max", "section_count", F.round("density", 6).alias("density"))


@REGISTRY.add("reference_counts", "WITH v AS (SELECT DISTINCT video_id FROM slide_out WHERE parsed.is_slide) SELECT video_id, (SELECT count(*) FROM v) - 1 AS \"references\" FROM v")
def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many other videos have slides to compare with."""
    return K.reference_counts(load(spark, sf_dir, "slide_out").filter("parsed.is_slide"), entity="video_id")


@REGISTRY.add(
    "recurring_slides",
    """WITH n AS (SELECT DISTINCT o_custkey % 40 AS video, o_orderkey, (o_orderkey % 1000) / 1000 AS score FROM orders), k AS (SELECT DISTINCT o_custkey % 40 AS video FROM orders WHERE o_custkey % 40 < 12)
    SELECT o_orderkey, score FROM n JOIN k USING (video) WHERE score < 0.06 AND (SELECT count(*) - 1 FROM k) >= 2""",
)
def recurring_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as slides with a distance to another episode: those that recur in episodes that have others to tell by."""
    n = load(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("video"), "o_orderkey", ((F.col("o_orderkey") % 1000) / 1000).alias("score"))
    return K.recurring(n.distinct(), n.filter("video < 12"), entity="video", limit=0.06)[0].select("o_orderkey", "score")


@REGISTRY.add(
    "manifest_differences",
    """WITH s AS (SELECT DISTINCT segment_id, video_id, transcript_raw, coalesce(transcript_corrected, transcript_raw, '') AS t, coalesce(len(cue_indices), 0) AS c FROM segments),
    a AS (SELECT video_id, count(*) AS segments, sum(c) AS cues, sum(length(t)) AS chars FROM s GROUP BY ALL), b AS (SELECT video_id, count(*) FILTER (transcript_raw IS NOT NULL) AS segments, sum(c) AS cues, sum(length(coalesce(transcript_raw, ''))) AS chars FROM s GROUP BY ALL),
    u AS (SELECT video_id, unnest(['segments', 'cues', 'chars']) AS field, unnest([a.segments, a.cues, a.chars])::BIGINT::VARCHAR AS now, unnest([b.segments, b.cues, b.chars])::BIGINT::VARCHAR AS "then" FROM a JOIN b USING (video_id)) SELECT * FROM u WHERE now IS DISTINCT FROM "then\"""",
)
def manifest_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive's manifest against that of the raw transcripts."""
    s = load(spark, sf_dir, "segments").select("segment_id", "video_id", "transcript_raw", "transcript_corrected", "cue_indices").distinct()
    raw = s.groupBy("video_id").agg(F.count("transcript_raw").alias("segments"), F.sum(F.coalesce(F.size(F.coalesce("cue_indices", F.array().cast("array<int>"))), F.lit(0))).alias("cues"), F.sum(F.length(F.coalesce("transcript_raw", F.lit("")))).alias("chars"))
    return Y.manifest_differences(archive_manifest(spark, sf_dir), raw, key="video_id")


# -- boundaries -------------------------------------------------------------------------


@REGISTRY.add("body_boundaries", f"WITH {_ENDS}, g AS (SELECT DISTINCT video_id, t FROM golden_boundaries WHERE status = 'confirmed' AND t IS NOT NULL) SELECT g.video_id, t FROM g LEFT JOIN e USING (video_id) WHERE duration IS NULL OR t BETWEEN duration * 0.1 AND duration * 0.9")
def body_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed boundaries in the middle four fifths of their video."""
    body = ends(spark, sf_dir).select("video_id", (F.col("duration") * 0.1).alias("body_start"), (F.col("duration") * 0.9).alias("body_end"))
    return I.in_body(marks(spark, sf_dir), body, entity="video_id", time="t").select("video_id", "t")


@REGISTRY.add("hybrid_boundaries", "WITH g AS (SELECT DISTINCT video_id, t FROM golden_boundaries WHERE status = 'confirmed' AND t IS NOT NULL) SELECT video_id, t FROM g WHERE EXISTS (SELECT 1 FROM segments s WHERE s.video_id = g.video_id AND abs(s.t_start - g.t) <= 2.0)")
def hybrid_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed boundaries that a segment's start bears out within two seconds."""
    return I.near_any(marks(spark, sf_dir), cues(spark, sf_dir), entity="video_id", time="t", mark_time="t_start", tolerance=2.0)


@REGISTRY.add("merge_accuracy", "WITH p AS (SELECT video_id, count(DISTINCT slide_ref) AS n FROM segments GROUP BY ALL), g AS (SELECT video_id, count(DISTINCT slide_id) AS n FROM slide_out GROUP BY ALL) SELECT count(*) AS n, round(avg((p.n = g.n)::INT), 9) AS accuracy FROM p JOIN g USING (video_id)")
def merge_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of videos whose segments name as many slides as were kept."""
    count = lambda t, c, n: load(spark, sf_dir, t).groupBy("video_id").agg(F.count_distinct(c).alias(n))
    return S.merge_accuracy(count("segments", "slide_ref", "p"), count("slide_out", "slide_id", "g"), entity="video_id", predicted="p", true="g")


@REGISTRY.add("candidate_cuts")
def candidate_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-cost cuts between blocks of 40 characters among the topic gaps' valleys."""
    b = S.blocks(cues(spark, sf_dir), entity="video_id", order="segment_id", time="t_start", text="text", least=40)
    scores = S.gap_scores(b, entity="video_id", window=3)
    valleys = S.depth_cuts(scores, entity="video_id", order="i", score="score", alpha=0.0).select("video_id", (F.col("i") + 1).alias("cut"))
    return S.description_length_cuts(b, entity="video_id", prior=20.0, candidates=valleys)


# -- text and corrections ---------------------------------------------------------------

# Simplified characters and the traditional ones they stand for, one for one.
SIMPLIFIED = {"这": "這", "说": "說", "们": "們", "为": "為", "从": "從", "请": "請", "谁": "誰", "吗": "嗎", "让": "讓", "讲": "講", "问": "問", "会": "會", "错": "錯", "将": "將", "转": "轉", "经": "經", "脉": "脈", "轴": "軸", "图": "圖", "边": "邊"}
_FROM, _TO = "".join(SIMPLIFIED), "".join(SIMPLIFIED.values())


@REGISTRY.add("traditional_text", f"SELECT DISTINCT segment_id, CASE WHEN mode = 'slide' THEN sha256(transcript_raw) ELSE sha256(translate(transcript_raw, '{_FROM}', '{_TO}')) END AS sha, CASE WHEN mode = 'slide' THEN 0 ELSE length(regexp_replace(transcript_raw, '[^{_FROM}]', '', 'g')) END AS converted FROM segments WHERE transcript_raw IS NOT NULL")
def traditional_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of recognised speech in traditional characters; those shown with slides stand for captions by hand and stay."""
    s = load(spark, sf_dir, "segments").filter("transcript_raw IS NOT NULL").select("segment_id", "mode", "transcript_raw").distinct()
    out = T.convert_script(F.col("transcript_raw"), SIMPLIFIED, F.coalesce(F.col("mode") != "slide", F.lit(True)))
    return s.select("segment_id", F.sha2(out, 256).alias("sha"), T.differing(F.col("transcript_raw"), out).alias("converted")).distinct()


@REGISTRY.add("ngram_lexicon", "WITH d AS (SELECT DISTINCT doc, unnest(list_concat(list_transform(range(1, length(x) - 1), lambda i: substr(x, i::INT, 3)), list_concat(list_transform(range(1, length(x) - 2), lambda i: substr(x, i::INT, 4)), list_transform(range(1, length(x) - 3), lambda i: substr(x, i::INT, 5))))) AS term FROM (SELECT read_id AS doc, unnest(regexp_extract_all(parsed.slide_text, '[一-鿿]+')) AS x FROM slide_out WHERE parsed.slide_text IS NOT NULL)) SELECT term, count(*) AS n FROM d GROUP BY term HAVING count(*) >= 3")
def ngram_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of three to five Han characters that at least three reads have."""
    return C.ngram_lexicon(reads(spark, sf_dir).select("read_id", "slide_text"), key="read_id", text="slide_text", documents=3)


@REGISTRY.add(
    "validated_corrections",
    f"""WITH s AS (SELECT DISTINCT segment_id, transcript_raw AS raw FROM segments WHERE length(transcript_raw) >= 12), u AS (SELECT segment_id, raw, unnest([1, 2, 3, 4, 5]) AS pos, unnest([substr(raw, 2, 4), substr(raw, 2, 4), substr(raw, 5, 3), substr(raw, 1, 2), '缺' || substr(raw, 1, 3)]) AS a, unnest([substr(raw, 2, 3) || '也', substr(raw, 2, 3) || '也', substr(raw, 5, 3) || '另外加上', ' ', '缺']) AS b FROM s),
    v AS (SELECT *, {_TRIM.format(x='a')} AS f, {_TRIM.format(x='b')} AS t FROM u)
    SELECT segment_id, min(pos) AS pos, f AS before, t AS "after" FROM v WHERE f <> '' AND t <> '' AND f <> t AND contains(raw, f) AND lower(f) <> lower(t) AND NOT (contains(t, f) AND length(t) - length(f) > 2) GROUP BY ALL""",
)
def validated_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals made of transcripts, of which some repeat, insert too much, are blank or aren't in the text."""
    raw = F.col("raw")
    s = load(spark, sf_dir, "segments").select("segment_id", F.col("transcript_raw").alias("raw")).filter(F.length("raw") >= 12).distinct()
    made = [(raw.substr(2, 4), F.concat(raw.substr(2, 3), F.lit("也"))), (raw.substr(2, 4), F.concat(raw.substr(2, 3), F.lit("也"))), (raw.substr(5, 3), F.concat(raw.substr(5, 3), F.lit("另外加上"))), (raw.substr(1, 2), F.lit(" ")), (F.concat(F.lit("缺"), raw.substr(1, 3)), F.lit("缺"))]
    rows = s.select("segment_id", "raw", F.explode(F.array(*[F.struct(F.lit(i + 1).alias("pos"), a.alias("before"), b.alias("after")) for i, (a, b) in enumerate(made)])).alias("p")).select("segment_id", "raw", "p.*")
    return C.validate_corrections(rows, key="segment_id", raw="raw").select("segment_id", "pos", "before", "after")


@REGISTRY.add("corrected_transcripts", "WITH s AS (SELECT DISTINCT segment_id, transcript_raw AS x FROM segments WHERE transcript_raw IS NOT NULL), a AS (SELECT segment_id, x, replace(CASE WHEN contains(x, '的') THEN replace(x, '的', '之') ELSE x END, CASE WHEN contains(x, '我們') THEN '我們' ELSE chr(1) END, '吾等') AS y FROM s) SELECT segment_id, sha256(y) AS sha FROM a WHERE y <> x")
def corrected_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two corrections applied wherever a transcript has what they replace."""
    s = load(spark, sf_dir, "segments").filter("transcript_raw IS NOT NULL").select("segment_id", "transcript_raw").distinct()
    words = lambda *x: F.array(*map(F.lit, x))
    return s.select("segment_id", F.sha2(T.apply_corrections(F.col("transcript_raw"), words("的", "我們"), words("之", "吾等")), 256).alias("sha")).filter("sha IS NOT NULL")


@REGISTRY.add("rolled_captions", """WITH c AS (SELECT DISTINCT segment_id, video_id, t_start, t_end, transcript_raw AS x FROM segments WHERE replace(transcript_raw, ' ', '') <> ''), r AS (SELECT video_id, segment_id, t_start, t_end, unnest([1, 2]) AS k, x FROM c),
    g AS (SELECT video_id, t_start, t_end, row_number() OVER (PARTITION BY video_id ORDER BY segment_id, k) AS i, CASE k WHEN 1 THEN left(x, length(x) // 2) ELSE x END AS x FROM r), n AS (SELECT *, replace(x, ' ', '') AS b FROM g), s AS (SELECT *, CASE WHEN starts_with(b, lag(b) OVER w) THEN 0 ELSE 1 END AS new FROM n WINDOW w AS (PARTITION BY video_id ORDER BY i)),
    q AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY i) AS g FROM s) SELECT video_id, g - 1 AS index, arg_min(t_start, i) AS t_start, arg_max(t_end, i) AS t_end, length(arg_max(b, i)) AS n_chars FROM q GROUP BY video_id, g""")
def rolled_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions that come half first and then whole, made one again."""
    c = cues(spark, sf_dir).filter("replace(text, ' ', '') <> ''")
    half = F.substr("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    grown = c.select("video_id", "segment_id", "t_start", "t_end", F.posexplode(F.array(half, F.col("text"))).alias("k", "text"))
    numbered = grown.withColumn("index", F.row_number().over(W.partitionBy("video_id").orderBy("segment_id", "k")))
    out = captions.collapse_rolling(numbered.select("video_id", "index", "t_start", "t_end", "text"), entity="video_id")
    return out.select("video_id", "index", "t_start", "t_end", F.length(F.replace("text", F.lit(" "), F.lit(""))).alias("n_chars"))


@REGISTRY.add("script_ratios", f"SELECT DISTINCT segment_id, round(CASE WHEN length(regexp_replace(transcript_raw, '[^一-鿿]', '', 'g')) > 0 THEN length(regexp_replace(transcript_raw, '[^{_FROM}]', '', 'g')) / length(regexp_replace(transcript_raw, '[^一-鿿]', '', 'g')) ELSE 0.0 END, 9) AS ratio FROM segments WHERE transcript_raw IS NOT NULL")
def script_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of simplified characters in each transcript."""
    s = load(spark, sf_dir, "segments").filter("transcript_raw IS NOT NULL")
    return s.select("segment_id", F.round(T.script_ratio(F.col("transcript_raw"), _FROM), 9).alias("ratio")).distinct()


# -- sources and small operators --------------------------------------------------------


@REGISTRY.add("playlist_entries", "WITH v AS (SELECT DISTINCT series_id, video_id, upload_date FROM videos WHERE series_id IS NOT NULL), l AS (SELECT series_id, list(CASE WHEN upload_date IS NULL THEN NULL ELSE video_id END ORDER BY video_id, upload_date NULLS FIRST) AS e FROM v GROUP BY ALL), u AS (SELECT series_id, unnest(e) AS video_id, generate_subscripts(e, 1) AS episode_index FROM l) SELECT * FROM u WHERE video_id IS NOT NULL")
def playlist_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series as playlists, whose entries without a date can't be had but keep their number."""
    v = load(spark, sf_dir, "videos").filter("series_id IS NOT NULL").select("series_id", "video_id", "upload_date").distinct()
    listed = v.groupBy("series_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("video_id", "upload_date"))), lambda x: F.when(x["upload_date"].isNotNull(), x["video_id"])).alias("entries"))
    return captions.expand_playlist(listed, playlist="series_id", entries="entries")


@REGISTRY.add("picked_sources", "WITH c AS (SELECT DISTINCT segment_id, video_id, t_start, t_end, CASE WHEN transcript_corrected IS NOT NULL THEN 'manual' ELSE 'speech' END AS source FROM segments), b AS (SELECT video_id, min(CASE source WHEN 'manual' THEN 1 ELSE 2 END) AS best FROM c GROUP BY ALL) SELECT segment_id, source, greatest(t_end, t_start + 0.01) AS t_end FROM c JOIN b USING (video_id) WHERE best = CASE source WHEN 'manual' THEN 1 ELSE 2 END")
def picked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each video's cues of the first source that has any; a video without cues is an error."""
    c = load(spark, sf_dir, "segments").select("segment_id", "video_id", "t_start", "t_end", F.when(F.col("transcript_corrected").isNotNull(), "manual").otherwise("speech").alias("source")).distinct()
    return captions.pick_source(c, entity="video_id", source="source", order=["manual", "speech"], expected=c).select("segment_id", "source", "t_end")


@REGISTRY.add("kept_lines", "WITH d AS (SELECT DISTINCT doc_id, video_id, lang FROM documents) SELECT doc_id FROM d WHERE video_id IS NULL OR video_id NOT IN (SELECT video_id FROM d WHERE doc_id % 50 = 0 AND video_id IS NOT NULL)")
def kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of documents without those of some videos, named at the top or below metadata."""
    d = load(spark, sf_dir, "documents").select("doc_id", "video_id", "lang").distinct()
    line = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct("doc_id", "video_id"))).otherwise(F.to_json(F.struct("doc_id", F.struct("video_id").alias("metadata"))))
    left = lines_without(d.select(line.alias("value")), d.filter("doc_id % 50 = 0 AND video_id IS NOT NULL").select("video_id"), key="video_id")
    return left.select(F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"))


@REGISTRY.add("propagated_reads", "WITH r AS (SELECT DISTINCT read_id, slide_id, parsed.description AS d, members FROM slide_out), g AS (SELECT read_id, min(d) AS d FROM r GROUP BY ALL), m AS (SELECT read_id, min(read_id) OVER (PARTITION BY split_part(read_id, '/', 1)) AS rep FROM g) SELECT g.read_id, coalesce(h.d, g.d) AS description FROM g JOIN m USING (read_id) JOIN g h ON h.read_id = m.rep")
def propagated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every read with the description of its video's first read, where that has one."""
    g = reads(spark, sf_dir).groupBy("read_id").agg(F.min("description").alias("description"))
    reps = g.select("read_id", F.min("read_id").over(W.partitionBy(F.substring_index("read_id", "/", 1))).alias("rep"))
    return G.propagate(g, reps, key="read_id", rep="rep", columns=["description"])


@REGISTRY.add("model_specs", "WITH s AS (SELECT doc_id, coalesce(source, '') || ':' || coalesce(lang, '') AS spec, source, lang FROM documents) SELECT doc_id, CASE WHEN source IN ('web', 'archive', 'forum') AND coalesce(lang, '') <> '' THEN lang END AS model FROM s")
def model_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' source and language as provider and model."""
    spec = F.concat(F.coalesce("source", F.lit("")), F.lit(":"), F.coalesce("lang", F.lit("")))
    return load(spark, sf_dir, "documents").select("doc_id", Y.split_spec(spec, ["web", "archive", "forum"])["model"].alias("model"))


@REGISTRY.add("error_codes", "SELECT event_id, CASE event_type WHEN 'error' THEN 400 + event_id % 100 WHEN 'click' THEN 500 + event_id % 9 END::INT AS code FROM events")
def error_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that messages begin with or name."""
    n = F.col("event_id")
    message = F.when(F.col("event_type") == "error", F.format_string("%d too many", 400 + n % 100)).when(F.col("event_type") == "click", F.format_string("{'code': %d}", 500 + n % 9)).otherwise(F.lit("none 404"))
    return load(spark, sf_dir, "events").select("event_id", T.status_code(message).alias("code"))


@REGISTRY.add("mask_stats", """WITH m AS (SELECT vec_id, embedding AS v FROM embeddings), p AS (SELECT vec_id, len(v) AS n, unnest(v) > 0 AS i, generate_subscripts(v, 1) - 1 AS p FROM m)
    SELECT vec_id, count(*) FILTER (i) AS ink, round(avg(i::INT), 6) AS coverage, round(coalesce(stddev_pop(p % 8) FILTER (i), 0), 6) AS x_spread, round(coalesce(stddev_pop(p // 8) FILTER (i), 0), 6) AS y_spread, round(coalesce(avg((p // 8 < n / 8 / 2)::INT) FILTER (i), 0), 6) AS top_share FROM p GROUP BY vec_id""")
def mask_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as masks eight wide: where they are positive."""
    m = load(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x > 0).alias("mask"))
    return Y.mask_stats(m, key="vec_id", mask="mask", width=8).select("vec_id", "ink", *[F.round(c, 6).alias(c) for c in ("coverage", "x_spread", "y_spread", "top_share")])


@REGISTRY.add("pair_separation", "WITH p AS (SELECT l_suppkey AS s, l_discount::DOUBLE AS d, l_tax < 0.04 AS m FROM lineitem) SELECT s, count(*) FILTER (m) AS merged_pairs, max(d) FILTER (m) AS greatest_merged, count(*) FILTER (NOT m) AS apart_pairs, min(d) FILTER (NOT m) AS least_apart FROM p GROUP BY s")
def pair_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest distance of joined and least of separate pairs, by supplier."""
    p = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_discount").cast("double").alias("d"), (F.col("l_tax") < 0.04).alias("m"))
    return Y.separation(p, entity="s", distance="d", merged="m")


@REGISTRY.add("changed_digests", "WITH a AS (SELECT read_id, sha256(min(parsed.slide_text)) AS a FROM slide_raw GROUP BY ALL), b AS (SELECT read_id, sha256(min(parsed.slide_text)) AS b FROM slide_out GROUP BY ALL) SELECT 'changed' AS rule, read_id AS entity, a AS detail FROM a JOIN b USING (read_id) WHERE a IS DISTINCT FROM b")
def changed_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads whose text isn't what was kept."""
    digest = lambda t: load(spark, sf_dir, t).groupBy("read_id").agg(F.sha2(F.min("parsed.slide_text"), 256).alias("digest"))
    return V.unchanged(digest("slide_raw"), digest("slide_out"), entity="read_id", digest="digest")


@REGISTRY.add("misplaced_corrections", "WITH s AS (SELECT DISTINCT segment_id, transcript_raw AS raw, transcript_corrected || CASE WHEN length(transcript_corrected) % 2 = 0 THEN '！' ELSE '' END AS b FROM segments WHERE transcript_corrected IS NOT NULL) SELECT 'correction' AS rule, segment_id AS entity, b AS detail FROM s WHERE NOT coalesce(contains(raw, b), false)")
def misplaced_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections whose original, here the corrected text, of even length with a sign more, isn't in the raw text."""
    s = load(spark, sf_dir, "segments").filter("transcript_corrected IS NOT NULL").select("segment_id", "transcript_raw", F.concat("transcript_corrected", F.when(F.length("transcript_corrected") % 2 == 0, "！").otherwise("")).alias("before")).distinct()
    return V.corrections_in_text(s, entity="segment_id", before="before", raw="transcript_raw")


@REGISTRY.add(
    "fresh_corrections",
    f"""WITH p AS ({REGISTRY.sql['validated_corrections']}), h AS (SELECT DISTINCT segment_id FROM segments WHERE transcript_corrected IS NOT NULL) SELECT segment_id, before, "after" FROM p WHERE segment_id NOT IN (SELECT segment_id FROM h)""",
)
def fresh_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed corrections of the segments that have none yet."""
    p = validated_corrections(spark, sf_dir)
    held = load(spark, sf_dir, "segments").filter("transcript_corrected IS NOT NULL").select("segment_id").distinct()
    return C.new_corrections(p, p.join(held, "segment_id"), key="segment_id").select("segment_id", "before", "after")


_SOUNDS = {"連": "lian", "聯": "lian", "軸": "zhou", "週": "zhou", "脈": "mai", "麥": "mai", "骨": "gu", "鼓": "gu"}


@REGISTRY.add("sound_coverage")
def sound_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of descriptions' stretches that slides have, as written and by sound."""
    r = reads(spark, sf_dir).filter("slide_text IS NOT NULL AND description IS NOT NULL").select("read_id", "slide_text", "description").distinct()
    return r.select("read_id", F.round(T.coverage(F.col("description"), F.col("slide_text")), 9).alias("literal"), F.round(T.sound_coverage(F.col("description"), F.col("slide_text"), _SOUNDS), 9).alias("by_sound"))


@REGISTRY.add(
    "median_distances",
    """WITH v AS (SELECT vec_id, label, embedding AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i FROM embeddings), u AS (SELECT label, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS p FROM v WHERE i % 3 = 0),
    m AS (SELECT label, p, median(x) AS m FROM u GROUP BY ALL), w AS (SELECT vec_id, label, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS p FROM v) SELECT vec_id, round(avg(abs(x - m)) / 2, 6) AS distance FROM w JOIN m USING (label, p) GROUP BY vec_id""",
)
def median_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's distance to the median of every third one of its label."""
    v = load(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    m = Sg.median_vectors(v, entity="label", order="vec_id", vector="embedding", stride=3)
    return Sg.median_distances(v, m, entity="label", vector="embedding", scale=2.0).select("vec_id", F.round("distance", 6).alias("distance"))


@REGISTRY.add(
    "quota_ledger",
    """WITH e AS (SELECT event_type AS model, ts, event_id FROM events), u AS (SELECT (ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')::DATE AS quota_day, model, count(*) AS requests FROM e GROUP BY ALL), l AS (SELECT model, arg_max(30 + event_id % 7, row(ts, 30 + event_id % 7))::INT AS lim FROM e WHERE event_id % 50 = 0 GROUP BY ALL)
    SELECT quota_day, model, requests, coalesce(lim, 20) AS "limit", greatest(0, floor(coalesce(lim, 20) * 0.9)::INT - requests) AS remaining FROM u LEFT JOIN l USING (model)""",
)
def quota_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests appended in two parts and limits observed in either order, read back."""
    e = load(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withColumn("model", F.col("event_type"))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    ledger = St.QuotaLedger(spark, scratch(spark, "ledger"))
    seen = e.filter("event_id % 50 = 0").select("model", (30 + F.col("event_id") % 7).cast("int").alias("limit"), F.col("at").alias("observed_at"))
    for half in (1, 0):
        ledger.record(e.filter(F.col("event_id") % 2 == half).select("model", "at", none("tokens_in", "bigint"), none("tokens_out", "bigint"), none("segment_id", "string"), F.lit("ok").alias("outcome")))
        ledger.observe(seen.filter(F.hour("observed_at") % 2 == half))
    return ledger.left().select("quota_day", "model", "requests", "limit", "remaining")


@REGISTRY.add(
    "cue_assignments",
    """WITH h AS (SELECT video_id, unnest(cue_indices) AS m FROM (SELECT DISTINCT segment_id, video_id, cue_indices FROM segments)), c AS (SELECT video_id, m, count(*) AS n FROM h GROUP BY ALL), k AS (SELECT video_id, unnest(range(0, hi + 3)) AS m FROM (SELECT video_id, max(m) AS hi FROM h WHERE m % 40 <> 0 GROUP BY ALL)), kn AS (SELECT * FROM k WHERE m % 40 <> 0)
    SELECT 'held_twice' AS rule, video_id AS entity, m::VARCHAR AS detail FROM c WHERE n > 1 UNION ALL SELECT 'unassigned', video_id, m::VARCHAR FROM kn WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.video_id = kn.video_id AND c.m = kn.m) UNION ALL SELECT 'unknown', video_id, m::VARCHAR FROM c WHERE NOT EXISTS (SELECT 1 FROM kn WHERE c.video_id = kn.video_id AND c.m = kn.m)""",
)
def cue_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues that several segments hold, that none holds, and that aren't known (every fortieth)."""
    seg = load(spark, sf_dir, "segments").select("segment_id", "video_id", "cue_indices").distinct()
    top = seg.select("video_id", F.explode("cue_indices").alias("m")).filter("m % 40 <> 0").groupBy("video_id").agg(F.max("m").alias("hi"))
    known = top.select("video_id", F.explode(F.sequence(F.lit(0), F.col("hi") + 2)).alias("member")).filter("member % 40 <> 0")
    return V.assigned_once(seg, entity="video_id", members="cue_indices", known=known)
