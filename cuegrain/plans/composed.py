"""Queries of whole stages, surveys and small row operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corrections as C
from ..operators import pipelines as L
from ..operators import segmentation as S
from ..operators import signals as Sg
from ..operators import survey as V
from ..registry import Registry, load
from .pipeline import _BLOCKS, _GATES, blocks, sql_gates, verdicts
from .signals import series, sql_viterbi
from .text import reads
from .timeline import _DEPTHS, _ENDS, _SCORES, _TOPICS, cues, ends, marks

REGISTRY = Registry()


def _cue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues(spark, sf_dir).withColumnRenamed("segment_id", "cue")


@REGISTRY.add("aligned_segments")
def aligned_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic segments of every video, with cues, slide and text."""
    slides = load(spark, sf_dir, "segments").filter("slide_ref IS NOT NULL").groupBy("video_id", F.col("slide_ref").alias("slide_id")).agg(F.min("t_start").alias("s_start"), F.max("t_end").alias("s_end"))
    out = L.align_segments(_cue_rows(spark, sf_dir), ends(spark, sf_dir), slides, entity="video_id")
    return out.select("segment_id", "t_start", "t_end", "mode", "slide_id", F.size("cues").alias("n_cues"), F.length("transcript").alias("n_chars"), "boundary_method")


_FRAMES = """h AS (SELECT user_id, event_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 6 AS held FROM events WHERE value IS NOT NULL),
v AS (SELECT user_id, event_id, floor(least(first_value(value) OVER (PARTITION BY user_id, held ORDER BY event_id), 300.0) / 10) + 1 AS size FROM h),
fr AS (SELECT user_id, row_number() OVER o - 1 AS i, size, coalesce(1 - least(size, lag(size) OVER o) / greatest(size, lag(size) OVER o), 0.0) AS d FROM v WINDOW o AS (PARTITION BY user_id ORDER BY event_id))"""
# Ink sets of the query are nested, so that a set is its size.
_MERGED = """se AS (SELECT user_id, i, sum(CASE WHEN c > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS section FROM (SELECT fr.*, ch.i AS c FROM fr LEFT JOIN ch USING (user_id, i))),
sx AS (SELECT user_id, section, min(i) AS a, max(i) + 1 AS b FROM se GROUP BY ALL),
ks AS (SELECT l.user_id, l.a, r.b, max(size) FILTER (CASE WHEN r.b - l.a < 5 THEN i = (l.a + r.b) // 2 ELSE i >= l.a + 2 AND i < r.b - 2 END) AS ink FROM sx l JOIN sx r ON r.user_id = l.user_id AND r.b > l.a JOIN fr ON fr.user_id = l.user_id AND i >= l.a AND i < r.b GROUP BY l.user_id, l.a, r.b),
mg AS (SELECT user_id, section, a AS start, a, b, 1 AS builds FROM sx WHERE section = 0
  UNION ALL SELECT x.user_id, x.section, CASE WHEN least(h.ink, k.ink) / h.ink >= 0.7 THEN m.start ELSE x.a END, x.a, x.b, CASE WHEN least(h.ink, k.ink) / h.ink >= 0.7 THEN m.builds + 1 ELSE 1 END
    FROM mg m JOIN sx x ON x.user_id = m.user_id AND x.section = m.section + 1 JOIN ks h ON h.user_id = m.user_id AND h.a = m.start AND h.b = m.b JOIN ks k ON k.user_id = x.user_id AND k.a = x.a AND k.b = x.b),
sp AS (SELECT user_id, start, max(b) AS stop, max(builds) AS builds FROM mg GROUP BY ALL),
sg AS (SELECT *, sum(CASE WHEN stop - start >= 3 OR start = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start) - 1 AS section FROM sp),
sf AS (SELECT user_id, section, min(start) AS a, max(stop) AS b, max(builds) AS builds FROM sg GROUP BY ALL),
kf AS (SELECT sf.user_id, section, a, b, builds, coalesce(arg_min(i, row(-size, i)) FILTER (b - a >= 5 AND i >= a + 2 AND i < b - 2), (a + b) // 2) AS k FROM sf JOIN fr ON fr.user_id = sf.user_id AND i >= a AND i < b GROUP BY sf.user_id, section, a, b, builds),
du AS (SELECT user_id, count(*)::DOUBLE AS duration FROM fr GROUP BY ALL)"""


@REGISTRY.add(
    "detected_slides",
    f"WITH RECURSIVE {_FRAMES}, {sql_viterbi('fr')}, {_MERGED} SELECT user_id, section, printf('slide_%03d', section::INT) AS slide_id, least(a, duration)::DOUBLE AS t_start, least(b, duration)::DOUBLE AS t_end, least(k + 0.5, duration)::DOUBLE AS keyframe_t, builds > 1 AS progressive FROM kf JOIN du USING (user_id)",
)
def detected_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides of series that hold a value for six rows, whose ink is a set of value marks."""
    e = load(spark, sf_dir, "events").filter("value IS NOT NULL").select("user_id", "event_id", "value")
    e = e.withColumn("held", F.floor((F.row_number().over(W.partitionBy("user_id").orderBy("event_id")) - 1) / 6))
    value = F.min_by("value", "event_id").over(W.partitionBy("user_id", "held"))
    frames = e.select("user_id", "event_id", F.sequence(F.lit(0), F.floor(F.least(value, F.lit(300.0)) / 10).cast("int")).alias("ink"))
    length = frames.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("duration"))
    return L.detect_slides(frames, length, entity="user_id", order="event_id", ink="ink")


_ALPHAS = [-0.5, 0.0, 0.5, 0.75, 1.0, 1.25, 1.5, 1.75, 2.0, 2.5]


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = S.blocks(_cue_rows(spark, sf_dir), entity="video_id", order="cue", time="t_start", text="text", least=40)
    b = b.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("video_id"))).filter("_n >= 4").drop("_n")
    return S.gap_scores(b, entity="video_id", window=3)


_SWEEP = ", ".join(f"sw{i} AS (SELECT {a}::DOUBLE AS alpha, video_id, t_next AS t FROM zz WHERE depth > round(m + {a} * s, 9) AND depth >= p AND depth >= q)" for i, a in enumerate(_ALPHAS))


@REGISTRY.add(
    "alpha_sweep",
    f"WITH RECURSIVE {_TOPICS}, {_SCORES}, {_DEPTHS}, zz AS (SELECT *, avg(depth) OVER (PARTITION BY video_id) AS m, stddev_pop(depth) OVER (PARTITION BY video_id) AS s FROM z), {_SWEEP} SELECT alpha, video_id, count(*) AS cuts FROM ({' UNION ALL '.join(f'SELECT * FROM sw{i}' for i in range(len(_ALPHAS)))}) GROUP BY ALL",
)
def alpha_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of topic cuts by alpha."""
    return L.alpha_sweep(_scores(spark, sf_dir), _ALPHAS, entity="video_id").groupBy("alpha", "video_id").agg(F.count(F.lit(1)).alias("cuts"))


@REGISTRY.add(
    "closest_alpha",
    f"""WITH RECURSIVE {_TOPICS}, {_SCORES}, {_DEPTHS}, zz AS (SELECT *, avg(depth) OVER (PARTITION BY video_id) AS m, stddev_pop(depth) OVER (PARTITION BY video_id) AS s FROM z), {_SWEEP},
    al AS ({' UNION ALL '.join(f'SELECT * FROM sw{i}' for i in range(len(_ALPHAS)))}), ct AS (SELECT alpha, video_id, count(*) AS c FROM al GROUP BY ALL),
    wt AS (SELECT video_id, count(DISTINCT t) AS n FROM golden_boundaries WHERE status = 'confirmed' AND t IS NOT NULL AND kind = 'topic' GROUP BY video_id),
    gr AS (SELECT wt.video_id, n, a.alpha, coalesce(c, 0) AS c FROM wt CROSS JOIN (VALUES {', '.join(f'({a}::DOUBLE)' for a in _ALPHAS)}) a(alpha) LEFT JOIN ct ON ct.video_id = wt.video_id AND ct.alpha = a.alpha),
    rk AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY abs(c - n), alpha) AS r FROM gr) SELECT video_id, alpha, c AS cuts FROM rk WHERE r = 1""",
)
def closest_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alpha whose cuts come nearest to the number of confirmed topics."""
    wanted = marks(spark, sf_dir, "topic").groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))
    return L.closest_alpha(L.alpha_sweep(_scores(spark, sf_dir), _ALPHAS, entity="video_id"), wanted, _ALPHAS, entity="video_id")


_ARMS = "ar AS (SELECT arm || video_id AS video_id, segment_id, block_index, type, text, CASE arm WHEN 'raw' THEN source ELSE coalesce(corrected, '') END AS source, '' AS other, NULL AS corrected, arm FROM bl, (VALUES ('raw'), ('next')) a(arm) WHERE block_index > 0)"


@REGISTRY.add("source_swap", f"WITH {_BLOCKS}, {_ARMS}, {sql_gates('ar')} SELECT arm, type, count(*) AS n, round(avg((reason = '')::INT), 9) AS pass_rate FROM vd GROUP BY ALL")
def source_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass rates of blocks against the raw text, and against what follows it."""
    return L.swap_sources(blocks(spark, sf_dir).filter("kind = 'transcript'").withColumn("own", F.col("transcript")).withColumn("next", F.col("corrected")), {"raw": "own", "next": "next"})


_PROFILES = """v AS (SELECT DISTINCT video_id, series_id, duration FROM videos WHERE series_id IS NOT NULL AND duration IS NOT NULL),
g AS (SELECT DISTINCT segment_id, video_id, mode, t_start, t_end FROM segments),
pr AS (SELECT v.video_id, series_id, avg((mode = 'slide')::INT) AS ratio, count(*) / (duration / 60) AS density, avg((mode = 'transcript_only')::INT) AS midband, 4.0 - avg((mode = 'slide')::INT) * 3 AS separation FROM v JOIN g USING (video_id) GROUP BY v.video_id, series_id, duration)"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey measures of each video, from its segments."""
    v = load(spark, sf_dir, "videos").filter("series_id IS NOT NULL AND duration IS NOT NULL").select("video_id", "series_id", "duration").distinct()
    g = load(spark, sf_dir, "segments").select("segment_id", "video_id", "mode", "t_start", "t_end").distinct()
    slide = F.avg((F.col("mode") == "slide").cast("int"))
    return v.join(g, "video_id").groupBy("video_id", "series_id", "duration").agg(slide.alias("ratio"), (F.count(F.lit(1)) / (F.col("duration") / 60)).alias("density"), F.avg((F.col("mode") == "transcript_only").cast("int")).alias("midband"), (4.0 - slide * 3).alias("separation"))


@REGISTRY.add("series_baselines", f"WITH {_PROFILES} SELECT series_id, round(coalesce(avg(1 - ratio), 0.811), 6) AS baseline FROM pr GROUP BY series_id")
def series_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.series_baseline(profiles(spark, sf_dir), series="series_id", ratio="ratio").withColumn("baseline", F.round("baseline", 6))


@REGISTRY.add(
    "series_mismatches",
    f"""WITH {_PROFILES}, a AS (SELECT series_id, min(separation) FILTER (ratio >= 0.05 AND ratio <= 0.95) AS s, max(density) AS d, avg(midband) AS m FROM pr GROUP BY series_id)
    SELECT series_id, 'separation' AS problem, round(s, 6) AS value FROM a WHERE s < 3.0 UNION ALL SELECT series_id, 'density', round(d, 6) FROM a WHERE d > 3.0 UNION ALL SELECT series_id, 'midband', round(m, 6) FROM a WHERE m > 0.15""",
)
def series_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that a survey would stop at."""
    return V.mismatches(profiles(spark, sf_dir), series="series_id")


@REGISTRY.add("series_deviations", f"WITH {_PROFILES} SELECT series_id, round(avg(1 - ratio), 6) AS mean FROM pr GROUP BY series_id HAVING abs(avg(1 - ratio) - 0.811) > 0.2")
def series_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series whose share of speaking is far from the reference value."""
    p = profiles(spark, sf_dir)
    fixed = p.select("series_id").distinct().withColumn("baseline", F.lit(V.BASELINE))
    return V.deviations(p, fixed, series="series_id", ratio="ratio").select("series_id", F.round("mean", 6).alias("mean"))


@REGISTRY.add(
    "background_drift",
    """WITH p AS (SELECT user_id % 20 AS g, user_id, [avg(value) FILTER (event_type = 'view'), avg(value) FILTER (event_type <> 'view')] AS f FROM events WHERE value IS NOT NULL GROUP BY user_id),
    d AS (SELECT a.user_id, b.user_id AS nearest, (abs(a.f[1] / 200 - b.f[1] / 200) + abs(a.f[2] / 200 - b.f[2] / 200)) / 2 AS distance FROM p a JOIN p b ON a.g = b.g AND b.user_id < a.user_id WHERE a.f[1] IS NOT NULL AND a.f[2] IS NOT NULL AND b.f[1] IS NOT NULL AND b.f[2] IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, nearest) AS n FROM d) SELECT user_id, round(distance, 6) AS distance FROM r WHERE n = 1 AND distance >= 0.06""",
)
def background_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users unlike every earlier one of their group."""
    e = load(spark, sf_dir, "events").filter("value IS NOT NULL").groupBy("user_id").agg(F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("a"), F.avg(F.when(F.col("event_type") != "view", F.col("value"))).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    e = e.select((F.col("user_id") % 20).alias("g"), "user_id", F.array(F.col("a") / 200, F.col("b") / 200).alias("f"))
    return V.background_drift(e, group="g", key="user_id", order="user_id", fingerprint="f").select("user_id", F.round("distance", 6).alias("distance"))


@REGISTRY.add("read_outcomes", "WITH s AS (SELECT DISTINCT read_id FROM slide_out WHERE parsed IS NULL), t AS (SELECT DISTINCT read_id, CASE WHEN json_ok THEN 'succeeded' ELSE 'unavailable' END AS o FROM slide_raw) SELECT CASE WHEN s.read_id IS NOT NULL THEN 'known_skip' ELSE o END AS outcome, count(*) AS n FROM t LEFT JOIN s USING (read_id) GROUP BY ALL")
def read_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reads by outcome; reads known to be void are skipped."""
    t = load(spark, sf_dir, "slide_raw").select("read_id", F.when(F.col("json_ok"), "succeeded").otherwise("unavailable").alias("o")).distinct()
    return V.outcome_counts(t, skipped=load(spark, sf_dir, "slide_out").filter("parsed IS NULL"), key="read_id", outcome="o")


@REGISTRY.add("barren_videos", "WITH s AS (SELECT DISTINCT segment_id, video_id, (transcript_corrected IS NOT NULL)::INT AS b FROM segments) SELECT video_id, count(*) AS n, round(avg((b = 0)::INT), 9) AS ratio FROM s GROUP BY video_id HAVING count(*) >= 5 AND avg((b = 0)::INT) > 0.3")
def barren_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos with many segments that have no result."""
    s = load(spark, sf_dir, "segments").select("segment_id", "video_id", F.col("transcript_corrected").isNotNull().cast("int").alias("b")).distinct()
    return V.barren(s, entity="video_id", blocks="b").withColumn("ratio", F.round("ratio", 9))


@REGISTRY.add(
    "term_cross_check",
    """WITH s AS (SELECT DISTINCT segment_id, video_id, t_start, t_end, transcript_raw AS x, transcript_corrected AS y FROM segments),
    t AS (SELECT DISTINCT video_id, slide_ref AS term, t_start, t_end FROM (SELECT DISTINCT segment_id, video_id, slide_ref, t_start, t_end FROM segments WHERE slide_ref IS NOT NULL)),
    q AS (SELECT DISTINCT video_id, t_start, t_end, term FROM (SELECT video_id, t_start, t_end, unnest(regexp_extract_all(transcript_raw, '[一-鿿]+')) AS term FROM segments) WHERE length(term) BETWEEN 3 AND 12),
    a AS (SELECT q.video_id, q.term, q.t_start, q.t_end, coalesce(string_agg(coalesce(x, ''), '' ORDER BY s.t_start, x NULLS FIRST), '') AS a, coalesce(string_agg(coalesce(y, ''), '' ORDER BY s.t_start, y NULLS FIRST), '') AS b FROM q LEFT JOIN s ON s.video_id = q.video_id AND s.t_start <= q.t_end AND s.t_end >= q.t_start GROUP BY ALL),
    h AS (SELECT contains(a, term) AS ha, contains(b, term) AS hb, a <> b AS dif FROM a),
    n AS (SELECT count(*) FILTER (ha AND hb) AS "both", count(*) FILTER (ha <> hb) AS one, count(*) FILTER (NOT ha AND NOT hb AND dif) AS differ, count(*) FILTER (NOT ha AND NOT hb AND NOT dif) AS same, count(*) AS n FROM h)
    SELECT "both", one, differ, same, round((one + differ) / (one + differ + same), 9) AS recall, round((one + differ) / n, 9) AS review FROM n""",
)
def term_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the raw transcripts in two readings: the raw and the corrected one."""
    s = load(spark, sf_dir, "segments").select("segment_id", "video_id", "t_start", "t_end", "transcript_raw", "transcript_corrected").distinct()
    terms = s.select("video_id", F.explode(T.han_runs(F.col("transcript_raw"))).alias("term"), "t_start", "t_end").distinct()
    reading = lambda c: s.select("video_id", "t_start", "t_end", F.col(c).alias("x"))
    return V.cross_check(terms, reading("transcript_raw"), reading("transcript_corrected"), entity="video_id", term="term", span=("t_start", "t_end"), cue_span=("t_start", "t_end"), text="x")


@REGISTRY.add(
    "annotation_problems",
    f"""WITH {_ENDS}, g AS (SELECT boundary_id, video_id, t, status, annotator FROM golden_boundaries), x AS (SELECT g.*, duration FROM g LEFT JOIN e USING (video_id)),
    c AS (SELECT video_id, count(*) FILTER (status = 'proposed') AS pending, count(t) FILTER (status = 'confirmed') - count(DISTINCT t) FILTER (status = 'confirmed') AS repeated, count(*) FILTER (status = 'confirmed' AND (t <= 0 OR t >= duration)) AS outside, count(*) FILTER (trim(coalesce(annotator, '')) = '') AS unsigned FROM x GROUP BY video_id)
    SELECT video_id, 'pending' AS problem, pending AS n FROM c WHERE pending > 0 UNION ALL SELECT video_id, 'repeated', repeated FROM c WHERE repeated > 0 UNION ALL SELECT video_id, 'outside', outside FROM c WHERE outside > 0 UNION ALL SELECT video_id, 'unsigned', unsigned FROM c WHERE unsigned > 0""",
)
def annotation_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = load(spark, sf_dir, "golden_boundaries").select("video_id", "t", "status", "annotator")
    return V.annotation_problems(b, ends(spark, sf_dir), entity="video_id", end="duration")


_TRIM = r"regexp_replace({x}, '^[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+|[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+$', '', 'g')"


@REGISTRY.add(
    "applied_payloads",
    f"""WITH r AS (SELECT DISTINCT read_id, parsed FROM slide_out)
    SELECT read_id, CASE WHEN parsed.is_slide THEN nullif({_TRIM.format(x="coalesce(parsed.slide_text, '')")}, '') END AS slide_text, CASE WHEN parsed.is_slide THEN nullif({_TRIM.format(x="coalesce(parsed.description, '')")}, '') END AS layout_description,
      CASE WHEN NOT coalesce(parsed.is_slide, false) THEN coalesce(nullif({_TRIM.format(x="coalesce(parsed.reject_reason, '')")}, ''), '未說明') END AS reject_reason FROM r""",
)
def applied_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slide columns from the kept reads."""
    r = load(spark, sf_dir, "slide_out").select("read_id", "parsed").distinct()
    return V.apply_payload(r, "parsed").drop("parsed")


@REGISTRY.add("applied_segments", "WITH s AS (SELECT DISTINCT segment_id, video_id, mode, slide_ref FROM segments), r AS (SELECT DISTINCT video_id, slide_id, parsed.is_slide AS i FROM slide_out WHERE parsed.is_slide IS NOT NULL), k AS (SELECT DISTINCT segment_id, i FROM s JOIN r ON r.video_id = s.video_id AND r.slide_id = s.slide_ref) SELECT segment_id, CASE WHEN i = false THEN 'speaker_only' ELSE mode END AS mode, CASE WHEN i = false THEN NULL ELSE slide_ref END AS slide_ref FROM s LEFT JOIN k USING (segment_id)")
def applied_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments whose slide turned out to be none lose it."""
    s = load(spark, sf_dir, "segments").select("segment_id", "video_id", "mode", "slide_ref").distinct()
    r = load(spark, sf_dir, "slide_out").select("video_id", F.col("slide_id").alias("slide_ref"), F.col("parsed.is_slide").alias("is_slide")).filter("is_slide IS NOT NULL").distinct()
    return V.apply_to_segments(s, s.select("segment_id", "video_id", "slide_ref").join(r, ["video_id", "slide_ref"]).select("segment_id", "is_slide").distinct(), key="segment_id").drop("video_id")


@REGISTRY.add("claim_support", "WITH c AS (SELECT DISTINCT video_id, claim FROM (SELECT video_id, unnest(regexp_extract_all(parsed.slide_text, '[一-鿿]+')) AS claim FROM slide_out) WHERE length(claim) BETWEEN 3 AND 12), t AS (SELECT DISTINCT segment_id, video_id, transcript_raw AS x FROM segments) SELECT c.video_id, claim, count(*) FILTER (contains(x, claim)) AS n FROM c LEFT JOIN t USING (video_id) GROUP BY ALL")
def claim_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many segments of a video say what its slides name."""
    c = load(spark, sf_dir, "slide_out").select("video_id", F.explode(T.han_runs(F.col("parsed.slide_text"))).alias("claim")).distinct()
    return V.claim_support(c, load(spark, sf_dir, "segments").select("segment_id", "video_id", "transcript_raw").distinct(), key="video_id", claim="claim", text="transcript_raw")


@REGISTRY.add(
    "debug_reports",
    f"""WITH {_GATES}, ur AS (SELECT video_id, min(url) AS url FROM videos GROUP BY ALL), ln AS (SELECT video_id, segment_id, string_agg('- [' || status || '] ' || type || ': ' || text, chr(10) ORDER BY block_index, text) AS b FROM rl GROUP BY ALL),
    hd AS (SELECT DISTINCT segment_id, video_id, t_start, url, printf('%02d:%02d:%02d', floor(t_start)::INT // 3600, floor(t_start)::INT // 60 % 60, floor(t_start)::INT % 60) AS stamp FROM segments JOIN ur USING (video_id)),
    pt AS (SELECT video_id, segment_id, t_start, '## ' || stamp || ' ' || segment_id || ' (' || url || '&t=' || floor(t_start)::INT || 's)' || chr(10) || coalesce(b, '') AS x FROM hd LEFT JOIN ln USING (video_id, segment_id)),
    md AS (SELECT video_id, coalesce(string_agg(x, chr(10) || chr(10) ORDER BY t_start, segment_id, x), '') AS md FROM pt GROUP BY ALL) SELECT video_id, length(md) AS n_chars, substr(sha256(md), 1, 16) AS sha FROM md""",
)
def debug_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report on each video's blocks."""
    url = load(spark, sf_dir, "videos").groupBy("video_id").agg(F.min("url").alias("url"))
    seg = load(spark, sf_dir, "segments").select("segment_id", "video_id", "t_start").distinct().join(url, "video_id")
    return V.debug_report(seg, verdicts(spark, sf_dir), entity="video_id").select("video_id", F.length("markdown").alias("n_chars"), T.content_sha(F.col("markdown")).alias("sha"))


_CHANGED = """j AS (SELECT r.read_id, min(r.parsed.slide_text) AS raw, min(o.parsed.slide_text) AS kept, bool_or(o.parsed.is_slide) AS shown FROM slide_raw r JOIN slide_out o USING (read_id) WHERE r.parsed.slide_text IS NOT NULL AND o.parsed.slide_text IS NOT NULL GROUP BY ALL),
l AS (SELECT *, least(length(raw), length(kept)) AS m FROM j WHERE raw <> kept),
h AS (SELECT *, coalesce(list_position(list_transform(range(1, m + 1), lambda i: substr(raw, i::INT, 1) = substr(kept, i::INT, 1)), false) - 1, m) AS a FROM l),
k AS (SELECT *, coalesce(list_position(list_transform(range(1, m - a + 1), lambda i: substr(raw, (length(raw) - i + 1)::INT, 1) = substr(kept, (length(kept) - i + 1)::INT, 1)), false) - 1, m - a) AS z FROM h),
p AS (SELECT read_id, raw, kept, shown, substr(raw, (a + 1)::INT, (length(raw) - a - z)::INT) AS b, substr(kept, (a + 1)::INT, (length(kept) - a - z)::INT) AS c FROM k)"""


@REGISTRY.add(
    "outcome_scores",
    f"""WITH {_CHANGED}, n AS (SELECT count(*) FILTER (shown AND contains(kept, c) AND NOT contains(kept, b)) AS tp, count(*) FILTER (shown) AS na, count(*) FILTER (contains(raw, c) AND NOT contains(raw, b)) AS fx, count(*) AS ne FROM p)
    SELECT tp, na - tp AS fp, ne - fx AS fn, round(CASE WHEN na > 0 THEN tp / na ELSE 1.0 END, 9) AS precision, round(CASE WHEN ne > 0 THEN fx / ne ELSE 1.0 END, 9) AS recall FROM n""",
)
def outcome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches in which reads and kept texts differ: those of slides as applied corrections, all as expected ones."""
    text = lambda t, n: load(spark, sf_dir, t).select("read_id", F.col("parsed.slide_text").alias(n), F.col("parsed.is_slide").alias(f"{n}_slide")).filter(F.col(n).isNotNull())
    j = text("slide_raw", "corrected").groupBy("read_id").agg(F.min("corrected").alias("corrected")).join(text("slide_out", "ideal").groupBy("read_id").agg(F.min("ideal").alias("ideal"), F.max("ideal_slide").alias("shown")), "read_id").withColumnRenamed("read_id", "key")
    before, after = T.changed_stretch(F.col("corrected"), F.col("ideal"))
    c = j.filter("corrected <> ideal").select("key", "shown", before.alias("before"), after.alias("after"))
    return C.outcome_scores(c.filter("shown").drop("shown"), c.drop("shown"), j.drop("shown"))


@REGISTRY.add("event_sessions", "WITH l AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM l) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, s")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users, as the streaming form finds them."""
    from ..streaming.feeds import sessions

    e = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e, time="ts", entity="user_id").select("user_id", "start", "n")
