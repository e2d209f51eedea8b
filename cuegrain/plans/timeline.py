"""Queries over timed text: windows, segmentation and its measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import segmentation as S
from ..registry import Registry, load
from .text import sql_list, sql_strip

REGISTRY = Registry()


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments once each, as timed cues numbered within their video."""
    return load(spark, sf_dir, "segments").select("segment_id", "video_id", "t_start", "t_end", F.col("transcript_raw").alias("text")).distinct()


def ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "videos").filter("duration IS NOT NULL").groupBy("video_id").agg(F.max("duration").alias("duration"))


def marks(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Confirmed boundaries with a time."""
    b = load(spark, sf_dir, "golden_boundaries").filter("status = 'confirmed' AND t IS NOT NULL")
    return (b.filter(F.col("kind") == kind) if kind else b).select("video_id", "t").distinct()


_CUES = "c AS (SELECT DISTINCT segment_id, video_id, t_start, t_end, transcript_raw AS text FROM segments)"
_ENDS = "e AS (SELECT video_id, max(duration) AS duration FROM videos WHERE duration IS NOT NULL GROUP BY video_id)"
_MARKS = "b AS (SELECT DISTINCT video_id, t FROM golden_boundaries WHERE status = 'confirmed' AND t IS NOT NULL)"
_WINDOWS = f"""{_MARKS}, {_ENDS},
st AS (SELECT video_id, t AS w_start, duration FROM b JOIN e USING (video_id) WHERE t > 0 AND t < duration UNION SELECT video_id, 0.0, duration FROM e WHERE duration > 0),
w AS (SELECT video_id, row_number() OVER o - 1 AS w_index, w_start, coalesce(lead(w_start) OVER o, duration) AS w_end FROM st WINDOW o AS (PARTITION BY video_id ORDER BY w_start))"""


@REGISTRY.add("boundary_windows", f"WITH {_WINDOWS} SELECT video_id, w_index, w_start, w_end FROM w")
def boundary_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.windows_between(marks(spark, sf_dir), ends(spark, sf_dir), entity="video_id", time="t", end="duration")


@REGISTRY.add(
    "assign_cues",
    f"""WITH {_WINDOWS}, {_CUES},
    p AS (SELECT segment_id, c.video_id, (t_start + t_end) / 2 AS mid FROM c),
    r AS (SELECT segment_id, w_index, row_number() OVER (PARTITION BY segment_id ORDER BY CASE WHEN mid >= w_start AND mid < w_end THEN 0 ELSE 1 END, least(abs(mid - w_start), abs(mid - w_end)), w_index) AS n
          FROM p LEFT JOIN w USING (video_id))
    SELECT segment_id, w_index FROM r WHERE n = 1""",
)
def assign_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment in the window that holds its midpoint, else in the nearest."""
    return I.assign_to_windows(cues(spark, sf_dir), boundary_windows(spark, sf_dir), entity="video_id", cue="segment_id", span=("t_start", "t_end"))


@REGISTRY.add(
    "window_by_overlap",
    f"""WITH {_WINDOWS}, {_CUES},
    r AS (SELECT segment_id, w_index, least(t_end, w_end) - greatest(t_start, w_start) AS o, w_start FROM c JOIN w USING (video_id)),
    n AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY o DESC, w_start) AS n FROM r WHERE o > 0)
    SELECT segment_id, w_index FROM c LEFT JOIN (SELECT * FROM n WHERE n = 1) x USING (segment_id)""",
)
def window_by_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment with the window that it shares the most time with."""
    return I.best_overlap(cues(spark, sf_dir), boundary_windows(spark, sf_dir), entity="video_id", a_id="segment_id", a_span=("t_start", "t_end"), b_id="w_index", b_span=("w_start", "w_end"))


@REGISTRY.add(
    "coarse_windows",
    f"""WITH {_CUES}, {_ENDS},
    k AS (SELECT c.video_id, segment_id, t_start AS s, t_end AS f, duration AS d,
            coalesce(lag(t_end) OVER o, 0.0) AS frm, coalesce(lead(t_start) OVER o, duration) AS nxt, lead(t_start) OVER o IS NULL AS last
          FROM c JOIN e USING (video_id) WINDOW o AS (PARTITION BY c.video_id ORDER BY t_start, segment_id))
    SELECT video_id, frm AS t_start, s AS t_end, NULL AS segment_id FROM k WHERE s - frm > 5
    UNION ALL SELECT video_id, greatest(frm, s), CASE WHEN nxt - f > 0 AND nxt - f <= 5 THEN nxt ELSE f END, segment_id FROM k
    UNION ALL SELECT video_id, f, d, NULL FROM k WHERE last AND d - f > 5
    UNION ALL SELECT video_id, 0.0, duration, NULL FROM e WHERE video_id NOT IN (SELECT video_id FROM c)""",
)
def coarse_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and the gaps of more than five seconds between them."""
    return I.coarse_windows(cues(spark, sf_dir), ends(spark, sf_dir), entity="video_id", ident="segment_id", span=("t_start", "t_end"), end="duration", least=5.0)


@REGISTRY.add(
    "padded_text",
    f"""WITH {_CUES}, g AS (SELECT DISTINCT boundary_id, video_id, t FROM golden_boundaries WHERE status = 'confirmed' AND t IS NOT NULL),
    j AS (SELECT boundary_id, string_agg(coalesce(text, ''), '' ORDER BY t_start, segment_id) AS x FROM g JOIN c ON g.video_id = c.video_id AND t_start <= t + 2.0 AND t_end >= t - 2.0 GROUP BY boundary_id)
    SELECT DISTINCT boundary_id, coalesce(x, '') AS text FROM g LEFT JOIN j USING (boundary_id)""",
)
def padded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said within two seconds of each confirmed boundary."""
    b = load(spark, sf_dir, "golden_boundaries").filter("status = 'confirmed' AND t IS NOT NULL").select("boundary_id", "video_id", "t").distinct()
    return I.padded_text(b.withColumn("t2", F.col("t")), cues(spark, sf_dir), entity="video_id", span_id="boundary_id", span=("t", "t2"), cue_id="segment_id", cue_span=("t_start", "t_end"), text="text", pad=2.0)


@REGISTRY.add(
    "snap_to_starts",
    f"""WITH {_CUES}, {_MARKS},
    r AS (SELECT b.video_id, t, t_start, row_number() OVER (PARTITION BY b.video_id, t ORDER BY abs(t - t_start), t_start) AS n FROM b JOIN c ON b.video_id = c.video_id AND abs(t - t_start) <= 5)
    SELECT b.video_id, b.t, coalesce(t_start, b.t) AS snapped FROM b LEFT JOIN (SELECT * FROM r WHERE n = 1) x ON b.video_id = x.video_id AND b.t = x.t""",
)
def snap_to_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries moved to the nearest segment start within five seconds."""
    return I.snap(marks(spark, sf_dir), cues(spark, sf_dir), entity="video_id", time="t", anchor="t_start", radius=5.0)


@REGISTRY.add(
    "remap_spans",
    f"""WITH {_CUES}, {_WINDOWS.replace("b AS", "b AS", 1)},
    p AS (SELECT segment_id, w_index, (least(t_end, w_end) - greatest(t_start, w_start)) / (t_end - t_start) AS share FROM c JOIN w USING (video_id) WHERE t_end > t_start)
    SELECT segment_id, list_sort(list(DISTINCT w_index)) AS windows FROM p WHERE share >= 0.5 GROUP BY segment_id""",
)
def remap_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that hold at least half of a segment's time."""
    pairs = I.overlaps(cues(spark, sf_dir).filter("t_end > t_start"), boundary_windows(spark, sf_dir), entity="video_id", a_span=("t_start", "t_end"), b_span=("w_start", "w_end"))
    return pairs.filter("overlap / (t_end - t_start) >= 0.5").groupBy("segment_id").agg(F.array_sort(F.collect_set("w_index")).alias("windows"))


# The fold over cues as a recursive table, then counts, scores and depths.
_TOPICS = f"""{_CUES.replace('c AS', 'c AS', 1)},
q AS (SELECT video_id, t_start, coalesce(text, '') AS text, row_number() OVER (PARTITION BY video_id ORDER BY segment_id) AS o FROM c),
f AS (SELECT video_id, o, length(text) AS total, 0 AS block FROM q WHERE o = 1
      UNION ALL SELECT q.video_id, q.o, CASE WHEN f.total >= 40 THEN 0 ELSE f.total END + length(q.text), f.block + CASE WHEN f.total >= 40 THEN 1 ELSE 0 END
      FROM f JOIN q ON q.video_id = f.video_id AND q.o = f.o + 1),
k AS (SELECT video_id, block, string_agg(text, '' ORDER BY q.o) AS text, min_by(t_start, q.o) AS t FROM q JOIN f USING (video_id, o) GROUP BY ALL)"""
_SCORES = f"""
u AS (SELECT *, lead(t) OVER (PARTITION BY video_id ORDER BY block) AS t_next, count(*) OVER (PARTITION BY video_id) AS blocks FROM k),
x AS (SELECT video_id, block, {sql_strip('text')} AS x FROM u WHERE blocks >= 4),
n AS (SELECT video_id, block, g, count(*) AS n FROM (SELECT video_id, block, unnest({sql_list('x', 2)}) AS g FROM x WHERE length(x) >= 2) GROUP BY ALL),
gap AS (SELECT video_id, block AS i, t_next FROM u WHERE t_next IS NOT NULL AND blocks >= 4),
s AS (SELECT gap.video_id, i, g, sum(CASE WHEN block <= i THEN n ELSE 0 END) AS a, sum(CASE WHEN block > i THEN n ELSE 0 END) AS b
      FROM gap JOIN n ON n.video_id = gap.video_id AND block BETWEEN i - 2 AND i + 3 GROUP BY ALL),
v AS (SELECT video_id, i, sum(a * b) AS ab, sum(a * a) AS aa, sum(b * b) AS bb FROM s GROUP BY ALL),
sc AS (SELECT gap.video_id, gap.i, t_next, coalesce(CASE WHEN aa > 0 AND bb > 0 THEN round(ab / sqrt(aa::DOUBLE * bb), 9) ELSE 0.0 END, 0.0) AS score FROM gap LEFT JOIN v ON v.video_id = gap.video_id AND v.i = gap.i)"""
_DEPTHS = """
l AS (SELECT *, CASE WHEN lag(score) OVER up < score THEN 1 ELSE 0 END AS nl, CASE WHEN lead(score) OVER up < score THEN 1 ELSE 0 END AS nr FROM sc WINDOW up AS (PARTITION BY video_id ORDER BY i)),
m AS (SELECT *, sum(nl) OVER (PARTITION BY video_id ORDER BY i) AS gl, sum(nr) OVER (PARTITION BY video_id ORDER BY i DESC) AS gr FROM l),
d AS (SELECT *, round(max(score) OVER (PARTITION BY video_id, gl) - score + max(score) OVER (PARTITION BY video_id, gr) - score, 9) AS depth FROM m),
z AS (SELECT *, round(avg(depth) OVER w + 0.75 * stddev_pop(depth) OVER w, 9) AS cut, lag(depth) OVER up AS p, lead(depth) OVER up AS q FROM d
      WINDOW w AS (PARTITION BY video_id), up AS (PARTITION BY video_id ORDER BY i))"""


@REGISTRY.add("text_blocks", f"WITH RECURSIVE {_TOPICS} SELECT video_id, block, t, length(text) AS n_chars, sha256(text) AS sha FROM k")
def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues joined to blocks of at least 40 characters."""
    b = S.blocks(cues(spark, sf_dir), entity="video_id", order="segment_id", time="t_start", text="text", least=40)
    return b.select("video_id", "block", "t", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("sha"))


@REGISTRY.add("topic_boundaries", f"WITH RECURSIVE {_TOPICS}, {_SCORES}, {_DEPTHS} SELECT video_id, t_next AS t FROM z WHERE depth > cut AND depth >= p AND depth >= q")
def topic_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.topic_boundaries(cues(spark, sf_dir), entity="video_id", order="segment_id", time="t_start", text="text")


_EVENT_DEPTHS = _DEPTHS.replace("video_id", "user_id")


@REGISTRY.add("event_valleys", f"WITH sc AS (SELECT user_id, event_id AS i, value AS score FROM events WHERE value IS NOT NULL), {_EVENT_DEPTHS} SELECT user_id, i AS event_id, depth FROM z WHERE depth > cut AND depth >= p AND depth >= q")
def event_valleys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deep valleys of each user's values."""
    e = load(spark, sf_dir, "events").filter("value IS NOT NULL").select("user_id", "event_id", "value")
    return S.depth_cuts(e, entity="user_id", order="event_id", score="value", alpha=0.75).select("user_id", "event_id", "depth")


@REGISTRY.add(
    "min_length_boundaries",
    f"""WITH {_MARKS}, {_ENDS}, g AS (SELECT video_id, duration, list_sort(list(t)) AS ts FROM b JOIN e USING (video_id) GROUP BY ALL)
    SELECT video_id, list_reduce(ts, lambda acc, t: CASE WHEN t - coalesce(acc[-1], 0.0) >= 30.0 AND duration - t >= 30.0 THEN list_append(acc, t) ELSE acc END, []::DOUBLE[]) AS kept FROM
    (SELECT video_id, duration, list_transform(ts, lambda t: [t]) AS l, ts FROM g)""".replace("list_reduce(ts, lambda acc, t:", "list_reduce(l, lambda acc, x:").replace("t - coalesce", "x[1] - coalesce").replace("duration - t >=", "duration - x[1] >=").replace("list_append(acc, t)", "list_append(acc, x[1])"),
)
def min_length_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries that leave at least 30 seconds on either side, greedily from the start."""
    g = marks(spark, sf_dir).join(ends(spark, sf_dir), "video_id").groupBy("video_id", "duration").agg(F.collect_list("t").alias("ts"))
    return g.select("video_id", S.keep_min_length(F.col("ts"), F.col("duration"), 30.0).alias("kept"))


_FLAGS = f"""{_CUES}, {_MARKS},
pos AS (SELECT DISTINCT b.video_id, max_by(segment_id, (t_start, segment_id)) OVER (PARTITION BY b.video_id, t) AS segment_id FROM b JOIN c ON b.video_id = c.video_id AND t_start <= t),
fl AS (SELECT c.video_id, c.segment_id, t_start, CASE WHEN lead(c.segment_id) OVER (PARTITION BY c.video_id ORDER BY t_start, c.segment_id) IS NULL THEN 0 WHEN pos.segment_id IS NOT NULL THEN 1 ELSE 0 END AS flag
       FROM c LEFT JOIN pos ON c.video_id = pos.video_id AND c.segment_id = pos.segment_id)"""


@REGISTRY.add("boundary_flags", f"WITH {_FLAGS.replace('max_by(segment_id, (t_start, segment_id))', 'max_by(segment_id, row(t_start, segment_id))')} SELECT segment_id, flag FROM fl")
def boundary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.boundary_flags(cues(spark, sf_dir), marks(spark, sf_dir), entity="video_id", unit="segment_id", start="t_start", cut="t").select("segment_id", "flag")


def _flag_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, ref, hyp, n, k): flags of confirmed boundaries, and of as many uniform cuts."""
    c, m, e = cues(spark, sf_dir), marks(spark, sf_dir), ends(spark, sf_dir)
    counts = m.join(e, "video_id").groupBy("video_id", "duration").agg(F.count(F.lit(1)).cast("int").alias("n"))
    even = counts.select("video_id", F.explode(S.uniform_cuts(F.col("n"), F.col("duration"))).alias("t"))
    common = dict(entity="video_id", unit="segment_id", start="t_start", cut="t")
    ref, hyp = S.boundary_flags(c, m, **common), S.boundary_flags(c, even, **common).withColumnRenamed("flag", "h")
    both = ref.join(hyp, ["video_id", "segment_id"]).join(c.select("segment_id", "t_start"), "segment_id").join(counts.select("video_id"), "video_id", "left_semi")
    rows = both.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("t_start", "segment_id", "flag", "h"))).alias("r"))
    flags = lambda name: F.transform("r", lambda x: x[name])
    out = rows.select("video_id", flags("flag").alias("ref"), flags("h").alias("hyp"))
    return out.withColumn("k", S.default_window(F.size("ref"), F.aggregate("ref", F.lit(0), lambda a, x: a + x)))


_UNIFORM = f"""{_ENDS}, cn AS (SELECT video_id, duration, count(*) AS n FROM b JOIN e USING (video_id) GROUP BY ALL),
ev AS (SELECT video_id, duration * i / (n + 1) AS t FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM cn)),
pe AS (SELECT DISTINCT ev.video_id, max_by(segment_id, row(t_start, segment_id)) OVER (PARTITION BY ev.video_id, t) AS segment_id FROM ev JOIN c ON ev.video_id = c.video_id AND t_start <= t),
fe AS (SELECT c.video_id, c.segment_id, CASE WHEN lead(c.segment_id) OVER (PARTITION BY c.video_id ORDER BY t_start, c.segment_id) IS NULL THEN 0 WHEN pe.segment_id IS NOT NULL THEN 1 ELSE 0 END AS h
       FROM c LEFT JOIN pe ON c.video_id = pe.video_id AND c.segment_id = pe.segment_id),
un AS (SELECT fl.video_id, flag, h, row_number() OVER (PARTITION BY fl.video_id ORDER BY t_start, fl.segment_id) AS i FROM fl JOIN fe USING (segment_id) WHERE fl.video_id IN (SELECT video_id FROM cn)),
kk AS (SELECT video_id, count(*) AS n, greatest(1, round_even(count(*) / (sum(flag) + 1) / 2, 0))::INT AS k FROM un GROUP BY video_id),
cu AS (SELECT video_id, i, sum(flag - h) OVER (PARTITION BY video_id ORDER BY i) AS s FROM un UNION ALL SELECT video_id, 0, 0 FROM kk),
df AS (SELECT a.video_id, n, k, abs(z.s - a.s) AS d FROM kk JOIN cu a USING (video_id) JOIN cu z ON z.video_id = a.video_id AND z.i = a.i + k)"""


@REGISTRY.add("window_diff", f"WITH {_FLAGS.replace('max_by(segment_id, (t_start, segment_id))', 'max_by(segment_id, row(t_start, segment_id))')}, {_UNIFORM} SELECT video_id, k, round(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) / any_value(n - k + 1), 9) AS wd, round(sum(d) / any_value(n - k + 1), 9) AS weighted FROM df GROUP BY video_id, k")
def window_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed boundaries against as many uniform cuts."""
    pairs = _flag_pairs(spark, sf_dir)
    ref, hyp, k = F.col("ref"), F.col("hyp"), F.col("k")
    return pairs.select("video_id", "k", F.round(S.window_diff(ref, hyp, k), 9).alias("wd"), F.round(S.window_diff(ref, hyp, k, weighted=True), 9).alias("weighted"))


def sql_matches(predicted: str, truth: str, tolerance: float, name: str) -> str:
    """CTEs that end in ``name`` (video_id, tp, np, ng): greedy one-to-one matches of the times (video_id, t) of two relations; the query needs WITH RECURSIVE."""
    return f"""{name}p AS (SELECT video_id, t, row_number() OVER (PARTITION BY video_id ORDER BY t) AS i FROM {predicted} WHERE t IS NOT NULL),
{name}g AS (SELECT video_id, t, row_number() OVER (PARTITION BY video_id ORDER BY t) AS i FROM {truth} WHERE t IS NOT NULL),
{name}k AS (SELECT p.video_id, p.i AS pi, g.i AS gi, row_number() OVER (PARTITION BY p.video_id ORDER BY abs(p.t - g.t), p.i, g.i) AS k FROM {name}p p JOIN {name}g g ON g.video_id = p.video_id AND abs(p.t - g.t) <= {tolerance}),
{name}r AS (SELECT DISTINCT video_id, 0::BIGINT AS k, []::BIGINT[] AS up, []::BIGINT[] AS ug FROM {name}k
  UNION ALL SELECT r.video_id, n.k, CASE WHEN list_contains(up, pi) OR list_contains(ug, gi) THEN up ELSE list_append(up, pi) END, CASE WHEN list_contains(up, pi) OR list_contains(ug, gi) THEN ug ELSE list_append(ug, gi) END
    FROM {name}r r JOIN {name}k n ON n.video_id = r.video_id AND n.k = r.k + 1),
{name} AS (SELECT video_id, coalesce(tp, 0) AS tp, coalesce(np, 0) AS np, coalesce(ng, 0) AS ng FROM (SELECT video_id, count(*) AS np FROM {name}p GROUP BY ALL) FULL JOIN (SELECT video_id, count(*) AS ng FROM {name}g GROUP BY ALL) USING (video_id) LEFT JOIN (SELECT video_id, max(len(up)) AS tp FROM {name}r GROUP BY ALL) USING (video_id)),
{name}s AS (SELECT *, CASE WHEN np > 0 THEN tp / np ELSE (ng = 0)::INT END AS p, CASE WHEN ng > 0 THEN tp / ng ELSE (np = 0)::INT END AS r FROM {name}),
{name}f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM {name}s)"""


_STARTS = "sa AS (SELECT DISTINCT video_id, t_start AS t FROM segments)"


@REGISTRY.add("boundary_scores", f"WITH RECURSIVE {_STARTS}, {_MARKS}, {sql_matches('sa', 'b', 2.0, 'm')} SELECT video_id, tp, np - tp AS fp, ng - tp AS fn, round(p, 9) AS precision, round(r, 9) AS recall, round(f1, 9) AS f1 FROM mf")
def boundary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment starts against confirmed boundaries within two seconds."""
    starts = cues(spark, sf_dir).select("video_id", F.col("t_start").alias("t")).distinct()
    scores = S.boundary_scores(starts, marks(spark, sf_dir), entity="video_id", time="t", tolerance=2.0)
    return scores.select("video_id", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@REGISTRY.add(
    "margin_over_uniform",
    f"""WITH RECURSIVE {_STARTS}, {_MARKS}, {_ENDS}, st AS (SELECT sa.*, duration FROM sa JOIN e USING (video_id)), ct AS (SELECT video_id, duration, count(*) AS n FROM st GROUP BY ALL),
    ev AS (SELECT video_id, duration * i / (n + 1) AS t FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM ct)), tr AS (SELECT b.* FROM b JOIN ct USING (video_id)), {sql_matches('st', 'tr', 10.0, 'x')}, {sql_matches('ev', 'tr', 10.0, 'y')}
    SELECT ct.video_id, round(xf.f1, 9) AS f1, round(yf.f1, 9) AS uniform_f1, round(CASE WHEN duration <= 0 THEN 1.0 ELSE least(1.0, 20.0 * n / duration) END, 9) AS coverage FROM ct JOIN xf USING (video_id) JOIN yf USING (video_id)""",
)
def margin_over_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 of segment starts beside that of as many uniform cuts, and the share of time within the tolerance."""
    starts = cues(spark, sf_dir).select("video_id", F.col("t_start").alias("t")).distinct().join(ends(spark, sf_dir), "video_id")
    counts = starts.groupBy("video_id", "duration").agg(F.count(F.lit(1)).cast("int").alias("n"))
    even = counts.select("video_id", F.explode(S.uniform_cuts(F.col("n"), F.col("duration"))).alias("t"))
    truth = marks(spark, sf_dir).join(counts.select("video_id"), "video_id", "left_semi")
    score = lambda df, name: S.boundary_scores(df.select("video_id", "t"), truth, entity="video_id", time="t", tolerance=10.0).select("video_id", F.round("f1", 9).alias(name))
    covered = counts.select("video_id", F.round(S.tolerance_coverage(10.0, F.col("n"), F.lit(0.0), F.col("duration")), 9).alias("coverage"))
    return score(starts, "f1").join(score(even, "uniform_f1"), "video_id").join(covered, "video_id")


@REGISTRY.add("description_length_cuts")
def description_length_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-cost topic cuts of videos' blocks of 40 characters."""
    b = S.blocks(cues(spark, sf_dir), entity="video_id", order="segment_id", time="t_start", text="text", least=40)
    return S.description_length_cuts(b, entity="video_id", prior=20.0)


@REGISTRY.add(
    "segment_length_spread",
    f"""WITH {_CUES}, d AS (SELECT video_id, lead(t_start) OVER (PARTITION BY video_id ORDER BY t_start, segment_id) - t_start AS d FROM c)
    SELECT video_id, count(d) AS n, round(CASE WHEN count(d) > 1 AND avg(d) > 0 THEN stddev_samp(d) / avg(d) ELSE 0.0 END, 6) AS cv,
      round(quantile_cont(d, 0.5), 6) AS median, round(max(d) - min(d), 6) AS spread FROM d WHERE d IS NOT NULL GROUP BY video_id""",
)
def segment_length_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variation of the distances between segment starts."""
    from pyspark.sql import Window as W

    d = cues(spark, sf_dir).select("video_id", (F.lead("t_start").over(W.partitionBy("video_id").orderBy("t_start", "segment_id")) - F.col("t_start")).alias("d")).filter("d IS NOT NULL")
    cv = F.when((F.count("d") > 1) & (F.avg("d") > 0), F.stddev_samp("d") / F.avg("d")).otherwise(0.0)
    return d.groupBy("video_id").agg(F.count("d").alias("n"), F.round(cv, 6).alias("cv"), F.round(F.percentile("d", 0.5), 6).alias("median"), F.round(F.max("d") - F.min("d"), 6).alias("spread"))
