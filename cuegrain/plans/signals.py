"""Queries over series, groups and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import grouping as G
from ..operators import retrieval as R
from ..operators import signals as S
from ..registry import Registry, load
from .text import reads, sql_grams, sql_strip

REGISTRY = Registry()


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each user in order, and the distance to the one before, scaled to [0, 1] by 200."""
    e = load(spark, sf_dir, "events").filter("value IS NOT NULL").select("user_id", "event_id", "value")
    d = S.consecutive_distances(e, entity="user_id", order="event_id", value="value")
    return d.withColumn("d", F.least(F.lit(1.0), F.col("d") / 200))


_SERIES = "x AS (SELECT user_id, event_id, value, least(1.0, coalesce(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id)), 0.0) / 200) AS d FROM events WHERE value IS NOT NULL)"


@REGISTRY.add("series_distances", f"WITH {_SERIES} SELECT event_id, round(d, 9) AS d FROM x")
def series_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("event_id", F.round("d", 9).alias("d"))


def sql_viterbi(source: str) -> str:
    """CTEs that end in ch (user_id, i): the changes of the rows (user_id, i from 0, d) of ``source`` by the two-state model; the query needs WITH RECURSIVE."""
    return f"""vq AS (SELECT user_id, quantile_cont(d, 0.75) AS q, count(*) AS n FROM {source} GROUP BY user_id),
vs AS (SELECT s.user_id, greatest(avg(d), 0.01) AS scale, any_value(n) AS n FROM {source} s JOIN vq USING (user_id) WHERE d <= q GROUP BY s.user_id),
ve AS (SELECT s.user_id, i, n, -ln(scale) - d / scale AS same FROM {source} s JOIN vs USING (user_id)),
vf AS (SELECT user_id, i, n, same AS a, ln(1 - 0.97::DOUBLE) AS b, false AS fc FROM ve WHERE i = 0
  UNION ALL SELECT e.user_id, e.i, e.n, greatest(f.a + ln(0.97::DOUBLE), f.b) + e.same, f.a + ln(1 - 0.97::DOUBLE), f.b > f.a + ln(0.97::DOUBLE) + 1e-9 FROM vf f JOIN ve e ON e.user_id = f.user_id AND e.i = f.i + 1),
vb AS (SELECT user_id, i, b > a + 1e-9 AS change, fc FROM vf WHERE i = n - 1
  UNION ALL SELECT f.user_id, f.i, NOT v.change AND v.fc, f.fc FROM vb v JOIN vf f ON f.user_id = v.user_id AND f.i = v.i - 1),
ch AS (SELECT user_id, i FROM vb WHERE change)"""


_POS = f"{_SERIES}, p AS (SELECT *, row_number() OVER o - 1 AS pos FROM x WINDOW o AS (PARTITION BY user_id ORDER BY event_id)), ps AS (SELECT user_id, pos AS i, d FROM p)"


@REGISTRY.add("series_changes", f"WITH RECURSIVE {_POS}, {sql_viterbi('ps')} SELECT p.user_id, event_id FROM ch JOIN p ON p.user_id = ch.user_id AND p.pos = ch.i")
def series_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at which each user's series changes."""
    return S.viterbi_changes(series(spark, sf_dir), entity="user_id", order="event_id", distance="d")


_CHANGE_SECTIONS = f"""{_POS}, {sql_viterbi('ps')}, s AS (SELECT p.*, sum(CASE WHEN ch.i > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY p.user_id ORDER BY pos) AS section FROM p LEFT JOIN ch ON ch.user_id = p.user_id AND ch.i = p.pos),
r AS (SELECT user_id, section, min(pos) AS start, max(pos) + 1 AS "end" FROM s GROUP BY ALL),
g AS (SELECT *, sum(CASE WHEN "end" - start >= 3 OR section = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start) - 1 AS g FROM r),
f AS (SELECT user_id, g AS section, min(start) AS start, max("end") AS "end" FROM g GROUP BY ALL)"""
_KEYS = """k AS (SELECT f.user_id, f.section, f.start, f."end", pos, row_number() OVER (PARTITION BY f.user_id, f.section ORDER BY CASE WHEN pos >= start + 2 AND pos < "end" - 2 THEN 0 ELSE 1 END, value DESC, pos) AS n
    FROM f JOIN p ON p.user_id = f.user_id AND pos >= start AND pos < "end")
    SELECT user_id, section, start, "end", CASE WHEN "end" - start < 5 THEN (start + "end") // 2 ELSE pos END AS keyframe FROM k WHERE n = 1"""


@REGISTRY.add("series_sections", f"WITH RECURSIVE {_CHANGE_SECTIONS}, {_KEYS}")
def series_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections between changes, short ones absorbed, with their key rows."""
    s = series(spark, sf_dir)
    rows = S.drop_short(S.sections(s, S.viterbi_changes(s, entity="user_id", order="event_id", distance="d"), entity="user_id", order="event_id"), entity="user_id", least=3)
    return rows.join(S.keyframes(s, rows, entity="user_id", order="event_id", ink="value"), ["user_id", "section"])


_CUT_SECTIONS = f"""{_SERIES}, p AS (SELECT *, row_number() OVER o - 1 AS pos FROM x WINDOW o AS (PARTITION BY user_id ORDER BY event_id)),
s AS (SELECT *, sum(CASE WHEN d >= 0.5 AND pos > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos) AS section FROM p),
r AS (SELECT user_id, section, min(pos) AS start, max(pos) + 1 AS "end" FROM s GROUP BY ALL),
g AS (SELECT *, sum(CASE WHEN "end" - start >= 3 OR section = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start) - 1 AS g FROM r),
f AS (SELECT user_id, g AS section, min(start) AS start, max("end") AS "end" FROM g GROUP BY ALL)"""


@REGISTRY.add(
    "threshold_sections",
    f"""WITH {_CUT_SECTIONS}, k AS (SELECT f.user_id, f.section, f.start, f."end", pos, row_number() OVER (PARTITION BY f.user_id, f.section ORDER BY CASE WHEN pos >= start + 2 AND pos < "end" - 2 THEN 0 ELSE 1 END, value DESC, pos) AS n
    FROM f JOIN p ON p.user_id = f.user_id AND pos >= start AND pos < "end")
    SELECT user_id, section, start, "end", CASE WHEN "end" - start < 5 THEN (start + "end") // 2 ELSE pos END AS keyframe FROM k WHERE n = 1""",
)
def threshold_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a change is a distance of at least 0.5."""
    s = series(spark, sf_dir)
    rows = S.drop_short(S.sections(s, s.filter("d >= 0.5"), entity="user_id", order="event_id"), entity="user_id", least=3)
    return rows.join(S.keyframes(s, rows, entity="user_id", order="event_id", ink="value"), ["user_id", "section"])


@REGISTRY.add(
    "series_peaks",
    f"""WITH {_SERIES}, h AS (SELECT *, d >= 0.4 AND lag(event_id) OVER o IS NOT NULL AS high FROM x WINDOW o AS (PARTITION BY user_id ORDER BY event_id)),
    i AS (SELECT *, high AND NOT coalesce(lag(high) OVER (PARTITION BY user_id ORDER BY event_id), false) AS new FROM h),
    j AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM i),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY d DESC, event_id) AS n FROM j WHERE high)
    SELECT user_id, event_id FROM k WHERE n = 1""",
)
def series_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.peaks(series(spark, sf_dir), entity="user_id", order="event_id", value="d", threshold=F.lit(0.4))


_PROPOSED = f"""{_POS}, q AS (SELECT user_id, quantile_cont(d, 0.92) AS q, count(*) AS n FROM p GROUP BY user_id),
h AS (SELECT p.user_id, pos, d, n, pos > 0 AND d >= q AS high FROM p JOIN q USING (user_id)),
hr AS (SELECT *, sum(CASE WHEN high AND NOT coalesce(ph, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM (SELECT *, lag(high) OVER (PARTITION BY user_id ORDER BY pos) AS ph FROM h)),
f0 AS (SELECT user_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY d DESC, pos) AS k FROM hr WHERE high) WHERE k = 1)"""


def _refined(round_: int) -> str:
    """One round: the greatest row inside every gap of more than 30 rows, three from its ends."""
    now = f"f{round_}"
    return f"""e{round_} AS (SELECT user_id, pos AS a, coalesce(lead(pos) OVER (PARTITION BY user_id ORDER BY pos), n) AS b FROM (SELECT user_id, pos, n FROM {now} JOIN q USING (user_id) UNION SELECT user_id, 0, n FROM q)),
f{round_ + 1} AS (SELECT user_id, pos FROM {now} UNION SELECT user_id, pos FROM (SELECT e.user_id, p.pos, row_number() OVER (PARTITION BY e.user_id, a ORDER BY d DESC, p.pos) AS k FROM e{round_} e JOIN p ON p.user_id = e.user_id AND p.pos >= a + 3 AND p.pos < b - 3 WHERE b - a > 30) WHERE k = 1)"""


@REGISTRY.add("proposed_boundaries", f"WITH {_PROPOSED}, {', '.join(_refined(r) for r in range(8))} SELECT p.user_id, event_id FROM f8 JOIN p USING (user_id, pos)")
def proposed_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.propose_boundaries(series(spark, sf_dir), entity="user_id", order="event_id", distance="d")


@REGISTRY.add(
    "series_runs",
    f"""WITH {_SERIES}, n AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, d FROM x),
    q AS (SELECT user_id, quantile_cont(d, 0.9) AS q FROM n GROUP BY user_id),
    a AS (SELECT n.*, coalesce(i - lag(i) OVER o > 1, true) AS jump, q FROM n JOIN q USING (user_id) WINDOW o AS (PARTITION BY user_id ORDER BY i)),
    b AS (SELECT *, sum(CASE WHEN jump OR d >= q THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS r FROM a),
    c AS (SELECT user_id, r, min(i) AS f, max(i) AS l, count(*) AS n, arg_min(jump, i) AS jump FROM b GROUP BY ALL),
    e AS (SELECT *, sum(CASE WHEN jump OR n >= 4 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY r) AS run FROM c)
    SELECT user_id, run, min(f) AS first, max(l) AS last, sum(n) AS n FROM e GROUP BY ALL""",
)
def series_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    s = series(spark, sf_dir).select("user_id", F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).alias("i"), "d")
    return S.runs(s, entity="user_id", order="i", distance="d", quantile=0.9, least=4)


_OTSU = """t AS (SELECT user_id, max(value) AS top FROM events WHERE value IS NOT NULL GROUP BY user_id),
h AS (SELECT e.user_id, top, least(greatest(floor(value / top * 255), 0), 255) AS bin, count(*) AS n FROM events e JOIN t USING (user_id) WHERE top > 0 AND value IS NOT NULL GROUP BY ALL),
u AS (SELECT *, sum(n) OVER up AS w0, sum(n * bin) OVER up AS s0, sum(n) OVER al AS w, sum(n * bin) OVER al AS s FROM h WINDOW up AS (PARTITION BY user_id ORDER BY bin), al AS (PARTITION BY user_id)),
v AS (SELECT *, coalesce(round(w0 * (w - w0) * (s0 / w0 - (s - s0) / nullif(w - w0, 0)) * (s0 / w0 - (s - s0) / nullif(w - w0, 0)) / w / w, 9), 0.0) AS v FROM u),
b AS (SELECT user_id, top, bin, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, bin) AS r FROM v),
c AS (SELECT t.user_id, coalesce(bin / 255 * t.top, 0.0) AS cut FROM t LEFT JOIN (SELECT * FROM b WHERE r = 1) b USING (user_id))"""


@REGISTRY.add(
    "series_profile",
    f"""WITH {_OTSU}, x AS (SELECT e.user_id, value AS v, cut, value > cut AS hi FROM events e JOIN c USING (user_id) WHERE value IS NOT NULL),
    st AS (SELECT user_id, cut, count(*) AS n, avg(hi::INT) AS high_ratio, quantile_cont(v, 0.99) FILTER (NOT hi) AS p99, quantile_cont(v, 0.01) FILTER (hi) AS p1, median(v) FILTER (NOT hi) AS med, count(*) FILTER (NOT hi) AS low FROM x GROUP BY ALL),
    m AS (SELECT x.user_id, median(abs(v - med)) AS mad FROM x JOIN st USING (user_id) WHERE NOT hi GROUP BY ALL),
    k AS (SELECT x.user_id, count(*) FILTER (v > p99 AND NOT hi) AS between, count(*) FILTER (low > 10 AND NOT hi AND (v - med) / CASE WHEN mad > 0 THEN mad ELSE 1e-6 END > 8.0) AS outliers FROM x JOIN st USING (user_id) LEFT JOIN m USING (user_id) GROUP BY ALL)
    SELECT user_id, n, round(cut, 6) AS cut, round(high_ratio, 6) AS high_ratio, round(CASE WHEN p99 > 0 THEN coalesce(p1 / p99, 0.0) ELSE 0.0 END, 6) AS separation, between, outliers FROM st JOIN k USING (user_id)""",
)
def series_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-mode statistics of each user's values."""
    p = S.series_profile(load(spark, sf_dir, "events"), entity="user_id", value="value")
    return p.select("user_id", "n", *[F.round(c, 6).alias(c) for c in ("cut", "high_ratio", "separation")], "between", "outliers")


def slide_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reads(spark, sf_dir).filter("slide_text IS NOT NULL").groupBy("video_id", "read_id").agg(F.min("slide_text").alias("slide_text"))
    return r.select("video_id", "read_id", T.grams(F.col("slide_text"), 2).alias("items"))


_SETS = f"""r AS (SELECT video_id, read_id, min(parsed.slide_text) AS x FROM slide_out WHERE parsed.slide_text IS NOT NULL GROUP BY ALL),
g AS (SELECT video_id, read_id, {sql_grams('x')} AS s FROM (SELECT video_id, read_id, {sql_strip('x')} AS x FROM r)),
l AS (SELECT a.video_id, a.read_id AS a, b.read_id AS b, len(list_intersect(a.s, b.s)) AS n, len(a.s) + len(b.s) AS t FROM g a JOIN g b ON a.video_id = b.video_id AND a.read_id < b.read_id WHERE len(a.s) > 0 AND len(b.s) > 0),
e AS (SELECT video_id, a, b, 1 - n / (t - n) AS d FROM l WHERE n / (t - n) >= 0.7 - 1e-12)"""


@REGISTRY.add("similar_slides", f"WITH {_SETS} SELECT a, b FROM e")
def similar_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a video's slides at a distance of at most 0.30; equal sets by their least member."""
    x = slide_sets(spark, sf_dir)
    pairs = G.similar_sets(x, group="video_id", key="read_id", items="items", similarity=0.7)
    same = x.filter(F.size("items") > 0).select("video_id", F.col("read_id").alias("k"), F.array_sort("items").alias("i"))
    rep = same.groupBy("video_id", "i").agg(F.min("k").alias("rep"))
    m = same.join(rep, ["video_id", "i"]).select("video_id", "k", "rep")
    ma, mb = m.select("video_id", F.col("k").alias("ka"), F.col("rep").alias("a")), m.select("video_id", F.col("k").alias("kb"), F.col("rep").alias("b"))
    across = pairs.filter("distance > 0").join(ma, ["video_id", "a"]).join(mb, ["video_id", "b"]).select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))
    copies = ma.join(mb.withColumnRenamed("b", "a"), ["video_id", "a"]).filter("ka < kb").select(F.col("ka").alias("a"), F.col("kb").alias("b"))
    return across.unionByName(copies)


@REGISTRY.add(
    "slide_groups",
    f"""WITH RECURSIVE {_SETS}, ed AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e),
    rc AS (SELECT x AS n, x AS m FROM ed UNION SELECT rc.n, ed.y FROM rc JOIN ed ON rc.m = ed.x),
    cm AS (SELECT n, min(m) AS c FROM rc GROUP BY n),
    k AS (SELECT video_id, read_id, len(s) AS sz, coalesce(c, read_id) AS c FROM g LEFT JOIN cm ON n = read_id),
    z AS (SELECT video_id, c, count(*) AS m, arg_min(read_id, row(-sz, read_id)) AS rep FROM k GROUP BY ALL),
    w AS (SELECT video_id, max(m) / sum(m) AS share, sum(m) AS al FROM z GROUP BY video_id)
    SELECT read_id, CASE WHEN share >= 0.9 AND al > 1 THEN read_id ELSE rep END AS rep FROM k JOIN z USING (video_id, c) JOIN w USING (video_id)""",
)
def slide_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides of a video that show the same page, by their representative."""
    return G.dedup_groups(slide_sets(spark, sf_dir), group="video_id", key="read_id", items="items").select("read_id", "rep")


@REGISTRY.add(
    "slide_group_stats",
    """WITH RECURSIVE """ + _SETS + """, ed AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e),
    rc AS (SELECT x AS n, x AS m FROM ed UNION SELECT rc.n, ed.y FROM rc JOIN ed ON rc.m = ed.x),
    cm AS (SELECT n, min(m) AS c FROM rc GROUP BY n),
    k AS (SELECT video_id, read_id, coalesce(c, read_id) AS c FROM g LEFT JOIN cm ON n = read_id),
    z AS (SELECT video_id, c, count(*) AS m FROM k GROUP BY ALL),
    w AS (SELECT video_id, max(m) / sum(m) AS share, sum(m) AS al, count(*) AS gr, max(m) AS mx FROM z GROUP BY video_id)
    SELECT video_id, al AS slides, CASE WHEN share >= 0.9 AND al > 1 THEN al ELSE gr END AS distinct_slides, CASE WHEN share >= 0.9 AND al > 1 THEN 1 ELSE mx END AS largest FROM w""",
)
def slide_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = G.dedup_groups(slide_sets(spark, sf_dir), group="video_id", key="read_id", items="items")
    sizes = g.groupBy("video_id", "rep").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("video_id").agg(F.sum("n").alias("slides"), F.count(F.lit(1)).alias("distinct_slides"), F.max("n").alias("largest"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


_COS = """n AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query, c.vec_id AS found, q.label AS ql, c.label AS cl, round(list_inner_product(q.v, c.v) / sqrt(list_inner_product(q.v, q.v)) / sqrt(list_inner_product(c.v, c.v)), 9) AS score
      FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, found) AS rank FROM s)"""


@REGISTRY.add("nearest_vectors", f"WITH {_COS} SELECT query, found, round(score, 6) AS score, rank FROM k WHERE rank <= 10")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    v = _vectors(spark, sf_dir)
    return R.nearest_vectors(v.filter("vec_id % 100 = 0"), v, ident="vec_id", vector="embedding", k=10).withColumn("score", F.round("score", 6))


@REGISTRY.add(
    "retrieval_measures",
    f"""WITH {_COS}, f AS (SELECT query, min(rank) FILTER (ql = cl AND rank <= 10) AS first FROM k GROUP BY query HAVING count(*) FILTER (ql = cl) > 0)
    SELECT count(*) AS queries, round(avg(coalesce((first <= 1)::INT, 0)), 3) AS recall_1, round(avg(coalesce((first <= 3)::INT, 0)), 3) AS recall_3, round(avg(coalesce((first <= 5)::INT, 0)), 3) AS recall_5,
      round(avg(coalesce((first <= 10)::INT, 0)), 3) AS recall_10, round(avg(coalesce(1 / first, 0.0)), 3) AS mrr FROM f""",
)
def retrieval_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How soon a vector of the same label is found."""
    v = _vectors(spark, sf_dir)
    q = v.filter("vec_id % 100 = 0")
    gold = q.select(F.col("vec_id").alias("query"), "label").join(v.select(F.col("vec_id").alias("found"), "label"), "label").filter("query <> found")
    return R.ranking_measures(R.nearest_vectors(q, v, ident="vec_id", vector="embedding", k=10), gold, cuts=[1, 3, 5, 10])


@REGISTRY.add(
    "nearest_other_label",
    """WITH n AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    d AS (SELECT q.vec_id AS query, c.vec_id AS found, round(list_sum(list_transform(range(1, 65), lambda i: abs(q.v[i] - c.v[i]))) / 64, 9) AS score FROM n q JOIN n c ON q.label <> c.label WHERE q.vec_id % 100 = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score, found) AS r FROM d)
    SELECT query, found, round(score, 6) AS score, score < 0.06 AS recurring FROM k WHERE r = 1""",
)
def nearest_other_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vector of another label, and whether it's near enough to recur."""
    v = _vectors(spark, sf_dir)
    near = R.nearest_vectors(v.filter("vec_id % 100 = 0"), v, ident="vec_id", vector="embedding", k=1, metric="l1", other_group="label")
    return near.select("query", "found", F.round("score", 6).alias("score"), (F.col("score") < 0.06).alias("recurring"))


@REGISTRY.add(
    "median_vector",
    """WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    SELECT label, pos::INT AS pos, round(median(x::DOUBLE), 6) AS median FROM u GROUP BY ALL""",
)
def median_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element-wise median of each label's vectors."""
    x = _vectors(spark, sf_dir).select("label", F.posexplode("embedding").alias("pos", "x"))
    return x.groupBy("label", (F.col("pos") + 1).alias("pos")).agg(F.round(F.median(F.col("x").cast("double")), 6).alias("median"))
