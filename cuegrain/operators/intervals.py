"""Joins on time: as-of, overlap and tolerance, always within an entity and a range of time.

Spark has no strategy for inequality joins, so each is turned into an equi-join on
(entity, cell of time). An entity that holds much of the data is spread by its cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _cells(lo: Column, hi: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))


def asof(points: DataFrame, marks: DataFrame, *, entity: str, time: str, mark_time: str, value: list[str], cell: float = 600.0, prefix: str = "") -> DataFrame:
    """Every point with the values of the last mark at or before its time (null without one).

    Both are laid into one series. Within a cell a window function carries the last
    mark on; across cells only each cell's last mark is carried, so no task holds an
    entity's whole series. Of marks at one time the greatest values win. Points with
    a null time get nulls.
    """
    names = points.columns
    held = F.struct(F.col(mark_time).cast("double").alias("_t"), *[F.col(v).alias(v) for v in value])
    m = marks.filter(F.col(mark_time).isNotNull()).select(F.col(entity).alias("_e"), F.col(mark_time).cast("double").alias("_time"), held.alias("_mark"), F.lit(None).cast(points.select(F.struct(*names)).schema[0].dataType).alias("_point"))
    p = points.select(F.col(entity).alias("_e"), F.col(time).cast("double").alias("_time"), F.lit(None).cast(m.schema["_mark"].dataType).alias("_mark"), F.struct(*names).alias("_point"))
    series = m.unionByName(p).withColumn("_cell", F.floor(F.col("_time") / cell))
    here = F.max("_mark").over(W.partitionBy("_e", "_cell").orderBy("_time").rangeBetween(W.unboundedPreceding, 0))
    series = series.withColumn("_here", F.when(F.col("_time").isNotNull(), here))
    ends = m.groupBy("_e", F.floor(F.col("_time") / cell).alias("_cell")).agg(F.max("_mark").alias("_last"))
    spans = series.select("_e", "_cell").distinct().join(ends, ["_e", "_cell"], "left")
    carried = spans.withColumn("_carry", F.max("_last").over(W.partitionBy("_e").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1))).select(F.col("_e").alias("_e2"), F.col("_cell").alias("_cell2"), "_carry")
    same = series["_e"].eqNullSafe(carried["_e2"]) & (series["_cell"] == carried["_cell2"])
    out = series.filter("_point IS NOT NULL").join(carried, same, "left").withColumn("_found", F.coalesce("_here", "_carry"))
    return out.select(*[F.col(f"_point.{n}").alias(n) for n in names], *[F.col(f"_found.{v}").alias(prefix + v) for v in value])


def overlaps(a: DataFrame, b: DataFrame, *, entity: str, a_span: tuple[str, str], b_span: tuple[str, str], pad: float = 0.0, cell: float = 300.0) -> DataFrame:
    """Pairs of rows of one entity whose spans overlap once ``a`` is widened by ``pad``; touching spans count.

    Columns of both, which must differ but for the entity, and ``overlap`` in seconds
    (negative where only the pad reaches). A pair meets in the first cell that both have.
    """
    lo_a, hi_a = F.col(a_span[0]) - pad, F.col(a_span[1]) + pad
    left = a.filter(F.col(a_span[0]).isNotNull() & F.col(a_span[1]).isNotNull() & (hi_a >= lo_a)).withColumn("_cell", _cells(lo_a, hi_a, cell))
    right = b.filter(F.col(b_span[0]).isNotNull() & F.col(b_span[1]).isNotNull() & (F.col(b_span[1]) >= F.col(b_span[0]))).withColumn("_cell", _cells(F.col(b_span[0]), F.col(b_span[1]), cell))
    both = left.join(right, [entity, "_cell"])
    meet = (F.col(b_span[0]) <= hi_a) & (F.col(b_span[1]) >= lo_a)
    first = F.col("_cell") == F.greatest(F.floor(lo_a / cell), F.floor(F.col(b_span[0]) / cell))
    amount = F.least(F.col(a_span[1]), F.col(b_span[1])) - F.greatest(F.col(a_span[0]), F.col(b_span[0]))
    return both.filter(meet & first).drop("_cell").withColumn("overlap", amount)


def best_overlap(a: DataFrame, b: DataFrame, *, entity: str, a_id: str, a_span: tuple[str, str], b_id: str, b_span: tuple[str, str], cell: float = 300.0) -> DataFrame:
    """(a_id, b_id): for each row of ``a`` the row of ``b`` with the greatest positive overlap, the earlier one on ties; null without."""
    pairs = overlaps(a.select(entity, a_id, *a_span), b.select(entity, b_id, *b_span), entity=entity, a_span=a_span, b_span=b_span, cell=cell).filter("overlap > 0")
    best = pairs.groupBy(a_id).agg(F.min_by(b_id, F.struct(-F.col("overlap"), F.col(b_span[0]), F.col(b_id))).alias(b_id))
    return a.select(a_id).distinct().join(best, a_id, "left")


def windows_between(marks: DataFrame, ends: DataFrame, *, entity: str, time: str, end: str) -> DataFrame:
    """(entity, w_index, w_start, w_end): the spans that marks cut an entity's [0, end] into.

    Marks at or before 0, at or after the end, repeated and null ones cut nothing.
    """
    inside = marks.select(entity, F.col(time).cast("double").alias("w_start")).filter("w_start > 0").join(ends.select(entity, F.col(end).alias("_end")), entity).filter("w_start < _end")
    starts = inside.unionByName(ends.filter(F.col(end) > 0).select(entity, F.lit(0.0).alias("w_start"), F.col(end).alias("_end"))).distinct()
    order = W.partitionBy(entity).orderBy("w_start")
    return starts.select(entity, (F.row_number().over(order) - 1).alias("w_index"), "w_start", F.coalesce(F.lead("w_start").over(order), F.col("_end")).alias("w_end"))


def assign_to_windows(cues: DataFrame, windows: DataFrame, *, entity: str, cue: str, span: tuple[str, str], cell: float = 600.0) -> DataFrame:
    """(cue, w_index): every cue in the window that holds its midpoint (end excluded), else in the nearest one.

    Windows of an entity don't overlap. Nearest is by the lesser distance to either
    end; the lower index wins ties. Cues of an entity without windows get null.
    """
    mid = cues.select(entity, cue, ((F.col(span[0]) + F.col(span[1])) / 2).alias("_mid"))
    w = windows.select(entity, "w_index", "w_start", "w_end")
    before = asof(mid, w, entity=entity, time="_mid", mark_time="w_start", value=["w_start", "w_end", "w_index"], cell=cell, prefix="b_")
    ahead = w.select(entity, "w_index", (-F.col("w_start")).alias("_minus"), F.col("w_start"), F.col("w_end"))
    both = asof(before.withColumn("_neg", -F.col("_mid")), ahead, entity=entity, time="_neg", mark_time="_minus", value=["w_start", "w_end", "w_index"], cell=cell, prefix="n_")
    far = lambda p: F.coalesce(F.least(F.abs(F.col("_mid") - F.col(f"{p}_w_start")), F.abs(F.col("_mid") - F.col(f"{p}_w_end"))), F.lit(float("inf")))
    inside = F.col("_mid") < F.col("b_w_end")
    return both.select(cue, F.when(inside, F.col("b_w_index")).when(far("b") <= far("n"), F.col("b_w_index")).otherwise(F.coalesce("n_w_index", "b_w_index")).alias("w_index"))


def coarse_windows(candidates: DataFrame, ends: DataFrame, *, entity: str, ident: str, span: tuple[str, str], end: str, least: float) -> DataFrame:
    """(entity, t_start, t_end, ident): candidates and the gaps longer than ``least`` between them, ident null in a gap.

    A shorter gap goes to the window before it; before the first candidate it stays open.
    """
    order = W.partitionBy(entity).orderBy("_s", ident)
    c = candidates.select(entity, F.col(ident), F.col(span[0]).alias("_s"), F.col(span[1]).alias("_e")).join(ends.select(entity, F.col(end).alias("_end")), entity)
    c = c.withColumn("_from", F.coalesce(F.lag("_e").over(order), F.lit(0.0))).withColumn("_next", F.coalesce(F.lead("_s").over(order), F.col("_end")))
    c = c.withColumn("_last", F.lead("_s").over(order).isNull())
    gap = F.when(F.col("_s") - F.col("_from") > least, F.struct(F.col("_from").alias("t_start"), F.col("_s").alias("t_end"), F.lit(None).cast("string").alias(ident)))
    room = F.col("_next") - F.col("_e")
    own = F.struct(F.greatest("_from", "_s").alias("t_start"), F.when((room > 0) & (room <= least), F.col("_next")).otherwise(F.col("_e")).alias("t_end"), F.col(ident).alias(ident))
    tail = F.when(F.col("_last") & (F.col("_end") - F.col("_e") > least), F.struct(F.col("_e").alias("t_start"), F.col("_end").alias("t_end"), F.lit(None).cast("string").alias(ident)))
    rows = c.select(entity, F.explode(F.filter(F.array(gap, own, tail), lambda x: x.isNotNull())).alias("w")).select(entity, "w.*")
    bare = ends.join(candidates.select(entity).distinct(), entity, "left_anti").select(entity, F.lit(0.0).alias("t_start"), F.col(end).alias("t_end"), F.lit(None).cast("string").alias(ident))
    return rows.unionByName(bare)


def padded_text(spans: DataFrame, cues: DataFrame, *, entity: str, span_id: str, span: tuple[str, str], cue_id: str, cue_span: tuple[str, str], text: str, pad: float) -> DataFrame:
    """(span_id, text): the text of all cues that a span reaches with its pad, in order of time; '' without."""
    pairs = overlaps(spans.select(entity, span_id, *span), cues.select(entity, cue_id, F.col(cue_span[0]).alias("_cs"), F.col(cue_span[1]).alias("_ce"), F.col(text).alias("_text")), entity=entity, a_span=span, b_span=("_cs", "_ce"), pad=pad)
    parts = pairs.groupBy(span_id).agg(F.array_sort(F.collect_list(F.struct("_cs", cue_id, "_text"))).alias("_parts"))
    joined = parts.select(span_id, F.array_join(F.transform("_parts", lambda x: F.coalesce(x["_text"], F.lit(""))), "").alias(text))
    return spans.select(span_id).distinct().join(joined, span_id, "left").fillna("", [text])


def snap(times: DataFrame, anchors: DataFrame, *, entity: str, time: str, anchor: str, radius: float) -> DataFrame:
    """(entity, time, snapped): the nearest anchor within ``radius`` (the earlier on ties), else the time itself."""
    t = times.select(entity, time).filter(F.col(time).isNotNull()).distinct()
    a = anchors.select(entity, F.col(anchor).alias("_a")).filter(F.col("_a").isNotNull()).distinct()
    pairs = overlaps(t, a, entity=entity, a_span=(time, time), b_span=("_a", "_a"), pad=radius)
    near = pairs.filter(F.abs(F.col(time) - F.col("_a")) <= radius).groupBy(entity, time).agg(F.min_by("_a", F.struct(F.abs(F.col(time) - F.col("_a")), F.col("_a"))).alias("_near"))
    return t.join(near, [entity, time], "left").select(entity, time, F.coalesce("_near", time).alias("snapped"))


def near_any(points: DataFrame, marks: DataFrame, *, entity: str, time: str, mark_time: str, tolerance: float) -> DataFrame:
    """Points (entity, time) that have a mark of their entity within the tolerance."""
    p = points.select(entity, time).distinct()
    near = overlaps(p.withColumn("_a", F.col(time)), marks.select(entity, F.col(mark_time).alias("_m")).distinct(), entity=entity, a_span=("_a", "_a"), b_span=("_m", "_m"), pad=tolerance * (1 + 1e-9) + 1e-9)
    hit = near.filter(F.abs(F.col("_a") - F.col("_m")) <= tolerance).select(entity, time).distinct()
    return points.join(hit, [entity, time], "left_semi")


def in_body(points: DataFrame, bodies: DataFrame, *, entity: str, time: str) -> DataFrame:
    """Points within their entity's body (entity, body_start, body_end), ends included; all of an entity whose body isn't known at both ends."""
    b = bodies.select(entity, "body_start", "body_end")
    x = points.join(b, entity, "left")
    known = F.col("body_start").isNotNull() & F.col("body_end").isNotNull()
    return x.filter(~known | F.col(time).between(F.col("body_start"), F.col("body_end"))).drop("body_start", "body_end")
