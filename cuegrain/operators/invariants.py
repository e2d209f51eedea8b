"""Constraints as queries of their violations: rows (rule, entity, detail), none where data are sound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def _as(df: DataFrame, rule: str, entity: str | Column, detail: str | Column) -> DataFrame:
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(F.lit(rule).alias("rule"), col(entity).cast("string").alias("entity"), col(detail).cast("string").alias("detail"))


def disjoint(rows: DataFrame, *, entity: str, key: str, span: tuple[str, str], slack: float = 1e-6) -> DataFrame:
    """Rows that start before the one before ends."""
    before = F.lag(span[1]).over(W.partitionBy(entity).orderBy(span[0], key))
    return _as(rows.withColumn("_b", before).filter(F.col(span[0]) < F.col("_b") - slack), "disjoint", entity, key)


def covering(rows: DataFrame, ends: DataFrame, *, entity: str, key: str, span: tuple[str, str], end: str, slack: float = 1.0) -> DataFrame:
    """Gaps over ``slack`` at the head, between rows, and at the tail."""
    order = W.partitionBy(entity).orderBy(span[0], key)
    x = rows.join(ends, entity).withColumn("_b", F.coalesce(F.lag(span[1]).over(order), F.lit(0.0))).withColumn("_last", F.lead(key).over(order).isNull())
    gap = _as(x.filter(F.col(span[0]) - F.col("_b") > slack), "gap_before", entity, key)
    tail = _as(x.filter(F.col("_last") & (F.col(end) - F.col(span[1]) > slack)), "gap_at_end", entity, key)
    return gap.unionByName(tail)


def assigned_once(rows: DataFrame, *, entity: str, members: str, known: DataFrame | None = None, member: str = "member") -> DataFrame:
    """Members that several rows hold; with ``known`` (entity, member) also those that none holds and that aren't known."""
    held = rows.select(entity, F.explode(members).alias("_m")).groupBy(entity, "_m").agg(F.count(F.lit(1)).alias("_n"))
    out = _as(held.filter("_n > 1"), "held_twice", entity, "_m")
    if known is not None:
        k = known.select(entity, F.col(member).alias("_m"), F.lit(True).alias("_k")).distinct()
        both = held.join(k, [entity, "_m"], "full_outer")
        out = out.unionByName(_as(both.filter("_n IS NULL"), "unassigned", entity, "_m")).unionByName(_as(both.filter("_k IS NULL"), "unknown", entity, "_m"))
    return out


def resolvable(rows: DataFrame, targets: DataFrame, *, on: dict[str, str], rule: str, entity: str, key: str) -> DataFrame:
    """Rows whose reference isn't null and finds no target."""
    t = targets.select(*[F.col(b).alias(f"_t_{b}") for b in on.values()]).distinct()
    match = reduce(lambda x, y: x & y, [F.col(a) == F.col(f"_t_{b}") for a, b in on.items()])
    whole = reduce(lambda x, y: x & y, [F.col(a).isNotNull() for a in on])
    return _as(rows.filter(whole).join(t, match, "left_anti"), rule, entity, key)


def in_range(rows: DataFrame, ends: DataFrame, *, entity: str, key: str, span: tuple[str, str], end: str, slack: float = 1.0) -> DataFrame:
    """Times below 0, ends not after starts, ends beyond the entity's end."""
    x = rows.join(ends, entity, "left")
    bad = (F.col(span[0]) < 0) | (F.col(span[1]) <= F.col(span[0])) | F.coalesce(F.col(span[1]) > F.col(end) + slack, F.lit(False))
    return _as(x.filter(bad), "out_of_range", entity, key)


def not_blank(rows: DataFrame, *, column: str, rule: str, entity: str, key: str) -> DataFrame:
    return _as(rows.filter(T.strip_space(F.coalesce(column, F.lit(""))) == ""), rule, entity, key)


def complete_chunks(chunks: DataFrame, *, required: list[str]) -> DataFrame:
    """Chunks with a required value missing, or a hash that isn't their text's."""
    missing = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in required])
    return _as(chunks.filter(missing), "incomplete", "video_id", "chunk_id").unionByName(_as(chunks.filter(~T.content_sha(F.col("text")).eqNullSafe(F.col("content_sha"))), "hash", "video_id", "chunk_id"))


def unchanged(now: DataFrame, then: DataFrame, *, entity: str, digest: str) -> DataFrame:
    """Entities whose digest isn't the one kept."""
    both = now.select(entity, F.col(digest).alias("_a")).join(then.select(entity, F.col(digest).alias("_b")), entity)
    return _as(both.filter(~F.col("_a").eqNullSafe(F.col("_b"))), "changed", entity, "_a")


def corrections_in_text(corrections: DataFrame, *, entity: str, before: str, raw: str) -> DataFrame:
    """Corrections whose original isn't in the raw text."""
    return _as(corrections.filter(~F.coalesce(F.contains(F.col(raw), F.col(before)), F.lit(False))), "correction", entity, before)


def check_all(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)


class Violated(AssertionError):
    """Data break a constraint."""


def assert_all(*violations: DataFrame, show: int = 20) -> None:
    """Raise with counts by rule, if there is any violation."""
    counts = check_all(*violations).groupBy("rule").agg(F.count(F.lit(1)).alias("n")).orderBy("rule").limit(show).collect()
    if counts:
        raise Violated(", ".join(f"{r['rule']}: {r['n']}" for r in counts))
