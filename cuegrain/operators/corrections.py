"""Term corrections: gating, proposals from a lexicon, and their measures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut


def validate_corrections(proposed: DataFrame, *, key: str, raw: str, sounds: dict[str, str] | None = None) -> DataFrame:
    """Proposals (key, pos, before, after, raw) that may be applied: trimmed, not blank or idle, found in the raw text, allowed, the first of equal ones."""
    bare = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    x = proposed.withColumn("before", bare("before")).withColumn("after", bare("after"))
    x = x.filter((F.col("before") != "") & (F.col("after") != "") & (F.col("before") != F.col("after")) & F.contains(F.col(raw), F.col("before")))
    x = x.filter(T.rejection(F.col("before"), F.col("after"), sounds).isNull())
    first = F.row_number().over(W.partitionBy(key, "before", "after").orderBy("pos"))
    return x.withColumn("_n", first).filter("_n = 1").drop("_n")


def lexicon(texts: DataFrame, *, text: str, least: int = 3, most: int = 12) -> DataFrame:
    """(term): distinct runs of Han characters in any text."""
    return texts.select(F.explode(T.han_runs(F.col(text), least, most)).alias("term")).distinct()


def ngram_lexicon(texts: DataFrame, *, key: str, text: str, documents: int, least: int = 3, most: int = 5) -> DataFrame:
    """(term, n): all stretches of ``least`` to ``most`` Han characters that at least so many texts have."""
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit("([一-鿿]+)"), 1)).alias("_run")
    runs = texts.filter(F.col(text).isNotNull()).select(key, run)
    grams = runs.select(key, F.explode(F.array_distinct(F.concat(*[T.gram_list(F.col("_run"), n) for n in range(least, most + 1)]))).alias("term")).distinct()
    return grams.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= documents)


def new_corrections(proposed: DataFrame, existing: DataFrame, *, key: str, sounds: dict[str, str] | None = None) -> DataFrame:
    """Proposals (key, before, after, ...) that a text doesn't have yet and that the gate allows."""
    fresh = proposed.join(existing.select(key, "before").distinct(), [key, "before"], "left_anti")
    return fresh.filter(T.rejection(F.col("before"), F.col("after"), sounds).isNull())


#: Terms that are held in memory at once, and characters of texts that are looked at together.
TERMS_AT_ONCE, TEXT_CHARS = 1 << 18, 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _cuts(n: int, similarity: float) -> list[tuple[int, int]]:
    """(start, length) of the parts of a term of n characters, of which a stretch as similar as asked shares one."""
    parts = int((1 - similarity) * n + 1e-9) + 1
    at = [n * p // parts for p in range(parts + 1)]
    return [(i, j - i) for i, j in zip(at, at[1:])]


def _windows(cps: np.ndarray, width: int) -> np.ndarray:
    """A hash of every window of ``width`` characters."""
    out = np.zeros(max(len(cps) - width + 1, 0), np.uint64)
    for i in range(width):
        out = (out ^ (cps[i : i + len(out)].astype(np.uint64) + np.uint64(1))) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _sounded(texts: list[str], table: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, the same with each character's lower case or sound, offsets)."""
    cps = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    kinds, back = np.unique(cps, return_inverse=True)
    plain = [ord(x) if len(x := chr(c).lower()) == 1 else c for c in kinds.tolist()]
    said = np.array([table.get(c, c) for c in plain], np.uint32)
    return cps, said[back.reshape(-1)] if len(cps) else cps, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


class _Near:
    """Terms of one length, in order, by all that is left of their sounds without any ``d`` places."""

    def __init__(self, terms: list[str], n: int, d: int, table: dict[int, int]) -> None:
        self.terms, self.n, self.d = terms, n, d
        raw, said, _ = _sounded(terms, table)
        self.raw, self.said = raw.reshape(-1, n), said.reshape(-1, n)
        self.odd = np.random.default_rng(n).integers(1, 2**63, n).astype(np.uint64) | np.uint64(1)
        self.kept, self.begun = [], np.zeros(1 << 22, bool)
        for _, h in self.left(self.said):
            order = np.argsort(h)
            self.kept.append((h[order], order))
            self.begun[h >> np.uint64(42)] = True

    def left(self, said: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        x = (said.astype(np.uint64) + np.uint64(1)) * self.odd
        each = ((x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).T.copy()
        total = each.sum(axis=0, dtype=np.uint64)
        for k, places in enumerate(combinations(range(self.n), self.d)):
            h = total.copy()
            for i in places:
                h -= each[i]
            h = (h ^ (h >> np.uint64(32)) ^ np.uint64(k)) * _ODD
            yield k, h

    def best(self, raw: np.ndarray, said: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term, differences) of the nearest term of every stretch, the least of several; -1 where there is none or it is a term itself."""
        none = np.iinfo(np.int64).max
        out, itself = np.full(len(raw), none), np.zeros(len(raw), bool)
        for k, h in self.left(said):
            some = np.flatnonzero(self.begun[h >> np.uint64(42)])
            known, order = self.kept[k]
            lo, hi = np.searchsorted(known, h[some]), np.searchsorted(known, h[some], "right")
            some, lo, count = some[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            done = np.cumsum(count)
            begin = 0
            while begin < len(some):  # a few pairs at a time, however many terms are near
                end = max(begin + 1, int(np.searchsorted(done, (done[begin - 1] if begin else 0) + (1 << 20), "right")))
                c = count[begin:end]
                u = np.repeat(some[begin:end], c)
                t = order[np.repeat(lo[begin:end], c) + np.arange(len(u)) - np.repeat(np.cumsum(c) - c, c)]
                differ = (said[u] != self.said[t]).sum(axis=1)
                same = (raw[u] == self.raw[t]).all(axis=1)
                itself[u[same]] = True
                ok = ~same & (differ <= self.d)
                np.minimum.at(out, u[ok], differ[ok] * len(self.terms) + t[ok])
                begin = end
        off = itself | (out == none)
        return np.where(off, -1, out % len(self.terms)), out // len(self.terms)


class _Lexicon:
    """Terms in memory: which windows of texts share a part with one of their length, and which are near one."""

    def __init__(self, terms: list[str], lengths: range, similarity: float, table: dict[int, int]) -> None:
        self.table, self.near, self.parts, self.masks = table, {}, {}, {}
        for n in lengths:
            own = sorted(t for t in terms if len(t) == n)
            if not own:
                continue
            self.near[n] = _Near(own, n, int((1 - similarity) * n + 1e-9), table)
            self.parts[n] = []
            for start, width in _cuts(n, similarity):
                masks = self.masks.setdefault(width, [[], 64])
                if masks[1] == 64:
                    masks[0].append(np.zeros(1 << 20, np.uint64))
                    masks[1] = 0
                self.parts[n].append((start, width, len(masks[0]) - 1, np.uint64(1 << masks[1])))
                h = _windows(self.near[n].said[:, start : start + width].reshape(-1), width)[:: max(width, 1)] if width else np.zeros(1, np.uint64)
                masks[0][-1][np.unique(h >> np.uint64(44))] |= np.uint64(1 << masks[1])
                masks[1] += 1

    def search(self, texts: list[str]) -> Iterator[tuple[np.ndarray, list[str], list[str], list[float]]]:
        """(text, before, after, score) by length, a text's equal stretches once."""
        whole = "".join(texts)
        raw, said, at = _sounded(texts, self.table)
        owner = np.repeat(np.arange(len(texts)), np.diff(at))
        held = {w: [m[(_windows(said, w) if w else np.zeros(len(said) + 1, np.uint64)) >> np.uint64(44)] for m in masks] for w, (masks, _) in self.masks.items()}
        for n, near in self.near.items():
            count = len(raw) - n + 1
            if count <= 0:
                continue
            hit = np.zeros(count, bool)
            for start, width, which, bit in self.parts[n]:
                hit |= (held[width][which][start : start + count] & bit) != 0
            place = np.flatnonzero(hit & (owner[:count] == owner[n - 1 :]))
            across = np.arange(n)
            h = np.zeros(len(place), np.uint64)
            for i in range(n):
                h = (h ^ (raw[place + i].astype(np.uint64) + np.uint64(1))) * _ODD
                h ^= h >> np.uint64(29)
            _, first, back = np.unique(h, return_index=True, return_inverse=True)
            back = back.reshape(-1)
            if any((raw[place + i] != raw[place[first[back]] + i]).any() for i in range(n)):  # two stretches of one hash
                _, first, back = np.unique(raw[place[:, None] + across], axis=0, return_index=True, return_inverse=True)
                back = back.reshape(-1)
            spot = place[first][:, None] + across
            term, differ = near.best(raw[spot], said[spot])
            good = np.flatnonzero(term[back] >= 0)
            pair = np.unique(owner[place[good]] * max(len(first), 1) + back[good])
            text, u = pair // max(len(first), 1), pair % max(len(first), 1)
            if len(pair):
                begin = place[first[u]].tolist()
                yield text, [whole[i : i + n] for i in begin], [near.terms[t] for t in term[u].tolist()], np.round(1 - differ[u] / n, 9)


def propose(texts: DataFrame, terms: DataFrame, *, key: str, text: str, similarity: float = 0.90, least: int = 3, most: int = 12, sounds: dict[str, str] | None = None) -> DataFrame:
    """(key, before, after, score): stretches of a text that sound like a lexicon term of their length but aren't it.

    A stretch and a term of n characters as similar as asked differ in at most
    d = floor((1 - similarity) * n) places, so that cut into d + 1 parts they share one, and without some d places
    they are the same. Texts are read against the terms in memory: the different stretches that share a part
    with any term are looked up without every d places, and what is found so is compared. Terms come
    :data:`TERMS_AT_ONCE` at a time, about; where there are more, the texts are read once for each lot and the lots' best are joined.
    Stretches that are terms themselves propose nothing. Of several terms for one stretch the best
    counts, then the least. Null texts have no stretch; repeated rows count once.
    """
    order = sorted(set(sounds.values())) if sounds else []
    codes = {ord(k): 0xF0000 + order.index(v) for k, v in (sounds or {}).items()}
    spoken = terms.select("term").filter(F.length("term").between(least, most)).distinct()
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.length("text") >= least)
    schema = f"key {dict(rows.dtypes)['key']}, before string, after string, score double"

    def near(lot: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = _Lexicon(lot, range(least, most + 1), similarity, codes)
            for batch in batches:
                keys, found = batch.column(0), batch.column(1).to_pylist()
                total, start = np.cumsum([len(t) for t in found]), 0
                while start < len(found):
                    stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + TEXT_CHARS, "right")))
                    for at, before, after, score in held.search(found[start:stop]):
                        yield pa.RecordBatch.from_arrays([keys.take(pa.array(start + at)), pa.array(before), pa.array(after), pa.array(score)], ["key", "before", "after", "score"])
                    start = stop

        return rows.mapInArrow(run, schema)

    lots = max(1, -(-spoken.count() // TERMS_AT_ONCE))
    lot = lambda i: spoken.filter(F.pmod(F.xxhash64("term"), F.lit(lots)) == i).toArrow().column(0).to_pylist()
    if lots == 1:
        found = near(lot(0)).distinct()
    else:
        found = reduce(DataFrame.unionByName, [cut(near(lot(i)), "proposals") for i in range(lots)])
        best = found.groupBy("key", "before").agg(F.min(F.struct((-F.col("score")).alias("s"), "after")).alias("b"))
        found = best.join(spoken.withColumnRenamed("term", "before"), "before", "left_anti").select("key", "before", F.col("b.after").alias("after"), (-F.col("b.s")).alias("score"))
    return found.select(F.col("key").alias(key), "before", "after", "score")


def _together(**rows: DataFrame) -> DataFrame:
    """One row of the counts that several one-row tables hold."""
    out = None
    for row in rows.values():
        out = row if out is None else out.unionByName(row, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def set_scores(applied: DataFrame, expected: DataFrame) -> DataFrame:
    """One row (tp, fp, fn, precision, recall, f1) of two sets of rows with the same columns; nulls are equal."""
    a, e = applied.distinct(), expected.distinct()
    x = _together(tp=a.intersect(e).agg(F.count(F.lit(1)).alias("tp")), na=a.agg(F.count(F.lit(1)).alias("na")), ne=e.agg(F.count(F.lit(1)).alias("ne")))
    precision = F.when(F.col("na") > 0, F.col("tp") / F.col("na")).otherwise(F.when(F.col("ne") == 0, 1.0).otherwise(0.0))
    recall = F.when(F.col("ne") > 0, F.col("tp") / F.col("ne")).otherwise(F.when(F.col("na") == 0, 1.0).otherwise(0.0))
    x = x.withColumn("precision", precision).withColumn("recall", recall)
    both = F.col("precision") + F.col("recall")
    return x.select("tp", (F.col("na") - F.col("tp")).alias("fp"), (F.col("ne") - F.col("tp")).alias("fn"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), F.round(F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0), 9).alias("f1"))


def outcome_scores(applied: DataFrame, expected: DataFrame, texts: DataFrame) -> DataFrame:
    """The same by outcome: applied (key, before, after) is right if the ideal text has ``after`` and not ``before``; expected is met if the corrected text does. texts (key, ideal, corrected)."""
    t = texts.select("key", F.coalesce("ideal", F.lit("")).alias("ideal"), F.coalesce("corrected", F.lit("")).alias("corrected"))
    good = lambda column: F.contains(F.coalesce(column, F.lit("")), F.col("after")) & ~F.contains(F.coalesce(column, F.lit("")), F.col("before"))
    a = applied.join(t, "key", "left").agg(F.count_if(good("ideal")).alias("tp"), F.count(F.lit(1)).alias("na"))
    e = expected.join(t, "key", "left").agg(F.count_if(good("corrected")).alias("fixed"), F.count(F.lit(1)).alias("ne"))
    x = _together(a=a, e=e)
    precision = F.when(F.col("na") > 0, F.col("tp") / F.col("na")).otherwise(F.when(F.col("ne") == 0, 1.0).otherwise(0.0))
    recall = F.when(F.col("ne") > 0, F.col("fixed") / F.col("ne")).otherwise(F.when(F.col("na") == 0, 1.0).otherwise(0.0))
    return x.select("tp", (F.col("na") - F.col("tp")).alias("fp"), (F.col("ne") - F.col("fixed")).alias("fn"), F.round(precision, 9).alias("precision"), F.round(recall, 9).alias("recall"))
