"""Cuts texts that are too long into overlapping pieces at natural boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import FlatText, chunks

# Characters that end a sentence, close a quotation behind one, end a clause.
SENTENCE_ENDS = "。｡！!？?；;…\n"
CLOSERS = "」』”’）)"
CLAUSE_ENDS = "，,、､：: \u3000"

CLAUSE, SENTENCE = 1, 2


def _among(cps: np.ndarray, chars: str) -> np.ndarray:
    small = np.zeros(0x10000, bool)
    small[[ord(c) for c in chars]] = True
    return small[np.minimum(cps, 0xFFFF)] & (cps < 0xFFFF)


def boundary_strengths(cps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Strength of a cut before each position of the flat text (0 none, 1 clause end, 2 sentence end)."""
    n = len(cps)
    out = np.zeros(n + 1, np.int8)
    if not n:
        return out
    first = np.zeros(n + 1, bool)
    first[at] = True
    run, close = _among(cps, SENTENCE_ENDS), _among(cps, CLOSERS)
    index = np.arange(n)
    # A closer belongs to a sentence end if nothing but closers lies between it and the run.
    base = np.maximum.accumulate(np.where(~close, index, -1))
    start = np.maximum.accumulate(np.where(first[:n], index, 0))
    inside = run | (close & (base >= start) & run[np.maximum(base, 0)])
    follows = np.zeros(n, bool)
    follows[:-1] = inside[1:] & ~first[1:n]
    again = np.zeros(n, bool)
    again[:-1] = close[:-1] & run[1:]
    sentence = inside & (~follows | again)
    dot = cps == ord(".")
    beyond = np.full(n, ord("\n"), np.uint32)
    beyond[:-1] = np.where(first[1:n], ord("\n"), cps[1:])
    sentence |= dot & ((beyond == 0x20) | (beyond == 0x0A))
    out[1:] = np.where(sentence, SENTENCE, np.where(_among(cps, CLAUSE_ENDS), CLAUSE, 0))
    return out


class RangeMax:
    """Sparse table over (strength, position): the strongest position of a range, of equal ones the last.

    Keeps the levels that ranges of the given widths need.
    """

    def __init__(self, strength: np.ndarray, widths: set[int]) -> None:
        self.n = len(strength)
        kind = np.int32 if (int(strength.max(initial=0)) + 1) * self.n < 2**31 else np.int64
        level = strength.astype(kind) * kind(self.n) + np.arange(self.n, dtype=kind)
        keep = {max(w, 1).bit_length() - 1 for w in widths}
        self.levels: dict[int, np.ndarray] = {}
        for k in range(max(keep) + 1):
            if k:
                half = 1 << (k - 1)
                level = np.maximum(level[:-half], level[half:]) if len(level) > half else level[:0]
            if k in keep:
                self.levels[k] = level

    def argmax(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Positions for ranges [lo, hi), all of one kept width."""
        k = int(hi[0] - lo[0]).bit_length() - 1
        return np.maximum(self.levels[k][lo], self.levels[k][hi - (1 << k)]) % self.n


def cut_points(strength: np.ndarray, at: np.ndarray, limit: int, least: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, piece_no, char_from, char_to) of all texts; the texts advance together, a piece at a time."""
    table = RangeMax(strength, {limit - least})
    length = np.diff(at)
    text = np.flatnonzero(length > 0)
    start, number, found = np.zeros(len(text), np.int64), 0, []
    while len(text):
        number += 1
        last = length[text] - start <= limit
        stop = length[text].copy()
        rest = ~last
        if rest.any():
            base = at[text[rest]] + start[rest]
            stop[rest] = table.argmax(base + least + 1, base + limit + 1) - at[text[rest]]
        found.append((text, np.full(len(text), number), start, stop))
        text, start = text[rest], stop[rest] - overlap
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))


def split_oversized(df: DataFrame, *, key: str, text: str, t_start: str, t_end: str, limit: int = 500, least: int = 250, overlap: int = 50) -> DataFrame:
    """(key, piece_no, char_from, char_to, piece_start, piece_end) of every text longer than ``limit`` code points.

    A piece that isn't the last ends at the strongest boundary more than ``least`` and
    at most ``limit`` from its start: the last sentence end, else the last clause end,
    else ``limit``. A sparse table answers that for all texts of a batch at once. The
    next piece starts ``overlap`` before. piece_start and piece_end are the piece's
    share of the row's time span by characters (null where a time is null).

    Texts of at most ``limit``, empty and null texts give no row. Rows repeated with
    one key, text and times give their pieces once. Other columns are not read.
    """
    if not 0 <= overlap <= least < limit:
        raise ValueError("0 <= overlap <= least < limit")
    long = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(t_start).cast("double").alias("t0"), F.col(t_end).cast("double").alias("t1")).filter(F.length("text") > limit)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, 1):
                flat = FlatText(batch.column(1))
                row, number, start, stop = cut_points(boundary_strengths(flat.cps, flat.at), flat.at, limit, least, overlap)
                t0, t1 = (batch.column(i).to_numpy(zero_copy_only=False)[row] for i in (2, 3))
                size = np.diff(flat.at)[row]
                at0, at1 = t0 + (t1 - t0) * (start / size), t0 + (t1 - t0) * (stop / size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(at0, from_pandas=True), pa.array(at1, from_pandas=True)],
                    ["key", "piece_no", "char_from", "char_to", "piece_start", "piece_end"],
                )

    kind = dict(long.dtypes)["key"]
    out = long.mapInArrow(pieces, f"key {kind}, piece_no int, char_from int, char_to int, piece_start double, piece_end double")
    return out.distinct().withColumnRenamed("key", key)
