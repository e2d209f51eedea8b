"""Share of a text that only repeats earlier parts of the same text.

The named method (a log-likelihood ratio of hashed n-grams between a target and the
whole corpus) scores a text against other texts and can't tell whether it repeats
itself; positions of hashed n-grams within the text do. See the README.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import FlatText, chunks, letters_digits

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def window_hashes(cps: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every stretch of ``n`` code points, joined from those of halves."""
    one = (cps.astype(np.uint64) + np.uint64(1)) * _MIX
    one ^= one >> np.uint64(29)
    width, hashed, powers = 1, one, _P
    rest, out, length = n, None, 0
    while rest:
        if rest & 1:
            out = hashed if out is None else out[: len(out) - width] * powers + hashed[length : length + len(out) - width]
            length += width
        rest >>= 1
        if rest:
            hashed = hashed[:-width] * powers + hashed[width:] if len(hashed) > width else hashed[:0]
            powers = np.uint64((int(powers) * int(powers)) & 0xFFFFFFFFFFFFFFFF)
            width *= 2
        if len(hashed) == 0 and rest:
            return np.zeros(0, np.uint64)
    return out


def repeated_shares(flat: FlatText, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept characters, repeated characters) of every text.

    Equal hashes are compared character by character with the first stretch of the
    same hash, so that a collision can't count.
    """
    texts = len(flat.at) - 1
    keep = letters_digits(flat.cps).astype(bool)
    before = np.concatenate([[0], np.cumsum(keep)])
    at = before[flat.at]
    cps = flat.cps[keep]
    kept = np.diff(at)
    if len(cps) < n:
        return kept, np.zeros(texts, np.int64)
    owner = np.repeat(np.arange(texts), kept)
    hashes = window_hashes(cps, n)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[n - 1 :])
    key = hashes[inside] ^ (owner[inside].astype(np.uint64) * _P)
    order = np.argsort(key, kind="stable")
    key, place = key[order], inside[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = place[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    later, earlier = place[~new], first[~new]
    same = owner[later] == owner[earlier]
    for i in range(n):
        same &= cps[later + i] == cps[earlier + i]
    if not same.all():  # settle the few stretches whose hash isn't theirs alone
        for p, q in zip(later[~same], earlier[~same]):
            lo = at[owner[p]]
            text = cps[lo : p + n - 1]
            here = cps[p : p + n]
            hits = np.flatnonzero(text[: len(text) - n + 1] == here[0]) if len(text) >= n else []
            if any((text[h : h + n] == here).all() for h in hits):
                later = np.append(later, p)
                same = np.append(same, True)
    cover = np.zeros(len(cps) + 1, np.int64)
    cover[later[same]] += 1
    cover[later[same] + n] -= 1
    covered = np.cumsum(cover)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(covered)])
    return kept, total[at[1:]] - total[at[:-1]]


def repeated_share(df: DataFrame, *, key: str, text: str, n: int = 12) -> DataFrame:
    """(key, kept, repeated, share) of every row.

    Of the text only letters and digits (Unicode classes L and N) are kept. A kept
    character is repeated if it lies in a stretch of ``n`` whose same characters also
    start earlier in the same text. share is repeated / kept; 0 where nothing is kept,
    as for empty and null texts. Repeated rows give a row each. Other columns are not read.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, 1):
                kept, repeated = repeated_shares(FlatText(batch.column(1)), n)
                share = repeated / np.maximum(kept, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.int64()), pa.array(repeated, pa.int64()), pa.array(share)], ["key", "kept", "repeated", "share"])

    return rows.mapInArrow(measure, f"key {dict(rows.dtypes)['key']}, kept bigint, repeated bigint, share double").withColumnRenamed("key", key)
