"""Arrow text columns as flat code-point arrays, the form that the NumPy kernels work on."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Bytes of text that a kernel takes at once. A single longer text is taken alone and whole.
CHUNK_BYTES = 1 << 22


class FlatText:
    """Texts laid end to end. cps: uint32 code points; at: int64 offsets, one more than texts; null counts as empty."""

    def __init__(self, column: pa.Array) -> None:
        column = column.fill_null("").cast(pa.large_string())
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        n = len(column)
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = memoryview(data)[ends[0] : ends[-1]] if data is not None else b""
        self.raw = bytes(raw)
        self.byte_at = ends - ends[0]
        octets = np.frombuffer(self.raw, np.uint8)
        lead = (octets & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(lead)])
        self.at = before[self.byte_at]
        self.lead = lead
        self.cps = np.frombuffer(self.raw.decode().encode("utf-32-le"), np.uint32)

    def byte_starts(self) -> np.ndarray:
        """Byte position of every code point, and the end."""
        return np.append(np.flatnonzero(self.lead), len(self.raw))

    def owner(self) -> np.ndarray:
        """Index of the text that each code point belongs to."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``limit`` bytes of text each, or one row."""
    lengths = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    total = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class ClassTable:
    """A byte for every code point, filled in as code points come up."""

    def __init__(self, of) -> None:
        self.of, self.table = of, np.full(0x110000, 255, np.uint8)

    def __call__(self, cps: np.ndarray) -> np.ndarray:
        out = self.table[cps]
        new = out == 255
        if new.any():
            for cp in np.unique(cps[new]):
                self.table[cp] = self.of(chr(cp))
            out = self.table[cps]
        return out


def _kept(ch: str) -> int:
    return unicodedata.category(ch)[0] in "LN"


letters_digits = ClassTable(_kept)
visible = ClassTable(lambda ch: not (ch.isspace() or unicodedata.category(ch) in ("Cc", "Cf", "Zs", "Zl", "Zp")))
