"""Encoding with a public byte-level tokenizer through a minimal acyclic transducer.

Frequent words (pre-tokens) are compiled with their ids into an automaton that shares
prefixes and suffixes. Each transition carries a number; the numbers along a word add
up to the word's rank, and the rank finds its ids. The automaton is one file of
arrays, sent to the executors once and mapped into memory by their workers, which
walk it for all words of a batch at once, a byte at a time. Words that it doesn't
hold are merged by the tokenizer itself, so that the lexicon changes the speed and
never the ids.
"""

from __future__ import annotations

import base64
import json
import struct
import unicodedata
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, shared_dir
from .flat import ClassTable, FlatText, chunks

#: Folder of the tokenizers' files.
TOKENIZERS = "/opt/tokenizers"
#: Bounds of the lexicon, so that its file stays below some 60 MB whatever the corpus.
WORDS, WORD_BYTES = 20_000, 48
#: Words outside the lexicon whose ids a worker keeps.
CACHE = 200_000

# Fixed value: the pre-token pattern of the byte_bpe vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LETTER, _NUMBER, _BLANK, _OTHER, _UNKNOWN = 0, 1, 2, 3, 4
# Unicode's White_Space.
_WHITE = {chr(c) for c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}


def _class_of(ch: str) -> int:
    if ch in _WHITE:
        return _BLANK
    category = unicodedata.category(ch)
    if category == "Cn":
        return _UNKNOWN
    return {"L": _LETTER, "N": _NUMBER}.get(category[0], _OTHER)


_classes = ClassTable(_class_of)
_APOSTROPHE = ord("'")


def word_starts(flat: FlatText) -> tuple[np.ndarray, np.ndarray]:
    """(first code point of every word, texts that hold characters unknown to this Unicode version).

    The words are the matches of :data:`PATTERN`, found by comparing neighbouring
    character classes over all texts at once.
    """
    cps, n = flat.cps, len(flat.cps)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _classes(cps)
    first = np.zeros(n + 1, bool)
    first[flat.at] = True
    unknown = np.flatnonzero(kind == _UNKNOWN)
    strange = np.unique(np.searchsorted(flat.at, unknown, "right") - 1) if len(unknown) else unknown
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 9, kind[:-1]
    before[first[:n]] = 9
    start = kind != before
    blank = kind == _BLANK
    # The last blank before a word stands alone, or leads the word if it's U+0020.
    ahead = np.empty(n, bool)
    ahead[-1], ahead[:-1] = False, ~blank[1:] & ~first[1:n]
    last = blank & ahead
    start |= last
    joined = np.flatnonzero(last & (cps == 0x20)) + 1
    start[joined] = False
    # Contractions: an apostrophe that starts a word without a leading blank.
    marks = np.flatnonzero((cps == _APOSTROPHE) & start)
    if len(marks):
        padded = np.concatenate([cps, np.zeros(3, np.uint32)])
        room = flat.at[np.searchsorted(flat.at, marks, "right")] - marks
        one, two = padded[marks + 1], padded[marks + 2]
        is_one = (room >= 2) & np.isin(one, [ord(c) for c in "stmd"])
        is_two = np.zeros(len(marks), bool)
        for pair in ("re", "ve", "ll"):
            is_two |= (one == ord(pair[0])) & (two == ord(pair[1]))
        is_two &= room >= 3
        for hit, size in ((marks[is_one], 2), (marks[is_two], 3)):
            start[hit + 1] = False
            end = hit + size
            start[end[end < n]] = True
    # A contraction's end may start a word that a joined blank took away above; text starts always do.
    start[flat.at[:-1][np.diff(flat.at) > 0]] = True
    return np.flatnonzero(start), strange


# -- the automaton ---------------------------------------------------------------


class Transducer:
    """Arrays of a minimal acyclic automaton whose words map to their ranks, and the ids by rank."""

    FIELDS = ("only_byte", "only_to", "only_add", "row", "to", "add", "final", "id_at", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.arrays = arrays
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Transducer:
        """From words and their ids. Words are added in order; a finished suffix is replaced by an equal known one."""
        ordered = sorted(w for w in words if w)
        edges: list[dict[int, int]] = [{}]
        final = [False]
        known: dict[tuple, int] = {}
        path = [0]
        previous = b""

        def settle(depth: int) -> None:
            while len(path) - 1 > depth:
                state = path.pop()
                shape = (final[state], tuple(edges[state].items()))
                same = known.setdefault(shape, state)
                if same != state:
                    edges[path[-1]][previous[len(path) - 1]] = same

        for word in ordered:
            shared = 0
            while shared < len(previous) and shared < len(word) and previous[shared] == word[shared]:
                shared += 1
            settle(shared)
            for octet in word[shared:]:
                edges.append({})
                final.append(False)
                edges[path[-1]][octet] = len(edges) - 1
                path.append(len(edges) - 1)
            final[path[-1]] = True
            previous = word
        settle(0)

        # Number the states that are left, and count the words below each.
        number, order, stack = {0: 0}, [0], [0]
        while stack:
            for to in edges[stack.pop()].values():
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
                    stack.append(to)
        below: dict[int, int] = {}
        for root in order:
            todo = [root]
            while todo:
                state = todo[-1]
                open_ = [t for t in edges[state].values() if t not in below]
                if open_:
                    todo.extend(open_)
                else:
                    below[state] = int(final[state]) + sum(below[t] for t in edges[state].values())
                    todo.pop()
        count = len(order)
        only_byte, only_to, only_add = np.full(count, -1, np.int16), np.full(count, -1, np.int32), np.zeros(count, np.int32)
        row = np.full(count, -1, np.int32)
        wide = [s for s in order if len(edges[s]) > 1]
        to, add = np.full((max(len(wide), 1), 256), -1, np.int32), np.zeros((max(len(wide), 1), 256), np.int32)
        for i, state in enumerate(wide):
            row[number[state]] = i
            rank = int(final[state])
            for octet, target in sorted(edges[state].items()):
                to[i, octet], add[i, octet] = number[target], rank
                rank += below[target]
        for state in order:
            if len(edges[state]) == 1:
                ((octet, target),) = edges[state].items()
                at = number[state]
                only_byte[at], only_to[at], only_add[at] = octet, number[target], int(final[state])
        ids = [words[w] for w in ordered]
        id_at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        flat_ids = np.array([i for x in ids for i in x], np.int32)
        return cls({"only_byte": only_byte, "only_to": only_to, "only_add": only_add, "row": row, "to": to.reshape(-1), "add": add.reshape(-1), "final": np.array([final[s] for s in order], bool), "id_at": id_at, "ids": flat_ids})

    def to_bytes(self) -> bytes:
        """A header that says where each array lies, and the arrays."""
        head, body, at = {}, [], 0
        for name in self.FIELDS:
            raw = np.ascontiguousarray(self.arrays[name]).tobytes()
            raw += b"\0" * (-len(raw) % 64)
            head[name] = (self.arrays[name].dtype.str, len(self.arrays[name]), at)
            body.append(raw)
            at += len(raw)
        header = json.dumps(head).encode()
        header += b" " * (-(len(header) + 8) % 64)
        return struct.pack("<q", len(header)) + header + b"".join(body)

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        """The automaton of a file, mapped into memory: workers of one machine share its pages."""
        raw = np.memmap(path, np.uint8, "r")
        size = struct.unpack("<q", raw[:8].tobytes())[0]
        head = json.loads(raw[8 : 8 + size].tobytes())
        base = 8 + size
        return cls({name: np.frombuffer(raw, np.dtype(kind), length, base + at) for name, (kind, length, at) in head.items()})

    def ranks(self, octets: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Rank of every word octets[start:stop], -1 for those that the automaton doesn't hold."""
        out = np.full(len(start), -1, np.int64)
        live = np.flatnonzero(stop - start <= WORD_BYTES)
        state, rank = np.zeros(len(live), np.int32), np.zeros(len(live), np.int32)
        at, end = start[live], stop[live]
        while len(live):
            octet = octets[at]
            row = self.row[state]
            wide = row >= 0
            cell = np.where(wide, row * 256 + octet, 0)
            alone = self.only_byte[state] == octet
            rank = rank + np.where(wide, self.add[cell], self.only_add[state])
            state = np.where(wide, self.to[cell], np.where(alone, self.only_to[state], -1))
            at = at + 1
            over = at == end
            hit = over & (state >= 0)
            hit[hit] = self.final[state[hit]]
            out[live[hit]] = rank[hit]
            go = ~over & (state >= 0)
            live, state, rank, at, end = live[go], state[go], rank[go], at[go], end[go]
        return out


# -- the tokenizer -----------------------------------------------------------------


@lru_cache(4)
def tokenizer(name: str, folder: str):
    """The tokenizer of a .tiktoken vocabulary file."""
    import tiktoken

    ranks = {}
    with open(Path(folder) / f"{name}.tiktoken", "rb") as file:
        for line in file:
            word, number = line.split()
            ranks[base64.b64decode(word)] = int(number)
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids, or their number, of all texts of a batch."""

    def __init__(self, lexicon: Transducer, name: str, folder: str) -> None:
        self.lexicon, self.merge = lexicon, tokenizer(name, folder)
        self.cache: dict[bytes, bytes] = {}

    def _unseen(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that the lexicon doesn't hold, as bytes of int32."""
        cache, merge = self.cache, self.merge._core_bpe.encode_single_piece
        out = []
        for word in words:
            ids = cache.get(word)
            if ids is None:
                if len(cache) >= CACHE:
                    cache.clear()
                ids = cache[word] = array("i", merge(word)).tobytes()
            out.append(ids)
        return out

    def _words(self, flat: FlatText):
        begins, strange = word_starts(flat)
        places = flat.byte_starts()
        start = places[begins]
        stop = np.append(start[1:], len(flat.raw))
        return start, stop, strange, np.searchsorted(begins, flat.at)

    def sizes(self, flat: FlatText) -> np.ndarray:
        """Number of ids of every text."""
        start, stop, strange, word_at = self._words(flat)
        counts, _ = self._counts(flat, start, stop)
        total = np.concatenate([[0], np.cumsum(counts)])
        out = total[word_at[1:]] - total[word_at[:-1]]
        for i in strange:
            out[i] = len(self._whole(flat, i))
        return out

    def _counts(self, flat: FlatText, start: np.ndarray, stop: np.ndarray):
        rank = self.lexicon.ranks(np.frombuffer(flat.raw, np.uint8), start, stop)
        counts = np.where(rank >= 0, self.lexicon.id_at[rank + 1] - self.lexicon.id_at[np.maximum(rank, 0)], 0)
        rest = np.flatnonzero(rank < 0)
        raw = flat.raw
        merged = self._unseen([raw[a:b] for a, b in zip(start[rest].tolist(), stop[rest].tolist())])
        counts[rest] = np.fromiter(map(len, merged), np.int64, len(merged)) >> 2
        return counts, (rank, rest, merged)

    def _whole(self, flat: FlatText, i: int) -> list[int]:
        return self.merge.encode_ordinary(flat.raw[flat.byte_at[i] : flat.byte_at[i + 1]].decode())

    def ids(self, flat: FlatText) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets by text)."""
        start, stop, strange, word_at = self._words(flat)
        counts, (rank, rest, merged) = self._counts(flat, start, stop)
        total = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(total[-1], np.int32)
        held = np.flatnonzero(rank >= 0)
        size = counts[held]
        shift = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(held) else np.zeros(0, np.int64)
        step = np.arange(int(size.sum())) - np.repeat(shift, size)
        out[np.repeat(total[held], size) + step] = self.lexicon.ids[np.repeat(self.lexicon.id_at[rank[held]], size) + step]
        if len(rest):
            size = counts[rest]
            shift = np.concatenate([[0], np.cumsum(size)[:-1]])
            step = np.arange(int(size.sum())) - np.repeat(shift, size)
            out[np.repeat(total[rest], size) + step] = np.frombuffer(b"".join(merged), np.int32)
        at = total[word_at]
        if len(strange):
            parts = [out[at[i] : at[i + 1]] for i in range(len(at) - 1)]
            for i in strange:
                parts[i] = np.array(self._whole(flat, i), np.int32)
            out, at = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return out, at


# -- on tables -----------------------------------------------------------------------


def count_words(df: DataFrame, text: str) -> DataFrame:
    """(word, n) of all words of at most WORD_BYTES bytes, over the whole column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(5)
        factors = rng.integers(1, 2**63, 1 << 16, dtype=np.uint64) | np.uint64(1)
        for whole in batches:
            for batch in chunks(whole, 0):
                flat = FlatText(batch.column(0))
                begins, _ = word_starts(flat)
                places = flat.byte_starts()
                start = places[begins]
                stop = np.append(start[1:], len(flat.raw))
                short = stop - start <= WORD_BYTES
                start, stop = start[short], stop[short]
                if not len(start):
                    continue
                octets = np.frombuffer(flat.raw, np.uint8)
                # A hash of each word: its bytes times factors by place in the word, summed.
                place = np.arange(len(octets)) - np.repeat(np.append(0, places[begins]), np.diff(np.concatenate([[0], places[begins], [len(octets)]])))
                terms = (octets.astype(np.uint64) + np.uint64(1)) * factors[np.minimum(place, WORD_BYTES)]
                terms ^= terms >> np.uint64(31)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms * np.uint64(0x9E3779B97F4A7C15))])
                _, one, times = np.unique(sums[stop] - sums[start], return_index=True, return_counts=True)
                words = [flat.raw[a:b] for a, b in zip(start[one].tolist(), stop[one].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])

    partial = df.select(F.col(text).alias("text")).filter("text IS NOT NULL AND text <> ''").mapInArrow(count, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(df: DataFrame, text: str, name: str, folder: str, words: int = WORDS) -> str:
    """Compile the most frequent words of the column; returns the name under which executors find the file.

    The words come from counts over all rows. A histogram of the counts, by 64ths of a
    power of two, gives the least count that at most ``words`` words reach; of the words just below
    as many are added as there is room for, by a hash. Those words, of at most WORD_BYTES bytes, are all
    that reaches the driver, from however many tasks.
    """
    spark = df.sparkSession
    grade = F.floor(F.log2("n") * 64).cast("int").alias("grade")
    counted = cut(count_words(df, text).filter("n >= 2").select("word", "n", grade), "words")
    # At most 64 rows for each power of two.
    sizes = {r["grade"]: r["m"] for r in counted.groupBy("grade").agg(F.count(F.lit(1)).alias("m")).collect()}
    least, room = None, words
    for at in sorted(sizes, reverse=True):
        if sizes[at] > room:
            break
        least, room = at, room - sizes[at]
    wanted = F.col("grade") >= least if least is not None else F.lit(False)
    below = max((at for at in sizes if least is None or at < least), default=None)
    if below is not None and room > 0:
        # A share of the next grade's slices by hash, of which none holds many words.
        slices = max(1, -(-sizes[below] // 64))
        part = F.pmod(F.xxhash64("word"), F.lit(slices))
        held = counted.filter(F.col("grade") == below).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("m")).orderBy("part").limit(words).collect()
        last = -1
        for row in held:
            if row["m"] > room:
                break
            last, room = row["part"], room - row["m"]
        wanted = wanted | ((F.col("grade") == below) & (part <= last))
    top = counted.filter(wanted).select("word").collect()
    merge = tokenizer(name, folder)
    lexicon = Transducer.build({(w := bytes(r["word"])): merge._encode_single_piece(w) for r in top})
    return publish(spark, lexicon, (Path(folder) / f"{name}.tiktoken").read_bytes())


def publish(spark: SparkSession, lexicon: Transducer, vocabulary: bytes) -> str:
    """Write automaton and vocabulary to the shared folder and have the executors fetch both; the name of the two."""
    name = f"lexicon-{uuid.uuid4().hex[:12]}"
    for file, content in ((f"{name}.bin", lexicon.to_bytes()), (f"{name}.tiktoken", vocabulary)):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{file}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return name


_OPEN: dict[str, Encoder] = {}


def open_encoder(published: str) -> Encoder:
    """The worker's encoder over the mapped file and the vocabulary that came with it."""
    if published not in _OPEN:
        _OPEN.clear()
        _OPEN[published] = Encoder(Transducer.mapped(SparkFiles.get(f"{published}.bin")), published, SparkFiles.getRootDirectory())
    return _OPEN[published]


def encode(df: DataFrame, *, key: str, text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, lexicon: str | None = None) -> DataFrame:
    """(key, ids) of every row; special tokens are never made, and an empty or null text gives an empty list.

    lexicon: the name that :func:`build_lexicon` returned; by default one is built from
    this column. Repeated rows give a row each. Other columns are not read.
    """
    published = lexicon or build_lexicon(df, text, name, folder)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = open_encoder(published)
        for whole in batches:
            for batch in chunks(whole, 1):
                ids, at = encoder.ids(FlatText(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))], ["key", "ids"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, ids array<int>").withColumnRenamed("key", key)


def token_sizes(df: DataFrame, *, key: str, text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, lexicon: str | None = None) -> DataFrame:
    """(key, tokens): the number of ids of every row, as :func:`encode` would give them."""
    published = lexicon or build_lexicon(df, text, name, folder)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = open_encoder(published)
        for whole in batches:
            for batch in chunks(whole, 1):
                sizes = encoder.sizes(FlatText(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["key", "tokens"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, tokens bigint").withColumnRenamed("key", key)
