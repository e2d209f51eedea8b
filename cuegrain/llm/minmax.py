"""Near-duplicate texts by min-max hashing.

Under every permutation both the least and the greatest hash of a text's shingles are
kept, so that a signature of 2P values costs P hash evaluations. Bands of the
signature propose pairs; the shingle sets themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import FlatText, chunks

#: Values of a signature in a band, and bands: at a similarity of 0.6 a pair is missed in one case of 65,000, at 0.7 in none of 10^9.
ROWS, BANDS = 4, 80


def shingle_sets(flat: FlatText, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles as integers, offsets by text); n is at most 3 (21 bits a character)."""
    texts = len(flat.at) - 1
    cps = flat.cps.astype(np.int64)
    if len(cps) < n:
        return np.zeros(0, np.int64), np.zeros(texts + 1, np.int64)
    grams = np.zeros(len(cps) - n + 1, np.int64)
    for i in range(n):
        grams = (grams << 21) | cps[i : i + len(grams)]
    owner = flat.owner()
    inside = owner[: len(grams)] == owner[n - 1 :]
    grams, owner = grams[inside], owner[: len(inside)][inside]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(texts + 1))


def signatures(grams: np.ndarray, at: np.ndarray, permutations: int, seed: int = 1) -> np.ndarray:
    """Rows of 2 * permutations values: least and greatest hash under each; every text has a shingle."""
    rng = np.random.default_rng(seed)
    base = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    base ^= base >> np.uint64(32)
    out = np.empty((len(at) - 1, 2 * permutations), np.uint64)
    for p in range(permutations):
        a, b = (int(x) | 1 for x in rng.integers(1, 2**63, 2))
        h = (base ^ np.uint64(b)) * np.uint64(a)
        h ^= h >> np.uint64(29)
        out[:, 2 * p] = np.minimum.reduceat(h, at[:-1])
        out[:, 2 * p + 1] = np.maximum.reduceat(h, at[:-1])
    return out


def jaccard(left: FlatText, right: FlatText, n: int) -> np.ndarray:
    """Similarity of the shingle sets of every pair of texts."""
    (a, a_at), (b, b_at) = shingle_sets(left, n), shingle_sets(right, n)
    pairs = len(a_at) - 1
    gram, pair = np.concatenate([a, b]), np.concatenate([np.repeat(np.arange(pairs), np.diff(x)) for x in (a_at, b_at)])
    order = np.lexsort((gram, pair))
    gram, pair = gram[order], pair[order]
    shared = np.bincount(pair[1:][(gram[1:] == gram[:-1]) & (pair[1:] == pair[:-1])], minlength=pairs)
    return shared / np.maximum(np.diff(a_at) + np.diff(b_at) - shared, 1)


def _fold(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.reshape(len(signature), -1, rows)
    out = np.zeros(bands.shape[:2], np.uint64)
    for i in range(rows):
        out = (out ^ bands[:, :, i]) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def near_duplicates(df: DataFrame, *, key: str, text: str, n: int = 3, threshold: float = 0.6, least_chars: int = 40, rows: int = ROWS, bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """Links between different texts, and the members of each text.

    Returns (links, members). members (key, rep): every row whose text has at least
    ``least_chars`` characters, without U+0020 and line feeds, and the least key of
    those with the very same text. links (a, b, similarity): two representatives, a < b,
    whose sets of ``n``-character substrings have at least ``threshold`` of their union
    in common.

    Copies are joined before anything is compared, so that a text that fills much of
    the table is one row from there on. Proposed pairs come from an equi-join on the band's
    hash, which adaptive execution splits where a hash is frequent; of them go on those whose
    numbers of shingles allow the similarity at all, and each is then compared exactly, on
    texts, which are a third of their shingles in size. There is no cap on partners. Null and short texts,
    and null keys, are no members; repeated rows count once.
    """
    if bands * rows % 2:
        raise ValueError("an even number of signature values is needed")
    base = df.select(F.col(key).alias("key"), F.translate(F.col(text), " \n", "").alias("text")).filter((F.length("text") >= least_chars) & F.col("key").isNotNull())
    base = base.distinct()
    reps = base.groupBy("text").agg(F.min("key").alias("rep"))
    members = base.join(reps, "text").select("key", "rep")
    kind = dict(base.dtypes)["key"]
    permutations = bands * rows // 2
    mixed = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, 1, 1 << 19):
                grams, at = shingle_sets(FlatText(batch.column(1)), n)
                folded = _fold(signatures(grams, at, permutations), rows).view(np.uint64) ^ mixed
                offsets = pa.array(np.arange(0, folded.size + 1, bands), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(folded.view(np.int64).reshape(-1)))], ["rep", "size", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for half in chunks(whole, 2, 1 << 20):
                for batch in chunks(half, 3, 1 << 20):
                    similarity = jaccard(FlatText(batch.column(2)), FlatText(batch.column(3)), n)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similarity)], ["a", "b", "similarity"]).filter(pa.array(similarity >= threshold))

    texts = reps.select("rep", "text")
    banded = texts.mapInArrow(sign, f"rep {kind}, size int, hashes array<bigint>").select("rep", "size", F.explode("hashes").alias("hash"))
    left = banded.select(F.col("rep").alias("a"), F.col("size").alias("size_a"), "hash")
    right = banded.select(F.col("rep").alias("b"), F.col("size").alias("size_b"), "hash")
    possible = F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b")
    # Spark sizes the exploded hashes as their texts, some twenty times too low, and would send them through the driver.
    pairs = left.hint("merge").join(right.hint("merge"), "hash").filter((F.col("a") < F.col("b")) & possible).select("a", "b").distinct()
    ta, tb = (texts.select(F.col("rep").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    both = pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(compare, f"a {kind}, b {kind}, similarity double"), members


def expand_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) of all linked rows, copies included, a < b: as many as there are cases."""
    ma = members.select(F.col("key").alias("ka"), F.col("rep").alias("a"))
    mb = members.select(F.col("key").alias("kb"), F.col("rep").alias("b"))
    across = links.select("a", "b").join(ma, "a").join(mb, "b").select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))
    copies = ma.join(mb.withColumnRenamed("b", "a"), "a").filter("ka < kb").select(F.col("ka").alias("a"), F.col("kb").alias("b"))
    return across.unionByName(copies)
