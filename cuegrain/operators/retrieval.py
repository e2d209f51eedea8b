"""Vector search of a stated query set against all rows, in blocks, and ranking measures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a block, and queries that are multiplied at once.
QUERY_BLOCK, CORPUS_BLOCK, AT_ONCE = 65_536, 50_000, 512


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _blocks(df: DataFrame, ident: str, per: int, name: str) -> tuple[DataFrame, int]:
    n = max(1, -(-df.count() // per))
    return df.withColumn(name, F.pmod(F.xxhash64(ident), F.lit(n)).cast("int")), n


def nearest_vectors(queries: DataFrame, corpus: DataFrame, *, ident: str, vector: str, k: int, metric: str = "cosine", other_group: str | None = None) -> DataFrame:
    """(query, found, score, rank): the ``k`` best rows for every query, exactly; a query doesn't find itself.

    metric: ``cosine`` (greater is better) or ``l1``, the mean absolute difference (less
    is better). other_group: only rows whose group differs from the query's. Scores are
    rounded to 9 digits before ranks, ties go to the lesser id. Every (query block, corpus
    block) is one matrix product that keeps its own best k; block sizes are fixed, so tasks grow in
    number and not in size. Rows with null vectors are left out.
    """
    group = F.col(other_group) if other_group else F.lit(None).cast("int")
    pick = lambda df: df.filter(F.col(vector).isNotNull() & F.col(ident).isNotNull()).select(F.col(ident).alias("id"), F.col(vector).alias("v"), group.alias("g"))
    q, nq = _blocks(pick(queries), "id", QUERY_BLOCK, "qb")
    c, nc = _blocks(pick(corpus), "id", CORPUS_BLOCK, "cb")
    q = q.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))
    c = c.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    grouped = other_group is not None

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _matrix(left["v"]), _matrix(right["v"])
        qi, ci = (np.asarray(t["id"].to_pylist(), object) for t in (left, right))
        out_q, out_c, out_s = [], [], []
        if len(a) and len(b):
            order = np.argsort(ci, kind="stable")
            ids, b = ci[order], b[order]
            if metric == "cosine":
                a, b = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (a, b))
            if grouped:
                qg, cg = (np.asarray(t["g"].to_pylist(), object) for t in (left, right))
                cg = cg[order]
            for start in range(0, len(a), AT_ONCE):
                part = slice(start, start + AT_ONCE)
                if metric == "cosine":
                    scores = np.round(a[part] @ b.T, 9)
                else:
                    scores = np.stack([-np.round(np.abs(b - row).mean(1), 9) for row in a[part]])
                bar = qi[part][:, None] == ids[None, :]
                if grouped:
                    bar = bar | (qg[part][:, None] == cg[None, :])
                scores = np.where(bar, -np.inf, scores)
                for i, row in enumerate(scores):
                    # All rows as good as the k-th, in order of goodness, then of id.
                    near = np.flatnonzero(row >= np.partition(row, -k)[-k]) if len(row) > k else np.arange(len(row))
                    top = near[np.argsort(-row[near], kind="stable")][:k]
                    top = top[np.isfinite(row[top])]
                    out_q += [qi[start + i]] * len(top)
                    out_c += ids[top].tolist()
                    out_s += row[top].tolist()
        return pa.table({"query": pa.array(out_q, left.schema.field("id").type), "found": pa.array(out_c, right.schema.field("id").type), "score": pa.array(out_s, pa.float64())})

    kind = dict(q.dtypes)["id"]
    local = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(best, f"query {kind}, found {kind}, score double")
    ranked = local.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "found"))).filter(F.col("rank") <= k)
    return ranked.select("query", "found", (F.col("score") if metric == "cosine" else -F.col("score")).alias("score"), "rank")


def ranking_measures(ranked: DataFrame, gold: DataFrame, *, cuts: list[int]) -> DataFrame:
    """One row: queries, recall at each cut, and mean reciprocal rank of the first gold row, over all queries of ``gold``.

    ranked (query, found, rank); gold (query, found). A query without a gold row in its ranking counts as 0.
    """
    first = ranked.join(gold.select("query", "found").distinct(), ["query", "found"]).groupBy("query").agg(F.min("rank").alias("first"))
    x = gold.select("query").distinct().join(first, "query", "left")
    recall = [F.round(F.avg(F.coalesce((F.col("first") <= c).cast("double"), F.lit(0.0))), 3).alias(f"recall_{c}") for c in cuts]
    return x.agg(F.count(F.lit(1)).alias("queries"), *recall, F.round(F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))), 3).alias("mrr"))
