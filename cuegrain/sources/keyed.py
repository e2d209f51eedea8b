"""Tables whose rows are replaced by key, and text files whose lines are kept by key."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedTable:
    """Rows below ``root``, replaced by the value of one key column.

    Keys are hashed to buckets. A write rewrites the buckets that its keys touch to a new
    place and then creates the next manifest, which says where each bucket lies; readers
    see all of a write or nothing. Unreferenced files of failed writes do no harm.

    Where buckets have come to hold more than ``per_bucket`` rows on average, the next write
    doubles their number as often as it takes and lays out the whole table anew, so that a
    write's share of the table shrinks as the table grows. A crowded bucket is written by several tasks.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, schema: str, buckets: int = 64, per_bucket: int = 5_000_000) -> None:
        self.spark, self.root, self.key, self.buckets, self.per_bucket = spark, root.rstrip("/"), key, buckets, per_bucket
        self.schema = spark.createDataFrame([], schema).schema

    def _fs(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def manifest(self) -> tuple[int, int, dict[str, str]]:
        """(number, buckets, place by bucket) of the last write."""
        fs, at = self._fs(f"{self.root}/manifests")
        numbers = [int(x.getPath().getName()) for x in fs.listStatus(at) if x.getPath().getName().isdigit()] if fs.exists(at) else []
        if not numbers:
            return 0, self.buckets, {}
        fs, path = self._fs(f"{self.root}/manifests/{max(numbers):08d}")
        stream = fs.open(path)
        try:
            held = json.loads(bytes(stream.readAllBytes()).decode())
            return max(numbers), held["buckets"], held["places"]
        finally:
            stream.close()

    def read(self) -> DataFrame:
        return self._read(self.manifest()[2])

    def _read(self, places: dict[str, str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/{place}/_bucket={bucket}" for bucket, place in places.items()]
        fs = self._fs(self.root)[0]
        paths = [p for p in paths if fs.exists(self._fs(p)[1])]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, keys: DataFrame | None = None) -> None:
        """Put ``rows`` in the place of all rows of their keys, and of ``keys``, which may so be emptied."""
        number, buckets, places = self.manifest()
        total = self._read(places).count()  # from the files' footers
        grown = buckets
        while total > grown * self.per_bucket:
            grown *= 2
        bucket = F.pmod(F.xxhash64(self.key), F.lit(grown)).cast("int")
        own = rows.select(self.key)
        affected = (own if keys is None else own.unionByName(keys.select(self.key))).distinct()
        if grown == buckets:
            touched = [r[0] for r in affected.select(bucket).distinct().collect()]  # at most ``buckets``
            old = self._read({b: p for b, p in places.items() if int(b) in touched})
        else:
            touched, old, places = list(range(grown)), self._read(places), {}
        a = affected.withColumnRenamed(self.key, "_key")
        kept = old.join(a, F.col(self.key).eqNullSafe(F.col("_key")), "left_anti")
        place = f"{number + 1:08d}-{uuid.uuid4().hex[:8]}"
        laid = kept.unionByName(rows.select(*self.schema.names)).withColumn("_bucket", bucket)
        laid.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.root}/data/{place}")
        fs, draft = self._fs(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps({"buckets": grown, "places": places | {str(b): place for b in touched}}).encode()))
        finally:
            stream.close()
        final = self._fs(f"{self.root}/manifests/{number + 1:08d}")[1]
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"write {number + 1} was made by another")

    def drop(self, keys: DataFrame) -> None:
        """Delete all rows of the keys."""
        self.replace(self.spark.createDataFrame([], self.schema), keys)


def lines_without(lines: DataFrame, keys: DataFrame, *, key: str) -> DataFrame:
    """(value): JSON lines whose key, at the top or below metadata, isn't among ``keys``; lines that can't be parsed stay, blank ones go."""
    found = F.coalesce(F.get_json_object("value", f"$.{key}"), F.get_json_object("value", f"$.metadata.{key}"))
    gone = keys.select(F.col(key).cast("string").alias("_gone")).distinct()
    return lines.filter(F.trim("value") != "").withColumn("_k", found).join(gone, F.col("_k") == F.col("_gone"), "left_anti").select("value")
