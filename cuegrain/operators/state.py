"""Stage states, invalidation, cached results, and use of a daily quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed

ZONE = "America/Los_Angeles"


def downstream(needs: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """All stages that need a stage, directly or not; the graph is a parameter of a few names."""
    needs = fixed.STAGE_NEEDS if needs is None else needs
    out = {}
    for stage in needs:
        hit = {stage}
        while grown := {s for s, up in needs.items() if hit & set(up)} - hit:
            hit |= grown
        out[stage] = sorted(hit - {stage})
    return out


def current_states(log: DataFrame, stages: list[str] | None = None) -> DataFrame:
    """Latest version of every (video_id, stage); rows of stages that no longer exist are left out."""
    keep = ["status", "params_hash", "finished_at", "error", "note"]
    seen = log.filter(F.col("stage").isin(stages or list(fixed.STAGE_NEEDS)))
    return seen.groupBy("video_id", "stage").agg(F.max(F.struct("saved_at", *keep)).alias("b")).select("video_id", "stage", "b.saved_at", *[f"b.{k}" for k in keep])


def satisfied(status: Column, have: Column, want: Column) -> Column:
    """Done with the parameters that are wanted; an unknown hash never is."""
    return F.coalesce((status == "done") & (have == want), F.lit(False))


def stale_stages(states: DataFrame, wanted: DataFrame) -> DataFrame:
    """(video_id, stage): stages to run again, as their own parameters or those of a stage that they need have changed. wanted (stage, want)."""
    spark = states.sparkSession
    table = spark.createDataFrame([(s, [s, *d]) for s, d in downstream().items()], "stage string, affected array<string>")
    changed = states.join(wanted, "stage").filter(F.col("params_hash").isNotNull() & ~F.col("params_hash").eqNullSafe(F.col("want")))
    hit = changed.select("video_id", "stage").join(F.broadcast(table), "stage").select("video_id", F.explode("affected").alias("stage")).distinct()
    return states.select("video_id", "stage").join(hit, ["video_id", "stage"], "left_semi")


RECORD = ["status", "params_hash", "finished_at", "error", "note"]


def _reset(rows: DataFrame) -> DataFrame:
    """Records as new: nothing is known of the stage."""
    return rows.select("video_id", "stage", F.lit("pending").alias("status"), *[F.lit(None).cast("string").alias(c) for c in RECORD[1:]])


def _closure(df: DataFrame) -> DataFrame:
    table = df.sparkSession.createDataFrame([(s, x) for s, d in downstream().items() for x in d], "stage string, affected string")
    return df.select("video_id", "stage").join(F.broadcast(table), "stage").select("video_id", F.col("affected").alias("stage")).distinct()


def marked(states: DataFrame, events: DataFrame) -> DataFrame:
    """Records (video_id, stage, status, params_hash, finished_at, error, note) that events write over ``states``, to be appended to the log.

    events (video_id, stage, event, params_hash, finished_at, error, note), one a stage:
    done keeps hash, time and note and clears the error; failed keeps error and time, and what the
    state had of hash and note; stale forgets the stage and all recorded stages that need it.
    """
    e = events.select("video_id", "stage", "event", *[F.col(c).alias(f"_{c}") for c in RECORD[1:]])
    old = states.select("video_id", "stage", *RECORD[1:])
    x = e.filter("event IN ('done', 'failed')").join(old, ["video_id", "stage"], "left")
    done = F.col("event") == "done"
    # A failure leaves hash and note as they were.
    written = x.select("video_id", "stage", F.col("event").alias("status"), F.when(done, F.col("_params_hash")).otherwise(F.col("params_hash")).alias("params_hash"), F.col("_finished_at").alias("finished_at"), F.when(~done, F.col("_error")).alias("error"), F.when(done, F.col("_note")).otherwise(F.col("note")).alias("note"))
    stale = e.filter("event = 'stale'").select("video_id", "stage")
    below = _closure(stale).join(states.select("video_id", "stage"), ["video_id", "stage"], "left_semi")
    return written.unionByName(_reset(stale.unionByName(below).distinct().join(written, ["video_id", "stage"], "left_anti")))


def synced(states: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records that a change of parameters writes, with ``invalidated``: stages below a changed one are forgotten, a changed one itself loses its hash.

    wanted (stage, want). A stage without a hash isn't compared; one below a changed stage is forgotten, changed or not.
    """
    changed = states.join(wanted, "stage").filter(F.col("params_hash").isNotNull() & ~F.col("params_hash").eqNullSafe(F.col("want")))
    below = _closure(changed).join(states.select("video_id", "stage"), ["video_id", "stage"], "left_semi")
    own = changed.join(below, ["video_id", "stage"], "left_anti").select("video_id", "stage", "status", F.lit(None).cast("string").alias("params_hash"), "finished_at", "error", "note")
    return _reset(below).withColumn("invalidated", F.lit(True)).unionByName(own.withColumn("invalidated", F.lit(False)))


def saved(log: DataFrame, records: DataFrame, at: Column) -> DataFrame:
    """The log with the records appended as versions saved at that time."""
    return log.unionByName(records.select(*[F.col(c) for c in ("video_id", "stage", *RECORD)]).withColumn("saved_at", at), allowMissingColumns=True)


def ready_for(states: DataFrame, wanted: DataFrame, stage: str, inputs: DataFrame) -> DataFrame:
    """Videos whose ``stage`` is satisfied and that have rows in ``inputs``."""
    x = states.filter(F.col("stage") == stage).join(wanted, "stage")
    return x.filter(satisfied(F.col("status"), F.col("params_hash"), F.col("want"))).select("video_id").join(inputs.select("video_id"), "video_id", "left_semi")


def cache_split(items: DataFrame, cache: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of items by equal keys; a null key hits nothing. Of repeated cache rows one counts."""
    held = cache.dropDuplicates(keys)
    return items.join(held, keys), items.join(held.select(*keys), keys, "left_anti")


def batches(df: DataFrame, *, entity: str, order: str, size: int) -> DataFrame:
    """Rows with ``batch``: consecutive groups of ``size`` (at least 1) within an entity."""
    return df.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(entity).orderBy(order)) - 1) / max(1, size)))


# -- quota ---------------------------------------------------------------------------


def quota_day(instant: Column, zone: str = ZONE) -> Column:
    """The day of an instant (UTC session) where the quota is counted."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def next_reset(instant: Column, zone: str = ZONE) -> Column:
    """The next midnight there."""
    return F.to_utc_timestamp(F.date_add(quota_day(instant, zone), 1).cast("timestamp"), zone)


def usage_by_day(ledger: DataFrame, *, time: str, model: str) -> DataFrame:
    return ledger.groupBy(quota_day(F.col(time)).alias("quota_day"), F.col(model).alias("model")).agg(F.count(F.lit(1)).alias("requests"))


def observed_limits(seen: DataFrame) -> DataFrame:
    """(model, limit): the limit observed last."""
    return seen.groupBy("model").agg(F.max_by("limit", F.struct("observed_at", "limit")).alias("limit"))


def remaining(usage: DataFrame, limits: DataFrame, configured: int = 20, safety: float = 0.9) -> DataFrame:
    """usage with the limit (observed, else configured), its safe part and what is left of that."""
    x = usage.join(limits, "model", "left").withColumn("limit", F.coalesce("limit", F.lit(configured)))
    x = x.withColumn("safe_limit", F.floor(F.col("limit") * safety).cast("int"))
    return x.withColumn("remaining", F.greatest(F.lit(0), F.col("safe_limit") - F.col("requests")))


def within_budget(ledger: DataFrame, *, time: str, order: str, budget: int) -> DataFrame:
    """Rows with ``allowed``: the first ``budget`` requests of each quota day by (time, order).

    A day's requests are numbered by hour first, so that no task sorts a whole day.
    """
    x = ledger.withColumn("_day", quota_day(F.col(time))).withColumn("_part", F.date_trunc("hour", F.col(time)))
    counts = x.groupBy("_day", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy("_day").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    x = x.withColumn("_i", F.row_number().over(W.partitionBy("_day", "_part").orderBy(time, order))).join(before, ["_day", "_part"])
    return x.withColumn("allowed", F.col("_before") + F.col("_i") <= budget).drop("_day", "_part", "_i", "_before")


def stage_graph(spark: SparkSession) -> DataFrame:
    """(stage, affected) of the whole closure."""
    return spark.createDataFrame([(s, x) for s, d in downstream().items() for x in d], "stage string, affected string")


class QuotaLedger:
    """Requests as an append-only table below ``root``, and the limit that was last observed of each model, replaced by model."""

    USE = "model string, at timestamp, tokens_in bigint, tokens_out bigint, segment_id string, outcome string"
    LIMIT = "model string, limit int, observed_at timestamp"

    def __init__(self, spark: SparkSession, root: str) -> None:
        from ..sources.keyed import KeyedTable

        self.spark, self.root = spark, root.rstrip("/")
        self.limits = KeyedTable(spark, f"{self.root}/limits", "model", self.LIMIT, buckets=1)

    def record(self, rows: DataFrame) -> None:
        """Append requests."""
        rows.select(*[c.split()[0] for c in self.USE.split(", ")]).write.mode("append").parquet(f"{self.root}/requests")

    def observe(self, rows: DataFrame) -> None:
        """Put limits in the place of those known before, unless they were observed earlier."""
        names = ["model", "limit", "observed_at"]
        held = self.limits.read().select(*names).unionByName(rows.select(*names))
        best = held.groupBy("model").agg(F.max(F.struct("observed_at", "limit")).alias("b")).select("model", "b.limit", "b.observed_at")
        self.limits.replace(best)

    def left(self, configured: int = 20, safety: float = 0.9) -> DataFrame:
        """(quota_day, model, requests, limit, safe_limit, remaining)."""
        requests = self.spark.read.schema(self.USE).parquet(f"{self.root}/requests")
        return remaining(usage_by_day(requests, time="at", model="model"), self.limits.read().select("model", "limit"), configured, safety)
