"""Query of problem 1: what each successful run takes from the log of stage states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.incremental import IncrementalRuns, bisected, latest_versions
from ..registry import Registry, load
from ..session import cut, scratch

REGISTRY = Registry()

# The stages that a consumer follows.
STAGES = ["S0", "S1a", "S1b", "S1c", "S3", "S4a", "S4", "S5", "S6"]


_SEEN = ["saved_at", "status", "params_hash", "finished"]


def _states(log: DataFrame) -> DataFrame:
    return log.filter(F.col("stage").isin(STAGES)).select("video_id", "stage", "loaded_at", "saved_at", "status", "params_hash", F.try_to_timestamp("finished_at").alias("finished"))


def stage_snapshot(log: DataFrame, seen_until) -> DataFrame:
    """Current version of every (video_id, stage) among the rows that arrived until then."""
    seen = _states(log).filter(F.col("loaded_at") <= F.lit(seen_until))
    best = latest_versions(seen, ["video_id", "stage"], ["saved_at"], ["status", "params_hash", "finished"])
    return best.withColumn("ready", F.col("status").eqNullSafe("done")).drop("status")


def stage_history(log: DataFrame, moments: list) -> DataFrame:
    """The snapshots of all moments (ascending) at once: a version is current from moment number ``since`` up to ``until``, exclusive.

    The log is read once. Of a stage's rows that arrive between two moments only the
    greatest is kept, combined before the shuffle, so that a stage has at most as many rows as there are moments.
    """
    since = bisected([m.isoformat() for m in moments], log.schema["loaded_at"].dataType.simpleString(), F.col("loaded_at"), strictly=True)
    seen = _states(log).withColumn("since", since).filter(F.col("since") < len(moments))
    best = seen.groupBy("video_id", "stage", "since").agg(F.max(F.struct(*_SEEN)).alias("best"))
    over = Window.partitionBy("video_id", "stage").orderBy("since")
    best = best.select("video_id", "stage", "since", F.lead("since", 1, len(moments)).over(over).alias("until"), F.max("best").over(over).alias("best"))
    return best.select("video_id", "stage", "since", "until", "best.params_hash", "best.finished", F.col("best.status").eqNullSafe("done").alias("ready"))


_P1_SQL = """
WITH log AS (
  SELECT video_id, stage, status, params_hash, TRY_CAST(finished_at AS TIMESTAMPTZ) AS finished, saved_at, loaded_at
  FROM stage_records WHERE stage IN ('S0','S1a','S1b','S1c','S3','S4a','S4','S5','S6')),
seen AS (
  SELECT r.run_id, r.started_at, l.video_id, l.stage, l.status, l.params_hash, l.finished,
         row_number() OVER (PARTITION BY r.run_id, l.video_id, l.stage
                            ORDER BY l.saved_at DESC, l.status DESC, l.params_hash DESC NULLS LAST, l.finished DESC NULLS LAST) AS n
  FROM pipeline_runs r JOIN log l ON l.loaded_at <= r.started_at WHERE r.status = 'succeeded'),
done AS (SELECT * FROM seen WHERE n = 1 AND status = 'done'),
prior AS (
  SELECT *, lag(run_id) OVER w AS before, lag(params_hash) OVER w AS p, lag(finished) OVER w AS f FROM done
  WINDOW w AS (PARTITION BY video_id, stage ORDER BY started_at, run_id))
SELECT run_id, video_id, stage FROM prior
WHERE before IS NULL OR params_hash IS DISTINCT FROM p OR finished IS DISTINCT FROM f
"""


@REGISTRY.add("p1_found", _P1_SQL)
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run in its order through the operator; those that didn't succeed do their work and fail before they publish.

    The driver starts the runs one by one, so their table (one row a run) is its own.
    """
    log = load(spark, sf_dir, "stage_records")
    rows = load(spark, sf_dir, "pipeline_runs").select("run_id", "started_at", "status").orderBy("started_at", "run_id").collect()
    history = cut(stage_history(log, [row["started_at"] for row in rows]), "history")
    state = IncrementalRuns(spark, scratch(spark, "p1"), ["video_id", "stage"], ["params_hash", "finished"], ready="ready")
    for number, row in enumerate(rows):
        snapshot = history.filter((F.col("since") <= number) & (F.col("until") > number))
        state.run(snapshot, str(row["run_id"]), fail_before_publish=row["status"] != "succeeded")
    if not state.commits():
        return spark.createDataFrame([], "run_id int, video_id string, stage string")
    return state.output().select(F.col("run").cast("int").alias("run_id"), "video_id", "stage")
