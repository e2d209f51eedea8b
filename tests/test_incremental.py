from datetime import datetime

import pytest
from cuegrain.operators import incremental
from cuegrain.operators.incremental import ConcurrentRunError, IncrementalRuns, bisected, changed_leaves, grow_tree, latest_versions, ordered_key, split_points
from cuegrain.plans.incremental import stage_history, stage_snapshot
from cuegrain.session import scratch
from pyspark.sql import functions as F

SCHEMA = "k string, v string, ready boolean"


def runs(spark, tmp_path, depth=2):
    return IncrementalRuns(spark, f"file://{tmp_path}/state", ["k"], ["v"], ready="ready", depth=depth)


def took(state, run):
    return sorted(((r["k"], r["v"]) for r in state.output().filter(f"run = '{run}'").collect()), key=str)


def test_descent_visits_only_differing_nodes():
    old = grow_tree({0: "a", 17: "b", 255: "c"}, 2)
    assert changed_leaves(grow_tree({0: "a", 17: "x", 255: "c"}, 2), old) == [17]
    assert changed_leaves(old, old) == []
    assert changed_leaves(grow_tree({0: "a"}, 2), old) == []
    assert changed_leaves(old, None) == [0, 17, 255]


def test_runs_take_each_change_once_and_failures_leave_nothing(spark, tmp_path):
    state = runs(spark, tmp_path)
    snap = lambda rows: spark.createDataFrame(rows, SCHEMA)
    state.run(snap([("a", "1", True), ("b", None, True), ("c", "1", False)]), "r1")
    assert took(state, "r1") == [("a", "1"), ("b", None)]
    changed = [("a", "2", True), ("b", None, True), ("c", "1", True), (None, "n", True)]
    assert state.run(snap(changed), "r2", fail_before_publish=True) is None
    assert len(state.commits()) == 1
    state.run(snap(changed), "r3")
    assert took(state, "r3") == sorted([("a", "2"), ("c", "1"), (None, "n")], key=str)
    state.run(snap(changed), "r4")
    assert took(state, "r4") == []
    state.run(snap([("a", "2", False), ("b", "9", True)]), "r5")  # c and null vanish, a is reset
    assert took(state, "r5") == [("b", "9")]
    state.run(snap([("a", "2", True), ("b", "9", True), ("c", "1", True)]), "r6")
    assert took(state, "r6") == []
    state.compact()
    state.run(snap([("a", "3", True), ("b", "9", True), ("c", "1", True)]), "r7")
    assert took(state, "r7") == [("a", "3")]


def test_empty_snapshot_and_concurrent_commit(spark, tmp_path):
    state = runs(spark, tmp_path, depth=1)
    state.run(spark.createDataFrame([], SCHEMA), "r1")
    assert state.output().count() == 0
    with pytest.raises(ConcurrentRunError):
        state._publish(state.commits()[0])
    with pytest.raises(ValueError):
        IncrementalRuns(spark, "x", ["leaf"], ["v"])


def test_latest_versions_and_repeats(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, None), (None, 1, "z")], "k string, t int, v string")
    assert sorted(latest_versions(df, ["k"], ["t"], ["v"]).collect(), key=str) == sorted([("a", "y"), ("b", None), (None, "z")], key=str)


def test_stage_snapshot_compares_instants(spark):
    t = datetime(2026, 3, 1)
    rows = [("v", "S0", "done", "h", "2026-03-01T00:00:00+00:00", t, t), ("v", "S0", "done", "h", "2026-02-28T17:00:00-07:00", t, t), ("v", "S2", "done", "h", None, t, t), ("w", "S0", "failed", None, None, t, t)]
    log = spark.createDataFrame(rows, "video_id string, stage string, status string, params_hash string, finished_at string, saved_at timestamp, loaded_at timestamp")
    out = sorted(stage_snapshot(log, t).collect())
    assert [(r["video_id"], r["ready"]) for r in out] == [("v", True), ("w", False)]
    assert out[0]["finished"] == t
    assert scratch(spark, "x") != scratch(spark, "x")


def numbered(spark, changed=(), n=20_000):
    rows = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id").isin(list(changed)), "new").otherwise("old").alias("v"), F.lit(True).alias("ready"))
    return rows.select(F.format_string("v%06d", "k").alias("k"), "v", "ready")


def test_near_keys_share_leaves(spark, tmp_path):
    state = runs(spark, tmp_path, depth=2)
    first = state.run(numbered(spark), "r1")
    assert len(first.leaves) == 256
    batch = range(7_000, 7_400)  # 2 % of the keys, near each other
    second = state.run(numbered(spark, batch), "r2")
    touched = [n for n in sorted(second.leaves) if second.leaves[n] != first.leaves[n]]
    assert len(touched) <= 10 and set(second.owner.values()) == {first.ver, second.ver}
    assert sorted(n for n, ver in second.owner.items() if ver == second.ver) == touched
    assert state.output().filter("run = 'r2'").count() == 400
    written = spark.read.parquet(f"{state.root}/records/ver={second.ver}")
    assert written.count() < 1_000  # the other records aren't written again


def test_another_depth_takes_nothing_twice(spark, tmp_path):
    runs(spark, tmp_path, depth=1).run(numbered(spark, n=500), "r1")
    deeper = runs(spark, tmp_path, depth=2)
    deeper.run(numbered(spark, [3], n=500), "r2")
    assert took(deeper, "r2") == [("v000003", "new")]
    assert len(deeper.commits()[-1].leaves) > 16
    shallow = runs(spark, tmp_path, depth=1)
    shallow.run(numbered(spark, [3, 4], n=500), "r3")
    assert took(shallow, "r3") == [("v000004", "new")]


def test_outgrown_ranges_are_split_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "OUTGROWN_ROWS", 32)
    state = runs(spark, tmp_path, depth=1)
    state.run(spark.createDataFrame([], SCHEMA), "r0")
    first = state.run(numbered(spark, n=40), "r1")
    assert len(first.leaves) == 16
    more = numbered(spark, n=400)
    second = state.run(more, "r2")
    assert second.splits != first.splits and max(state._digests(state._current(more, second.splits))[1].values()) < 64
    assert state.output().filter("run = 'r2'").count() == 360
    state.run(more, "r3")
    assert took(state, "r3") == []


def test_scattered_records_are_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_HOLDERS", 2)
    state = runs(spark, tmp_path, depth=1)
    for n in range(5):
        state.run(numbered(spark, [15 * i for i in range(n)], n=60), f"r{n}")
    assert [c.run for c in state.commits()].count("compaction") >= 1
    assert [len(took(state, f"r{n}")) for n in range(5)] == [60, 1, 1, 1, 1]


def test_keys_are_ordered_and_bisected(spark):
    rows = [(None, None), (None, "a"), (-3, "b"), (5, None), (5, "a"), (40, "")]
    df = spark.createDataFrame(rows[::-1], "n int, s string")
    keyed = df.select("n", "s", ordered_key(df, ["n", "s"]).alias("k"))
    assert [(r["n"], r["s"]) for r in keyed.orderBy("k").collect()] == rows
    splits = split_points(keyed, 4)
    assert len(splits) == 3 and splits == sorted(splits) and split_points(keyed, 16) == sorted(r["k"] for r in keyed.collect())[1:]
    for strictly in (False, True):
        at = spark.range(9).select(bisected([2, 4, 4, 7], "bigint", F.col("id"), strictly)).collect()
        assert [r[0] for r in at] == [sum(x < i if strictly else x <= i for x in (2, 4, 4, 7)) for i in range(9)]
    assert spark.range(1).select(bisected([], "bigint", F.col("id"))).collect()[0][0] == 0


def test_history_equals_snapshots(spark):
    import random

    rng, day = random.Random(1), lambda n: datetime(2026, 3, 1 + n)
    rows = [(f"v{rng.randrange(4)}", rng.choice(["S0", "S3"]), rng.choice(["done", "failed"]), rng.choice(["h", "g", None]), None, day(rng.randrange(20)), day(rng.randrange(20))) for _ in range(120)]
    log = spark.createDataFrame(rows, "video_id string, stage string, status string, params_hash string, finished_at string, saved_at timestamp, loaded_at timestamp")
    moments = [day(n) for n in (2, 5, 5, 11)]
    history = stage_history(log, moments)
    for number, moment in enumerate(moments):
        now = history.filter((F.col("since") <= number) & (F.col("until") > number)).drop("since", "until")
        assert sorted(map(tuple, now.collect()), key=str) == sorted(map(tuple, stage_snapshot(log, moment).select(*now.columns).collect()), key=str)
