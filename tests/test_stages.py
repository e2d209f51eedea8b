import json

import pandas as pd
import pytest
from cuegrain.functions import text as T
from cuegrain.operators import corrections as C
from cuegrain.operators import intervals as I
from cuegrain.operators import segmentation as S
from cuegrain.operators import stages as K
from cuegrain.operators import state as St
from cuegrain.operators import survey as Y
from cuegrain.sources import captions
from cuegrain.sources.keyed import KeyedTable
from pyspark.sql import functions as F

SEGMENT = "segment_id string, slide_id string, slide_text string, transcript string, t_start double, t_end double, answer string"


def test_blocks_of_answers(spark):
    block = lambda kind, type_="白話解說", text=" x ": {"type": type_, "text": text, "provenance_kind": kind}
    answer = json.dumps({"content_blocks": [block(None), block("slide_ocr"), block("transcript"), block("other"), block("transcript", "none"), block("transcript", text=None), block("transcript", text="y")]})
    rows = [("a", "s1", None, "said", 1.0, 2.5, answer), ("b", "s1", "shown", "  ", 0.0, 1.0, answer), ("c", None, None, None, None, None, None), ("d", None, None, "x", 0.0, 1.0, "[1")]
    out = K.understood_blocks(K.parse_payload(spark.createDataFrame(rows, SEGMENT), "answer"))
    got = {(r["segment_id"], r["position"]): r for r in out.collect()}
    assert [got["a", i]["dropped"] for i in range(7)] == ["no_kind", "no_slide", None, "malformed", "malformed", "malformed", None]
    assert [got["b", i]["dropped"] for i in range(3)] == ["no_kind", None, "no_transcript"]
    assert (got["a", 2]["ref"], got["b", 1]["ref"], got["a", 2]["text"], got["a", 6]["block_index"]) == ("1.0s-2.5s", "s1", "x", 1)
    assert {k for k, _ in got} == {"a", "b"}
    ok = K.parse_payload(spark.createDataFrame(rows, SEGMENT), "answer").select("segment_id", "json_ok").collect()
    assert [r["json_ok"] for r in sorted(ok)] == [True, True, False, False]


def test_batches_of_calls(spark):
    rows = [("v", f"s{i}", f"f{i}") for i in range(8)] + [("w", "t0", "g0")]
    cache = [(f"s{i}", f"f{i}", "kept", f"after s{i}") for i in (0, 1, 2, 3)] + [("s4", "old", "stale", "")]

    def call(batch, before):
        if "t0" in set(batch["segment_id"]):
            raise RuntimeError("the model fails")
        answered = batch[(batch["segment_id"] != "s4") | (len(batch) == 1)]
        return pd.DataFrame({"segment_id": answered["segment_id"], "result": str(before), "summary": "sum " + answered["segment_id"]})

    out = K.understand(spark.createDataFrame(rows, "video_id string, segment_id string, fp string"), spark.createDataFrame(cache, "segment_id string, fp string, result string, summary string"), call, entity="video_id", key="segment_id", order="segment_id", fingerprint="fp")
    got = {r["segment_id"]: (r["result"], r["source"]) for r in out.collect()}
    assert got == {"s0": ("kept", "cache"), "s1": ("kept", "cache"), "s2": ("kept", "cache"), "s3": ("after s2", "batch"), "s5": ("after s2", "batch"), "s4": ("after s2", "refill"), "s6": ("sum s4", "batch"), "s7": ("sum s4", "batch")}


def test_rendering_replaces_and_stops(spark, tmp_path):
    block = "video_id string, segment_id string, block_index int, type string, kind string, text string, slide_text string, transcript string, corrected string"
    said = "經絡是氣血運行的通道，骨架支撐身體，關節讓身體活動自如"
    rows = lambda texts: spark.createDataFrame([("v", "v#0", i, "白話解說", "transcript", t, None, said, None) for i, t in enumerate(texts)], block)
    segments = spark.createDataFrame([("v", "v#0", 0.0, 60.0, said, "u")], "video_id string, segment_id string, t_start double, t_end double, transcript string, url string")
    first = rows(["氣血運行的通道就是經絡，骨架支撐身體", "火箭升空需要大量燃料"])
    from cuegrain.operators import provenance as P

    kinds = lambda df: ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    v = P.check_blocks(first)
    schemas = {"unverified": kinds(K.unverified_rows(v)), "provenance": kinds(K.provenance_records(v, segments)), "chunks": kinds(P.build_chunks(v)), "reports": "video_id string, markdown string"}
    sinks = K.Sinks(**{n: KeyedTable(spark, f"file://{tmp_path}/{n}", "video_id", s, buckets=2) for n, s in schemas.items()})
    record = K.render(first, segments, sinks).first()
    assert (record["verified"], record["blocks_checked"], record["with_fabricated_symbols"]) == (1, 2, 0)
    K.render(first, segments, sinks)
    assert sinks.unverified.read().count() == sinks.provenance.read().count() == sinks.chunks.read().count() == sinks.reports.read().count() == 1
    with pytest.raises(K.StageFailed):
        K.render(rows(["骨"]), segments, sinks)
    assert sinks.provenance.read().first()["blocks_checked"] == 1 and sinks.chunks.read().count() == 1


def test_transitions(spark):
    state = "video_id string, stage string, status string, params_hash string, finished_at string, error string, note string"
    states = spark.createDataFrame([("v", "S0", "done", "a", "t", None, "n"), ("v", "S1a", "done", "b", "t", None, None), ("v", "S3", "done", "c", "t", None, None), ("v", "S4a", "failed", None, "t", "e", None), ("w", "S3", "done", "old", "t", None, None)], state)
    wanted = spark.createDataFrame([("S0", "a"), ("S1a", "changed"), ("S3", "c")], "stage string, want string")
    out = {(r["video_id"], r["stage"]): (r["status"], r["params_hash"], r["invalidated"]) for r in St.synced(states, wanted).collect()}
    assert out == {("v", "S1a"): ("done", None, False), ("v", "S3"): ("pending", None, True), ("v", "S4a"): ("pending", None, True), ("w", "S3"): ("done", None, False)}
    events = spark.createDataFrame([("v", "S0", "failed", None, "t2", "bad", None), ("v", "S1a", "stale", None, None, None, None), ("x", "S0", "done", "h", "t3", None, "new")], "video_id string, stage string, event string, params_hash string, finished_at string, error string, note string")
    got = {(r["video_id"], r["stage"]): tuple(r)[2:] for r in St.marked(states, events).collect()}
    assert got == {("v", "S0"): ("failed", "a", "t2", "bad", "n"), ("x", "S0"): ("done", "h", "t3", None, "new"), ("v", "S1a"): ("pending",) + (None,) * 4, ("v", "S3"): ("pending",) + (None,) * 4, ("v", "S4a"): ("pending",) + (None,) * 4}


def test_surveys_and_references(spark, tmp_path):
    profile = "video_id string, series_id string, ratio double, separation double, density double, midband double, `order` int, fingerprint array<double>"
    p = spark.createDataFrame([("a", "s", 0.5, 2.0, 1.0, 0.0, 1, [0.1]), ("b", "s", 0.5, 9.0, 1.0, 0.0, 2, [0.9]), ("c", "t", 0.2, 9.0, 1.0, 0.0, 1, [0.1])], profile)
    table = KeyedTable(spark, f"file://{tmp_path}/profiles", "video_id", profile, buckets=2)
    problems, code = K.survey(p, spark.createDataFrame([], "series_id string, baseline double"), table)
    assert code == 3 and {(r["series_id"], r["problem"]) for r in problems.collect()} == {("s", "separation"), ("s", "deviation"), ("s", "background")} and table.read().count() == 3
    kept = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "e string")
    assert {r["e"]: r["references"] for r in K.reference_counts(kept, entity="e").collect()} == {"a": 1, "b": 1}
    near = spark.createDataFrame([("a", 0.01), ("z", 0.01)], "e string, score double")
    rejected, unjudged = K.recurring(near, kept, entity="e", limit=0.06, least=1)
    assert [r["e"] for r in rejected.collect()] == ["a"] and [r["e"] for r in unjudged.collect()] == ["z"]
    assert K.recurring(near, kept, entity="e", limit=0.06)[0].count() == 0
    counts = lambda *x: spark.createDataFrame(list(x), "outcome string, n int")
    assert [Y.exit_code(counts(*x)) for x in ([("known_skip", 3)], [("failed", 1)], [("failed", 1), ("succeeded", 1)])] == [0, 1, 0]


def test_small_stage_operators(spark):
    points = spark.createDataFrame([("v", 1.0), ("v", 50.0), ("w", 1.0), ("x", 1.0)], "e string, t double")
    bodies = spark.createDataFrame([("v", 1.0, 20.0), ("w", None, 20.0)], "e string, body_start double, body_end double")
    assert sorted(map(tuple, I.in_body(points, bodies, entity="e", time="t").collect())) == [("v", 1.0), ("w", 1.0), ("x", 1.0)]
    seen = spark.createDataFrame([("v", 3.0), ("v", 600.0)], "e string, m double")
    assert sorted(map(tuple, I.near_any(points, seen, entity="e", time="t", mark_time="m", tolerance=2.0).collect())) == [("v", 1.0)]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(T.convert_script(F.lit("这里说"), {"这": "這", "说": "說"})) == "這里說" and one(T.convert_script(F.lit("这"), {"这": "這"}, F.lit(False))) == "这"
    before, after = T.changed_stretch(F.lit("甲乙丙丁"), F.lit("甲己丁"))
    assert (one(before), one(after)) == ("乙丙", "己") and one(T.changed_stretch(F.lit("甲甲"), F.lit("甲"))[0]) == "甲"
    assert one(T.sound_coverage(F.lit("連軸器"), F.lit("聯週器"), {"連": "lian", "聯": "lian", "軸": "zhou", "週": "zhou"})) == 1.0 and one(T.coverage(F.lit("連軸器"), F.lit("聯週器"))) == 0.0
    words = C.ngram_lexicon(spark.createDataFrame([(1, "骨架關節a骨架"), (2, "骨架關"), (3, None)], "k int, t string"), key="k", text="t", documents=2)
    assert list(map(tuple, words.collect())) == [("骨架關", 2)]
    p = spark.createDataFrame([("a", "甲", "乙"), ("a", "AB", "ab"), ("b", "丙丁戊", "丙丁己")], "k string, before string, after string")
    assert [r["k"] for r in C.new_corrections(p, spark.createDataFrame([("a", "甲", "x")], "k string, before string, after string"), key="k").collect()] == ["b"]
    texts = ["骨架血脈經絡" * 5] * 3 + ["星宿月相潮汐" * 5] * 3
    b = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], "e string, block int, text string")
    assert [r["cut"] for r in S.description_length_cuts(b, entity="e", prior=5.0).collect()] == [3]
    assert S.description_length_cuts(b, entity="e", prior=5.0, candidates=spark.createDataFrame([("v", 3), ("u", 1)], "e string, cut int")).count() == 1
    a = spark.createDataFrame([("v", 1, 2)], "k string, x int, y int")
    assert [tuple(r) for r in Y.manifest_differences(a, spark.createDataFrame([("v", 1, 3)], "k string, x int, y int"), key="k").collect()] == [("v", "y", "2", "3")]
    cues = spark.createDataFrame([("v", "speech", 0.0, 0.0)], "e string, source string, t_start double, t_end double")
    with pytest.raises(ValueError):
        captions.pick_source(cues, entity="e", source="source", order=["manual", "speech"], expected=spark.createDataFrame([("u",)], "e string"))


def test_keyed_tables_grow(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/grown", "k", "k bigint, v string", buckets=2, per_bucket=10)
    some = lambda a, b, v: spark.range(a, b).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    table.replace(some(0, 100, "a"))
    assert table.manifest()[1] == 2
    table.replace(some(50, 60, "b"))
    assert table.manifest()[1] == 16 and table.read().count() == 100 and table.read().filter("v = 'b'").count() == 10
    table.drop(some(0, 5, ""))
    assert table.manifest()[1] == 16 and table.read().count() == 95


def test_rolling_captions_as_a_stream(spark, tmp_path):
    from cuegrain.streaming import feeds

    rows = [("v", 0, 0.0, 1.0, "a b", "2026-01-01 00:00:00"), ("v", 1, 1.0, 2.0, "a b c", "2026-01-01 00:00:01"), ("v", 2, 2.0, 3.0, "ab c", "2026-01-01 00:00:02"), ("v", 3, 3.0, 4.0, "d", "2026-01-01 00:00:03"), ("w", 0, 0.0, 1.0, None, "2026-01-01 00:00:03")]
    later = [("v", 4, 4.0, 5.0, "d e", "2026-01-01 00:00:05"), ("x", 0, 0.0, 1.0, "z", "2026-01-02 00:00:00")]
    schema = "e string, index int, t_start double, t_end double, text string, at string"
    for n, part in enumerate((rows, later, [("y", 0, 0.0, 1.0, "q", "2026-01-03 00:00:00")])):
        spark.createDataFrame(part, schema).withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        feed = spark.readStream.schema("e string, index int, t_start double, t_end double, text string, at timestamp").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        q = feeds.rolling_captions(feed, entity="e", time="at").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted((r["e"], r["t_start"], r["t_end"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got[:2] == [("v", 0.0, 3.0, "a b c"), ("v", 3.0, 5.0, "d e")]
