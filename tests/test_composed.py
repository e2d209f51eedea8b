import random

import __spark_entry__ as entry
import pyarrow as pa
from cuegrain.operators import pipelines as L
from cuegrain.operators import survey as V
from cuegrain.sources.keyed import KeyedTable
from cuegrain.streaming import feeds
from pyspark.sql import functions as F


def test_entry_names_and_sql():
    names, sql = entry.queries(), entry.oracle_sql()
    assert "p1_found" in names and set(sql) <= set(names) and len(names) > 80


def test_align_segments(spark):
    a, b = "骨架血脈經絡臟腑關節", "星宿月相潮汐日影晨昏"
    rows = [("v", f"c{i:02}", 10.0 * i, 10.0 * i + 9, (a if i < 8 else b) * 4) for i in range(16)] + [("u", "x", 0.0, 1.0, None)]
    cues = spark.createDataFrame(rows, "e string, cue string, t_start double, t_end double, text string")
    ends = spark.createDataFrame([("v", 160.0), ("u", 5.0)], "e string, duration double")
    slides = spark.createDataFrame([("v", "s1", 90.0, 150.0)], "e string, slide_id string, s_start double, s_end double")
    out = {r["segment_id"]: r for r in L.align_segments(cues, ends, slides, entity="e").collect()}
    v = sorted((r["t_start"], r["t_end"], r["mode"]) for k, r in out.items() if k.startswith("v"))
    assert v[0][0] == 0.0 and v[-1][1] == 160.0 and all(x[1] == y[0] for x, y in zip(v, v[1:]))
    assert sorted(c for r in out.values() for c in r["cues"]) == sorted(r[1] for r in rows)
    assert out["u#000"]["mode"] == "speaker_only" and out["u#000"]["transcript"] == "" and v[-1][2] == "slide"


def test_detect_slides(spark):
    ink = [[1, 2, 3]] * 20 + [[1, 2, 3, 4]] * 20 + [[9, 8]] * 20
    frames = spark.createDataFrame([("v", i, x) for i, x in enumerate(ink)], "e string, o int, ink array<int>")
    out = L.detect_slides(frames, spark.createDataFrame([("v", 60.0)], "e string, duration double"), entity="e", order="o", ink="ink")
    assert sorted((r["t_start"], r["t_end"]) for r in out.collect()) == [(0.0, 40.0), (40.0, 60.0)]


def test_claims_are_searched_without_pieces_of_texts(spark):
    rng = random.Random(3)
    word = lambda least, most: "".join(rng.choice("ab甲𠀀") for _ in range(rng.randrange(least, most)))
    texts = [(rng.choice(["u", "v", "w", None]), word(0, 40)) for _ in range(300)] + [("u", None)]
    claims = {(rng.choice(["u", "v", "x", None]), word(0, 9)) for _ in range(1500)} | {("u", None), ("u", "甲" * 50)}
    texts += [("u", "b" + "甲" * 60), ("v", "甲" * 60)]
    found = V.claim_support(spark.createDataFrame(sorted(claims, key=repr) * 2, "k string, c string"), spark.createDataFrame(texts, "k string, x string"), key="k", claim="c", text="x")
    rows = list(map(tuple, found.collect()))
    assert {(k, c): n for k, c, n in rows} == {(k, c): sum(k == e and bool(c) and c in (x or "") for e, x in texts) if k else 0 for k, c in claims} and len(rows) == len(claims)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_survey(spark):
    p = spark.createDataFrame([("s", 0.5, 2.0, 1.0, 0.0), ("s", 0.99, 0.1, 4.0, 0.2), ("t", 0.1, 9.0, 1.0, 0.0)], "s string, ratio double, separation double, density double, midband double")
    assert sorted(map(tuple, V.mismatches(p, series="s").collect())) == [("s", "density", 4.0), ("s", "separation", 2.0)]
    b = V.series_baseline(p, series="s", ratio="ratio")
    assert {r["s"]: round(r["baseline"], 3) for r in b.collect()} == {"s": 0.255, "t": 0.9}
    assert [r["s"] for r in V.deviations(p, b.filter("s = 'none'"), series="s", ratio="ratio").collect()] == ["s"]
    f = spark.createDataFrame([("s", "a", 1, [0.1, 0.1]), ("s", "b", 2, [0.1, 0.12]), ("s", "c", 3, [0.5, 0.5]), ("s", "d", 4, None), ("s", "e", 5, [0.1])], "s string, k string, o int, f array<double>")
    assert [(r["k"], r["nearest"]) for r in V.background_drift(f, group="s", key="k", order="o", fingerprint="f").collect()] == [("c", "b")]


def test_small_operators(spark):
    s = spark.createDataFrame([("ollama:q:7b",), ("x:y",), ("gemini:",), ("none",), (None,)], "s string")
    assert [r[0] and tuple(r[0]) for r in s.select(V.split_spec(F.col("s"), ["ollama", "gemini"])).collect()] == [("ollama", "q:7b"), None, None, None, None]
    slides = spark.createDataFrame([("a", (True, None, " x ", "d")), ("b", (False, " ", "x", "d")), ("c", None)], "k string, p struct<is_slide boolean, reject_reason string, slide_text string, description string>")
    assert [tuple(r) for r in V.apply_payload(slides, "p").drop("p").collect()] == [("a", "x", "d", None), ("b", None, None, "未說明"), ("c", None, None, "未說明")]
    seg = spark.createDataFrame([("a", "slide", "s1"), ("b", "slide", "s2")], "k string, mode string, slide_ref string")
    assert sorted(map(tuple, V.apply_to_segments(seg, spark.createDataFrame([("a", False)], "k string, is_slide boolean"), key="k").collect())) == [("a", "speaker_only", None), ("b", "slide", "s2")]
    masks = spark.createDataFrame([("m", [True, True, False, False]), ("z", [False, None, False, False])], "k string, m array<boolean>")
    stats = {r["k"]: r for r in V.mask_stats(masks, key="k", mask="m", width=2).collect()}
    assert (stats["m"]["ink"], stats["m"]["coverage"], stats["m"]["top_share"], stats["z"]["ink"]) == (2, 0.5, 1.0, 0)
    rejects = V.cross_episode_rejects(spark.createDataFrame([(1, 0.01), (2, 0.5)], "q int, score double"), limit=0.06, references=2)
    assert [r["q"] for r in rejects.collect()] == [1]
    gaps = V.separation(spark.createDataFrame([("v", 0.1, True), ("v", 0.4, False), ("v", 0.2, True)], "v string, d double, m boolean"), entity="v", distance="d", merged="m").first()
    assert tuple(gaps) == ("v", 2, 0.2, 1, 0.4)


def test_run_model_uses_the_cache(spark):
    items = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, f string")
    cache = spark.createDataFrame([("a", "1", "kept"), ("b", "old", "stale")], "k string, f string, r string")

    def call(batch):
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(["new"] * batch.num_rows)], ["k", "f", "r"])

    out = V.run_model(items, cache, ["k", "f"], call, "k string, f string, r string")
    assert sorted(map(tuple, out.collect())) == [("a", "1", "kept"), ("b", "2", "new")]


def test_streams(spark, tmp_path):
    rows = [("2026-08-05 06:59:00", "m", 1), ("2026-08-05 07:01:00", "m", 1), ("2026-08-09 00:00:00", "m", 2)]
    df = spark.createDataFrame(rows, "ts string, model string, u int").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    feed = lambda: spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")

    def run(stream, name):
        q = stream.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(map(tuple, spark.table(name).collect()), key=str)

    assert [(str(d), m, n) for d, m, n in run(feeds.quota_counts(feed(), time="ts", model="model"), "q1")] == [("2026-08-04", "m", 1), ("2026-08-05", "m", 1), ("2026-08-08", "m", 1)]
    assert [(u, n) for u, _, _, n in run(feeds.sessions(feed(), time="ts", entity="u"), "q2")] == [(1, 2), (2, 1)]
    table = KeyedTable(spark, f"file://{tmp_path}/t", "model", "ts timestamp, model string, u int", buckets=2)
    feeds.replace_by_key(feed(), table, f"{tmp_path}/cp").awaitTermination()
    assert table.read().count() == 3
