import itertools
import json
import random
from datetime import date, datetime

import numpy as np
import pytest
from cuegrain.operators import corrections as C
from cuegrain.operators import grouping as G
from cuegrain.operators import invariants as V
from cuegrain.operators import provenance as P
from cuegrain.operators import retrieval as R
from cuegrain.operators import signals as Sg
from cuegrain.operators import state as St
from cuegrain.plans import pipeline as Q
from cuegrain.sources import captions
from cuegrain.sources.keyed import KeyedTable, lines_without
from pyspark.sql import functions as F

BLOCK = "video_id string, segment_id string, block_index int, type string, kind string, text string, slide_text string, transcript string, corrected string"


def test_verdicts(spark):
    src = "經絡是氣血運行的通道，分為兩種，骨架支撐身體，關節讓身體活動自如"
    rows = [
        ("v", "s", 0, "白話解說", "transcript", "氣血運行的通道就是經絡，骨架支撐身體", None, src, None),
        ("v", "s", 1, "經文原文", "transcript", "火箭升空需要大量燃料與推力", None, src, None),
        ("v", "s", 2, "白話解說", "transcript", "經絡是氣血運行的通道，出自《虛構之書》", None, src, None),
        ("v", "s", 3, "口頭延伸", "transcript", src[:20], None, src, None),
        ("v", "s", 4, "白話解說", "transcript", "經絡氣血" * 40, None, "經絡", None),
        ("v", "s", 5, "經文原文", "transcript", "星宿月相潮汐日影", "星宿月相潮汐日影晨昏", src, None),
        ("v", "s", 6, "經文原文", "transcript", "星宿月相潮汐日影", None, src, "星宿月相潮汐日影晨昏"),
        ("v", "s", 7, "圖表描述", "slide_ocr", None, None, None, None),
    ]
    out = {r["block_index"]: r for r in P.check_blocks(spark.createDataFrame(rows, BLOCK)).collect()}
    assert {k: (r["status"], r["reason"]) for k, r in out.items()} == {0: ("verified", ""), 1: ("unverified", "unlike"), 2: ("unverified", "entities"), 3: ("degenerate_copy", "copy"), 4: ("unverified", "short_source"), 5: ("unverified", "unlike"), 6: ("unverified", "unlike"), 7: ("unverified", "short_source")}
    assert out[2]["missing"] == ["虛構之書"] and out[5]["wrong_source"] and not out[1]["wrong_source"] and out[6]["depends_on_correction"] and not out[5]["depends_on_correction"]
    v = P.check_blocks(spark.createDataFrame(rows, BLOCK))
    assert {r["status"] for r in P.relax_copies(v).filter("block_index = 3").collect()} == {"degenerate_copy"}
    total = P.video_verdicts(v).first()
    assert (total["total"], total["unverified"], total["needs_review"], total["wrong_source"], total["depends_on_correction"]) == (8, 7, True, 1, 1)
    assert P.overall_rate(P.video_verdicts(v.limit(0))).first()["pass_rate"] == 0.0
    chunk = P.build_chunks(v).collect()
    assert [c["chunk_id"] for c in chunk] == ["s#b00"]
    assert V.complete_chunks(P.build_chunks(v), required=["text"]).count() == 0
    long = v.filter("block_index = 0").withColumn("text", F.repeat(F.lit("一句話說完了。"), 200))
    assert [c["chunk_id"] for c in P.build_chunks(long).orderBy("chunk_id").collect()] == ["s#b00", "s#b00-1"]


def test_blocks_hold_whole_transcripts(spark, tmp_path):
    said = ["脈" * 30 + "絡" * 40 + "。", "".join(chr(0x4E00 + i % 700) + "。" * (i % 50 == 49) for i in range(1900)), None, "", "短"]
    seg = [(f"v#{i}", "v", None, x, None) for i, x in enumerate(said)]
    spark.createDataFrame(seg, "segment_id string, video_id string, slide_ref string, transcript_raw string, transcript_corrected string").write.parquet(f"{tmp_path}/segments.parquet")
    spark.createDataFrame([], "read_id string, video_id string, slide_id string, parsed struct<slide_text: string, description: string>").write.parquet(f"{tmp_path}/slide_out.parquet")
    b = {r["segment_id"]: r["text"] for r in Q.blocks(spark, str(tmp_path)).collect()}
    assert b == {f"v#{i}": said[i + 1] for i in (0, 2, 3)}
    v = P.check_blocks(Q.blocks(spark, str(tmp_path))).withColumn("status", F.lit("verified"))
    pieces = P.build_chunks(v).filter("segment_id = 'v#0'").orderBy("chunk_id").collect()
    assert "".join(r["text"] for r in pieces) == said[1] and len(pieces) > 1


def test_sets_components_and_groups(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        base = rng.choice([list(range(0, 20)), list(range(30, 52))])
        rows.append(("g" if i % 3 else "h", f"k{i:02}", sorted(set(base) - set(rng.sample(base, rng.randrange(6))))))
    rows += [("g", "e1", []), ("g", "e2", None), ("h", "x1", [1, 2]), ("h", "x2", [1, 2])]
    df = spark.createDataFrame(rows, "g string, k string, items array<int>")
    jac = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    groups = {}
    for g, k, s in rows:
        if s:
            groups.setdefault((g, tuple(s)), []).append(k)
    reps = {(g, s): min(ks) for (g, s), ks in groups.items()}
    expected = {(g, *sorted((reps[g, s], reps[h, t]))) for (g, s), (h, t) in itertools.combinations(reps, 2) if g == h and jac(s, t) >= 0.7 - 1e-12}
    expected |= {(g, reps[g, s], k) for (g, s), ks in groups.items() for k in ks if k != reps[g, s]}
    got = G.similar_sets(df, group="g", key="k", items="items", similarity=0.7)
    assert {(r["g"], r["a"], r["b"]) for r in got.collect()} == expected
    grouped = {r["k"]: r["rep"] for r in G.dedup_groups(df, group="g", key="k", items="items", guard=0.99).collect()}
    assert len(grouped) == len(rows) and grouped["e1"] == "e1" and grouped["x1"] == grouped["x2"] == "x1"
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 1)], "a int, b int")
    labels = {r["node"]: r["component"] for r in G.connected_components(chain).collect()}
    assert labels == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert G.connected_components(chain.limit(0)).count() == 0
    one = spark.createDataFrame([("g", "a", [1, 2, 3]), ("g", "b", [1, 2, 3])], "g string, k string, items array<int>")
    assert {r["k"]: r["rep"] for r in G.dedup_groups(one, group="g", key="k", items="items").collect()} == {"a": "a", "b": "b"}
    wide = spark.createDataFrame([("a", None, None), ("b", "x", 1)], "k string, t string, n int")
    reps = spark.createDataFrame([("a", "b"), ("b", "b")], "k string, rep string")
    assert sorted(map(tuple, G.propagate(wide, reps, key="k", rep="rep", columns=["t"]).collect())) == [("a", "x", None), ("b", "x", 1)]
    edge = spark.createDataFrame([([], [], [1.0], [2.0]), ([1], [], [1.0], [1.0, 2.0])], "a array<int>, b array<int>, v array<double>, w array<double>")
    assert [list(r) for r in edge.select(G.jaccard_distance(F.col("a"), F.col("b")), G.set_containment(F.col("a"), F.col("b")), G.mean_abs_difference(F.col("v"), F.col("w"))).collect()] == [[0.0, 1.0, 1.0], [1.0, 0.0, None]]


def test_series(spark):
    flat = np.full(60, 0.005)
    flat[[20, 40]] = 0.9
    assert Sg.change_points(flat).tolist() == [20, 40] and Sg.change_points(np.zeros(0)).tolist() == [] and Sg.change_points(np.full(30, 0.5)).tolist() == []
    rows = spark.createDataFrame([("v", i, float(x)) for i, x in enumerate(flat)], "e string, o int, d double")
    changes = Sg.viterbi_changes(rows, entity="e", order="o", distance="d")
    s = Sg.sections(rows, changes, entity="e", order="o")
    assert sorted((r["start"], r["end"]) for r in s.collect()) == [(0, 20), (20, 40), (40, 60)]
    short = spark.createDataFrame([("v", 0, 0, 2), ("v", 1, 2, 30), ("v", 2, 30, 32), ("v", 3, 32, 60)], "e string, section int, start int, end int")
    assert sorted((r["start"], r["end"]) for r in Sg.drop_short(short, entity="e", least=3).collect()) == [(0, 2), (2, 32), (32, 60)]
    ink = spark.createDataFrame([("v", 0, [1]), ("v", 1, [1, 2]), ("v", 2, [1, 2, 3]), ("v", 3, [9]), ("v", 4, [8, 9]), ("w", 0, None)], "e string, o int, ink array<int>")
    assert sorted(tuple(r) for r in Sg.merge_progressive(ink, entity="e", order="o", ink="ink").collect()) == [("v", 0, 2, 3), ("v", 3, 4, 2), ("w", 0, 0, 1)]
    falling = spark.createDataFrame([("v", 0, list(range(10))), ("v", 1, list(range(7))), ("v", 2, list(range(5)))], "e string, o int, ink array<int>")
    assert sorted(tuple(r) for r in Sg.merge_progressive(falling, entity="e", order="o", ink="ink").collect()) == [("v", 0, 1, 2), ("v", 2, 2, 1)]
    frames = spark.createDataFrame([("v", i, list(range([10, 7, 5, 9][i // 6]))) for i in range(24)], "e string, o int, ink array<int>")
    spans = spark.createDataFrame([("v", n, 6 * n, 6 * n + 6) for n in range(4)], "e string, section int, start int, end int")
    assert sorted(tuple(r) for r in Sg.merge_sections(spans, frames, entity="e", order="o", ink="ink").collect()) == [("v", 0, 12, 2), ("v", 12, 24, 2)]
    cut = Sg.otsu_threshold(spark.createDataFrame([("a", x) for x in [0.1] * 10 + [1.0] * 10] + [("b", 0.0)], "e string, v double"), entity="e", value="v")
    cuts = {r["e"]: r["cut"] for r in cut.collect()}
    assert 0.09 <= cuts["a"] < 1.0 and cuts["b"] == 0.0


def test_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), i % 3) for i in range(90)] + [(200, None, 1)]
    df = spark.createDataFrame(rows, "id int, v array<double>, g int")
    vec = {i: np.array(v) for i, v, _ in rows if v}
    cos = lambda a, b: round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9)
    got = R.nearest_vectors(df.filter("id % 10 = 0"), df, ident="id", vector="v", k=3).collect()
    for q in range(0, 90, 10):
        best = sorted(((-cos(vec[q], vec[c]), c) for c in vec if c != q))[:3]
        assert [r["found"] for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == q] == [c for _, c in best]
    near = R.nearest_vectors(df.filter("id = 0"), df, ident="id", vector="v", k=1, metric="l1", other_group="g").first()
    assert near["found"] == min((float(np.abs(vec[0] - vec[c]).mean()), c) for c in vec if c % 3)[1]
    ranked = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (2, 7, 3)], "query int, found int, rank int")
    gold = spark.createDataFrame([(1, 6), (2, 9), (3, 1)], "query int, found int")
    assert list(R.ranking_measures(ranked, gold, cuts=[1, 3]).first()) == [3, 0.0, 0.333, 0.167]


def test_corrections(spark):
    texts = spark.createDataFrame([("a", "今天講形照胚也的道理"), ("b", "形兆胚也"), ("c", None)], "k string, t string")
    terms = spark.createDataFrame([("形兆胚也",), ("形兆胚也",), ("道",)], "term string")
    assert list(map(tuple, C.propose(texts, terms, key="k", text="t", similarity=0.75).collect())) == [("a", "形照胚也", "形兆胚也", 0.75)]
    p = spark.createDataFrame([("a", 0, " 形照 ", "形兆", "形照"), ("a", 1, "形照", "形兆", "形照"), ("a", 2, "無", "有", "形照"), ("a", 3, "形照", "形照", "形照"), ("a", 4, "", "x", "形照")], "k string, pos int, before string, after string, raw string")
    assert [r["pos"] for r in C.validate_corrections(p, key="k", raw="raw").collect()] == [0]
    rows = lambda *x: spark.createDataFrame(list(x), "key int, before string, after string")
    s = C.set_scores(rows((1, "a", "b"), (1, "a", "b"), (2, "c", "d")), rows((1, "a", "b"))).first()
    assert (s["tp"], s["fp"], s["fn"], s["precision"], s["recall"]) == (1, 1, 0, 0.5, 1.0)
    assert list(C.set_scores(rows((1, "a", "b")).limit(0), rows((1, "a", "b")).limit(0)).first())[3:5] == [1.0, 1.0]
    t = spark.createDataFrame([(1, "形兆胚也", "形兆胚也")], "key int, ideal string, corrected string")
    assert list(C.outcome_scores(rows((1, "形照胚也", "形兆胚也")), rows((1, "形照", "形兆")), t).first()) == [1, 0, 0, 1.0, 1.0]


def test_proposals_take_all_lengths_of_transcripts(spark, tmp_path):
    terms = ["形兆胚", *("".join(chr(0x5000 + 40 * n + i) for i in range(n)) for n in range(4, 13))]
    said = ["今日" + t[:-1] + "誤也" for t in terms]
    spark.createDataFrame([(f"v#{i:02}", x) for i, x in enumerate(said)], "segment_id string, transcript_raw string").write.parquet(f"{tmp_path}/segments.parquet")
    for t, x in (("slide_out", " ".join(terms)), ("slide_raw", terms[1][:-1] + "誤")):
        spark.createDataFrame([("r", "v", "s", (x,))], "read_id string, video_id string, slide_id string, parsed struct<slide_text: string>").write.parquet(f"{tmp_path}/{t}.parquet")
    want = set()
    for i, x in enumerate(said):
        for n in range(3, 13):
            for w in {x[k : k + n] for k in range(len(x) - n + 1)}:
                near = [(-sum(a == b for a, b in zip(w, t)) / n, t) for t in terms if len(t) == n and t != w]
                if w not in terms and near and -min(near)[0] >= 0.75:
                    want.add((f"v#{i:02}", w, min(near)[1], round(-min(near)[0], 9)))
    assert {len(t) for _, _, t, _ in want} == set(range(4, 13))
    assert set(map(tuple, Q.proposed_corrections(spark, str(tmp_path)).collect())) == want


def test_proposals_are_found_where_the_texts_are(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda least, most: "".join(rng.choice("甲乙丙aA𠀀") for _ in range(rng.randrange(least, most)))
    terms, texts = sorted({word(2, 9) for _ in range(60)}), [(i, word(0, 40)) for i in range(60)]
    want = set()
    for i, x in texts:
        for n in range(3, 9):
            for w in {x[k : k + n] for k in range(len(x) - n + 1)} - set(terms):
                near = [(sum(a != b for a, b in zip(w.lower(), t.lower())), t) for t in terms if len(t) == n]
                if near and 1 - min(near)[0] / n >= 0.75:
                    want.add((i, w, min(near)[1], round(1 - min(near)[0] / n, 9)))
    for at in (None, 7):  # all terms at once, and in lots
        if at:
            monkeypatch.setattr(C, "TERMS_AT_ONCE", at)
        found = C.propose(spark.createDataFrame([*texts, *texts, (99, None)], "k int, t string"), spark.createDataFrame([(t,) for t in terms], "term string"), key="k", text="t", similarity=0.75, most=8)
        rows = list(map(tuple, found.collect()))
        assert set(rows) == want and len(rows) == len(want) > 100
        assert at or "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_states_and_quota(spark):
    assert St.downstream()["S1b"] == ["S1c", "S3", "S4", "S4a", "S5", "S6"] and St.downstream()["S6"] == []
    day = lambda x: spark.createDataFrame([(x,)], "t timestamp").select(St.quota_day(F.col("t")), St.next_reset(F.col("t"))).first()
    assert tuple(day(datetime(2026, 8, 4, 23, 0))) == (date(2026, 8, 4), datetime(2026, 8, 5, 7, 0))
    assert tuple(day(datetime(2026, 1, 5, 7, 59))) == (date(2026, 1, 4), datetime(2026, 1, 5, 8, 0))
    items = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3")], "k string, f string")
    hits, misses = St.cache_split(items, spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None)], "k string, f string"), ["k", "f"])
    assert [r["k"] for r in hits.collect()] == ["a"] and sorted(r["k"] for r in misses.collect()) == ["b", "c"]
    b = St.batches(spark.createDataFrame([("v", i) for i in range(7)], "e string, o int"), entity="e", order="o", size=3)
    assert [r["batch"] for r in b.orderBy("o").collect()] == [0, 0, 0, 1, 1, 1, 2]


def test_invariants_find_single_mutations(spark):
    legal = [("v", "a", 0.0, 20.0, [0, 1]), ("v", "b", 20.0, 90.0, [2, 3])]
    ends = spark.createDataFrame([("v", 90.0)], "e string, d double")

    def rules(rows):
        df = spark.createDataFrame(rows, "e string, k string, s double, f double, m array<int>")
        span = dict(entity="e", key="k", span=("s", "f"))
        known = spark.createDataFrame([("v", i) for i in range(4)], "e string, member int")
        found = V.check_all(V.disjoint(df, **span), V.covering(df, ends, **span, end="d"), V.in_range(df, ends, **span, end="d"), V.assigned_once(df, entity="e", members="m", known=known))
        return sorted({r["rule"] for r in found.collect()}), found

    assert rules(legal)[0] == []
    V.assert_all(rules(legal)[1])
    assert rules([legal[0], ("v", "b", 15.0, 90.0, [2, 3])])[0] == ["disjoint"]
    assert rules([legal[0], ("v", "b", 25.0, 90.0, [2, 3])])[0] == ["gap_before"]
    assert rules([legal[0], ("v", "b", 20.0, 80.0, [2, 3])])[0] == ["gap_at_end"]
    assert rules([legal[0], ("v", "b", 20.0, 95.0, [2, 3])])[0] == ["out_of_range"]
    assert rules([legal[0], ("v", "b", 20.0, 90.0, [1, 2, 9])])[0] == ["held_twice", "unassigned", "unknown"]
    with pytest.raises(V.Violated):
        V.assert_all(rules([legal[0], ("v", "b", 15.0, 90.0, [2, 3])])[1])


def test_captions(spark, tmp_path):
    vtt = "WEBVTT\nKind: captions\n\nNOTE x\n\n1\n00:00:01.000 --> 00:00:02.500\n<c>一月</c>  &amp; 二月\n\n00:00:02,500 --> 00:00:04,000 align:start\n12\n一月 & 二月為胞\n34\n\n00:00:05.000 --> 00:00:06.000\n \n"
    (tmp_path / "a.vtt").write_text(vtt.replace("\n", "\r\n"))
    files = captions.read_captions(spark, str(tmp_path)).unionByName(spark.createDataFrame([("empty", ""), ("none", None)], "file string, content string"))
    cues = captions.parse_captions(files, entity="file", content="content")
    assert [(r["index"], r["t_start"], r["t_end"], r["text"]) for r in cues.orderBy("index").collect()] == [(0, 1.0, 2.5, "一月 & 二月"), (1, 2.5, 4.0, "一月 & 二月為胞 34")]
    rolled = captions.collapse_rolling(cues, entity="file").collect()
    assert [(r["t_start"], r["t_end"], r["text"]) for r in rolled] == [(1.0, 4.0, "一月 & 二月為胞 34")]
    targets = ["abcdefghijk", "https://x.example/watch?v=abcdefghijk&list=PL12", "PLxyz", "nothing"]
    got = spark.createDataFrame([(t,) for t in targets], "t string").select(captions.parse_target(F.col("t")).alias("p")).collect()
    assert [tuple(r["p"]) for r in got] == [("abcdefghijk", None), ("abcdefghijk", "PL12"), (None, "PLxyz"), (None, None)]
    items = captions.expand_playlist(spark.createDataFrame([("PL", ["a", None, "c"])], "p string, e array<string>"), playlist="p", entries="e")
    assert sorted(map(tuple, items.collect())) == [("PL", "a", 1), ("PL", "c", 3)]
    tracks = spark.createDataFrame([("v", "en", True), ("v", "zh", False), ("v", "zh-TW", False), ("w", "fr", True)], "v string, l string, m boolean")
    assert list(map(tuple, captions.pick_caption(tracks, entity="v", lang="l", manual="m", order=["zh-TW", "zh"]).collect())) == [("v", "zh-TW", False)]
    src = spark.createDataFrame([("v", "asr", 1.0, 1.0), ("v", "manual", 2.0, 1.0)], "v string, s string, t_start double, t_end double")
    assert list(map(tuple, captions.pick_source(src, entity="v", source="s", order=["manual", "asr"]).collect())) == [("v", "manual", 2.0, 2.01)]


def test_keyed_table_and_lines(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k", "k string, n int", buckets=4)
    assert table.read().count() == 0
    rows = lambda *x: spark.createDataFrame(list(x), "k string, n int")
    table.replace(rows(("a", 1), ("a", 2), ("b", 1), (None, 5)))
    table.replace(rows(("a", 9)), rows(("a", 0), ("b", 0)).select("k"))
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted([("a", 9), (None, 5)], key=str)
    table.drop(rows((None, 0)).select("k"))
    assert list(map(tuple, table.read().collect())) == [("a", 9)]
    lines = ['{"video_id": "a"}', '{"metadata": {"video_id": "b"}}', "not json", " ", '{"x": 1}']
    kept = lines_without(spark.createDataFrame([(x,) for x in lines], "value string"), spark.createDataFrame([("a",), ("b",)], "video_id string"), key="video_id")
    assert sorted(r[0] for r in kept.collect()) == sorted(["not json", json.dumps({"x": 1})])
