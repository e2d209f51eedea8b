import collections
import math
import random
import time

import pytest
from cuegrain.operators import intervals as I
from cuegrain.operators import segmentation as S
from pyspark.sql import functions as F


def test_asof_and_windows(spark):
    rng = random.Random(1)
    marks = [("v", round(rng.uniform(0, 5000), 1), i) for i in range(50)] + [("w", 10.0, 1), ("w", 10.0, 2), ("w", None, 3)]
    points = [("v", round(rng.uniform(-50, 5000), 1)) for _ in range(200)] + [("w", 10.0), ("w", 9.9), ("x", 1.0), ("w", None), (None, 1.0)]
    out = I.asof(spark.createDataFrame(points, "e string, t double"), spark.createDataFrame(marks, "e string, m double, n int"), entity="e", time="t", mark_time="m", value=["m", "n"], cell=300.0)
    expected = []
    for e, t in points:
        best = max(((m, n) for v, m, n in marks if v == e and m is not None and t is not None and m <= t), default=(None, None))
        expected.append((e, t, *best))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(2)
    span = lambda: (s := round(rng.uniform(0, 2000), 1), round(s + rng.uniform(0, 700), 1))
    a = [("v", i, *span()) for i in range(40)]
    b = [("v", i, *span()) for i in range(40)]
    da, db = spark.createDataFrame(a, "e string, i int, s double, f double"), spark.createDataFrame(b, "e string, j int, x double, y double")
    got = I.overlaps(da, db, entity="e", a_span=("s", "f"), b_span=("x", "y"), pad=3.0, cell=100.0)
    expected = sorted((i, j) for _, i, s, f in a for _, j, x, y in b if x <= f + 3 and y >= s - 3)
    assert sorted((r["i"], r["j"]) for r in got.collect()) == expected


def test_assignment_and_coarse_windows(spark):
    w = spark.createDataFrame([("v", 0, 0.0, 50.0), ("v", 1, 50.0, 100.0)], "e string, w_index int, w_start double, w_end double")
    c = spark.createDataFrame([("v", "a", 40.0, 70.0), ("v", "b", 105.0, 110.0), ("u", "c", 1.0, 2.0)], "e string, c string, s double, f double")
    assert sorted(map(tuple, I.assign_to_windows(c, w, entity="e", cue="c", span=("s", "f")).collect())) == [("a", 1), ("b", 1), ("c", None)]

    def coarse(candidates, duration):
        k = spark.createDataFrame([("v", f"s{i}", float(a), float(b)) for i, (a, b) in enumerate(candidates)], "e string, id string, s double, f double")
        rows = I.coarse_windows(k, spark.createDataFrame([("v", float(duration))], "e string, d double"), entity="e", ident="id", span=("s", "f"), end="d", least=5.0)
        return sorted((r["t_start"], r["t_end"], r["id"]) for r in rows.collect())

    assert coarse([(30, 90), (120, 200)], 250) == [(0, 30, None), (30, 90, "s0"), (90, 120, None), (120, 200, "s1"), (200, 250, None)]
    assert coarse([(0, 90), (92, 200)], 200) == [(0, 92, "s0"), (92, 200, "s1")]
    assert coarse([], 120) == [(0, 120, None)]
    assert coarse([(3, 10)], 20)[0][0] == 3


def test_blocks_topics_and_lengths(spark):
    a, b = "骨架血脈經絡臟腑關節", "星宿月相潮汐日影晨昏"
    rows = [("v", i, float(4 * i), (a if i < 8 else b)) for i in range(16)] + [("w", i, float(4 * i), a) for i in range(16)] + [("x", 0, 0.0, None)]
    cues = spark.createDataFrame(rows, "e string, o int, t double, x string")
    got = S.topic_boundaries(cues, entity="e", order="o", time="t", text="x", block_chars=10, window=2)
    found = {e: [r["t"] for r in got.collect() if r["e"] == e] for e in "vwx"}
    assert any(abs(t - 32.0) <= 12 for t in found["v"]) and len(found["w"]) <= 1 and not found["x"]
    total = S.blocks(cues, entity="e", order="o", time="t", text="x", least=25).groupBy("e").agg(F.sum(F.length("text")).alias("n")).collect()
    assert {r["e"]: r["n"] for r in total} == {"v": 160, "w": 160, "x": 0}
    keep = spark.range(1).select(S.keep_min_length(F.array(*[F.lit(float(x)) for x in (3, 10, 12, 40, 58)]), F.lit(60.0), 5.0).alias("k")).first()["k"]
    assert keep == [10.0, 40.0]


@pytest.mark.parametrize("ref, hyp, expected", [("000100000010", "000100000010", 0.0), ("000100000010", "000010000100", 0.30), ("000010000100", "100000010000", 0.80)])
def test_window_diff_published_values(spark, ref, hyp, expected):
    flags = lambda s: F.array(*[F.lit(int(x)) for x in s])
    got = spark.range(1).select(S.window_diff(flags(ref), flags(hyp), F.lit(3)), S.window_diff(flags(ref), flags(hyp[1:]), F.lit(3)), S.window_diff(flags(ref), flags(hyp), F.lit(13))).first()
    assert got[0] == pytest.approx(expected, abs=0.005) and got[1] is None and got[2] is None


def score(spark, pred, truth, tol=2.0):
    frame = lambda x: spark.createDataFrame([("v", float(t)) for t in x], "e string, t double")
    rows = S.boundary_scores(frame(pred), frame(truth), entity="e", time="t", tolerance=tol).collect()
    return (rows[0]["tp"], rows[0]["fp"], rows[0]["fn"]) if rows else None


def test_boundary_scores_cases(spark):
    assert score(spark, [31.9, 88.1], [30, 90]) == (2, 0, 0)
    assert score(spark, [32.1], [30]) == (0, 1, 1)
    assert score(spark, [30, 31, 32, 90], [30, 90]) == (2, 2, 0)
    assert score(spark, [30], [29.5, 30.5]) == (1, 0, 1)
    assert score(spark, [29.9, 30.2], [30, 31]) == (2, 0, 0)
    assert score(spark, [10, 20], []) == (0, 2, 0) and score(spark, [], [30, 60]) == (0, 0, 2) and score(spark, [], []) is None


def test_greedy_matching_equals_plain(spark):
    rng = random.Random(3)
    p, g = ([round(rng.uniform(0, 60), 1) for _ in range(25)] for _ in range(2))
    pairs = sorted((abs(x - y), i, j) for i, x in enumerate(sorted(p)) for j, y in enumerate(sorted(g)) if abs(x - y) <= 2.0)
    used_p, used_g = set(), set()
    for _, i, j in pairs:
        if i not in used_p and j not in used_g:
            used_p.add(i)
            used_g.add(j)
    assert score(spark, p, g) == (len(used_g), 25 - len(used_g), 25 - len(used_g))


def test_cuts_and_dp(spark):
    row = spark.range(1).select(S.uniform_cuts(F.lit(3), F.lit(100.0)), S.fixed_cuts(30.0, F.lit(90.0)), S.uniform_cuts(F.lit(0), F.lit(9.0)), S.default_window(F.lit(10), F.lit(1)), S.tolerance_coverage(10.0, F.lit(3), F.lit(0.0), F.lit(30.0))).first()
    assert list(row) == [[25.0, 50.0, 75.0], [30.0, 60.0], [], 2, 1.0]
    texts = ["甲乙丙丁甲乙丙丁"] * 5 + ["子丑寅卯子丑寅卯"] * 5
    assert S.dp_segments(texts, 5.0) == [5] and S.dp_segments(texts, 5.0, [3, 5]) == [5] and S.dp_segments(["甲"], 1.0) == []


def test_dp_segments_equal_plain_and_take_long_entities():
    rng = random.Random(1)

    def plain(texts, prior, allowed, longest):
        nodes = sorted({0, len(texts), *(c for c in (range(len(texts)) if allowed is None else allowed) if 0 < c < len(texts))})
        k = len({t[i : i + 2] for t in texts for i in range(len(t) - 1)}) or 1
        best = {0: (0.0, [])}
        for a, j in enumerate(nodes[1:]):
            for i in nodes[: a + 1]:
                if j - i <= longest or i == nodes[a]:
                    seen = collections.Counter(t[x : x + 2] for t in texts[i:j] for x in range(len(t) - 1))
                    n = sum(seen.values())
                    cost = best[i][0] + n * math.log(n + k) - sum(c * math.log(c + 1) for c in seen.values()) + prior
                    best[j] = min(best.get(j, (math.inf, [])), (cost, best[i][1] + [j]), key=lambda x: round(x[0], 6))
        return best[len(texts)][1][:-1]

    cuts = 0
    for _ in range(60):
        texts = ["".join(rng.choice(["甲乙丙丁", "子丑寅卯甲"][i // 7 % 2]) for _ in range(rng.choice([0, 1, 3, 20, 60]))) for i in range(rng.randrange(2, 30))]
        allowed, longest = rng.choice([None, sorted(rng.sample(range(-1, len(texts) + 2), 2))]), rng.choice([1_000, 10, 3])
        cuts += len(want := plain(texts, 5.0, allowed, longest))
        assert S.dp_segments(texts, 5.0, allowed, longest=longest) == want
    assert cuts > 50
    words = ["".join(map(chr, rng.sample(range(0x4E00, 0x4F00), 3))) for _ in range(300)]
    began = time.thread_time()
    S.dp_segments(["".join(rng.choices(words, k=100)) for _ in range(2_000)], 20.0)
    assert time.thread_time() - began < 15


def test_blocks_across_stretches(spark):
    import random

    rng = random.Random(4)
    rows = [("v" if i % 4 else "w", f"c{i:04}", float(i), rng.choice([None, "", "x" * rng.randrange(60)])) for i in range(400)]
    df = spark.createDataFrame(rows, "e string, o string, t double, x string")
    expected = {}
    for e in ("v", "w"):
        block, total = 0, 0
        for _, o, t, x in sorted(r for r in rows if r[0] == e):
            expected.setdefault((e, block), [t, ""])[1] += x or ""
            total += len(x or "")
            block, total = (block + 1, 0) if total >= 40 else (block, total)
    for coalesce in ("true", "false"):  # one stretch, or several
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        got = {(r["e"], r["block"]): [r["t"], r["text"]] for r in S.blocks(df, entity="e", order="o", time="t", text="x", least=40).collect()}
        assert got == expected
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert S.blocks(df.limit(0), entity="e", order="o", time="t", text="x", least=40).count() == 0
    flags = spark.createDataFrame([([1, 0, 1, 0], [0, 0, 1, 1], 2), ([1], [1, 0], 1), (None, [1], 1), ([1, None], [1, 0], 3)], "a array<int>, b array<int>, k int")
    assert [r[0] for r in flags.select(S.window_diff(F.col("a"), F.col("b"), F.col("k"))).collect()] == [2 / 3, None, None, None]
