from collections import defaultdict

import brute
import pytest
from cuegrain.llm.canon import look_alike_pairs, one_form
from cuegrain.llm.lexicon import TOKENIZERS, Transducer, build_lexicon, count_words, encode, token_sizes, tokenizer
from cuegrain.llm.minmax import expand_pairs, near_duplicates
from cuegrain.llm.nearest import nearest_in_time
from cuegrain.llm.packing import pack
from cuegrain.llm.repeats import repeated_share
from cuegrain.llm.split import split_oversized
from cuegrain.llm.stuffing import keyword_pages

LEFT, RIGHT = "b long, e string, t double, segment_id int", "s string, e string, t double, gap string"


def nearest(spark, left, right, **more):
    out = nearest_in_time(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), entity="e", left_id="b", left_time="t", right_id="s", right_time="t", tolerance=10.0, **more)
    return sorted(map(tuple, out.collect()))


def test_nearest_edges(spark):
    left = [(1, "v", 10.0, 0), (1, "v", 10.0, 0), (2, "v", 599.0, 0), (3, "v", None, 0), (4, None, 1.0, 0), (5, "w", 1.0, 0), (6, "v", float("nan"), 0), (7, "v", 100.0, 0), (8, "u", 5.0, 0)]
    right = [("a", "v", 20.0, ""), ("b", "v", 0.0, ""), ("c", "v", 605.0, ""), ("c", "v", 605.0, ""), ("d", "v", None, ""), (None, "v", 10.0, ""), ("e", None, 1.0, ""), ("f", "v", 110.1, ""), ("h", "u", 5.0, ""), ("g", "u", 5.0, "")]
    assert nearest(spark, left, right) == [(1, "a", 10.0), (2, "c", 6.0), (8, "g", 0.0)]
    assert nearest(spark, left, []) == [] == nearest(spark, [], right)


def test_nearest_equals_all_pairs(spark):
    import random

    rng = random.Random(1)
    right = [(f"s{i}", "v" if rng.random() < 0.7 else f"w{i % 5}", round(rng.uniform(0, 4000), 2), "") for i in range(300)]
    left = [(i, "v" if rng.random() < 0.7 else f"w{i % 5}", round(rng.uniform(0, 4000), 2), 0) for i in range(300)]
    expected = []
    for b, e, t, _ in left:
        near = min(((abs(t - x), s) for s, v, x, _ in right if v == e), default=None)
        if near and near[0] <= 10.0:
            expected.append((b, near[1], near[0]))
    assert nearest(spark, left, right) == sorted(expected)
    assert nearest(spark, left, right, per_shard=7) == sorted(expected)  # crowded cells are dealt out


def test_split_rows(spark):
    text = ("今天先講骨架，" * 20 + "再講血脈。") * 8
    rows = [("a", text, 0.0, 100.0, 1), ("a", text, 0.0, 100.0, 2), ("b", "短", 0.0, 1.0, 1), ("c", None, 0.0, 1.0, 1), ("d", "x" * 700, None, 5.0, 1), (None, "y" * 501, 1.0, 2.0, 1)]
    df = spark.createDataFrame(rows, "id string, text string, t_start double, t_end double, piece_no int")
    out = [tuple(r) for r in split_oversized(df, key="id", text="text", t_start="t_start", t_end="t_end").collect()]
    assert sorted(r[:4] for r in out if r[0]) == sorted([("a", *p) for p in brute.pieces(text)] + [("d", *p) for p in brute.pieces("x" * 700)])
    assert sum(r[0] is None for r in out) == 2
    first = next(r for r in out if r[:2] == ("a", 1))
    assert first[4] == 0.0 and first[5] == pytest.approx(100 * first[3] / len(text))
    assert next(r for r in out if r[0] == "d")[4] is None
    assert split_oversized(df.limit(0), key="id", text="text", t_start="t_start", t_end="t_end").count() == 0


def test_look_alike_pairs(spark):
    groups = ["café ABC１", "café АВС1", "cafe ABC1", "CAFÉ ABC1", "café ABC1", "café  ABC1", "café ABC​1", "café ABC¹"]
    groups += ["​ 　", "  ", None, "", "ｶﾞ", "ガ", "ガ", "カ"]
    rows = [("k", f"r{i:02}", "v", t) for i, t in enumerate(groups)] + [("k", "r00", "v", groups[0]), ("k", "z", "w", groups[1]), ("k", "n1", None, "Ａ"), ("k", "n2", None, "A"), ("j", "r00", "v", groups[1])]
    df = spark.createDataFrame(rows, "kind string, key string, entity string, text string")
    same = [["r00", "r01", "r04", "r06"], ["r12", "r13", "r14"]]
    assert sorted(map(tuple, look_alike_pairs(df).collect())) == sorted(("k", a, b) for g in same for a in g for b in g if a < b)
    forms = defaultdict(set)
    for r in one_form(df).collect():
        forms[r["form"]].add((r["kind"], r["entity"], r["key"]))
    across = {("k", "v", x) for x in same[0]} | {("k", "w", "z"), ("j", "v", "r00")}  # whatever the kind and entity
    assert across in forms.values() and {("k", None, "n1"), ("k", None, "n2")} in forms.values() and {("k", "v", "r02")} in forms.values() and {("k", "v", "r07")} in forms.values()
    assert look_alike_pairs(df.limit(0)).count() == 0 == one_form(df.limit(0)).count()


def test_one_form_of_every_script(spark):
    looks = [["cafe\u0301", "café"], ["Ꭺ1", "A1", "𝐀1", "Α1"], ["օ", "o", "о"], ["ℓ", "l"], ["한글", "\u1112\u1161\u11ab\u1100\u1173\u11af"], ["\u0995\u09cb", "\u0995\u09c7\u09be"], ["ὀ", "o\u0313", "ο\u0313"], ["I"], ["1"], ["|", "∣"], ["ı"], ["²"], ["O"], ["0"], ["\u0301"], ["口"], ["ロ"]]
    rows = [("k" if n % 2 else "j", f"{i}.{n}", f"v{n}", t) for i, same in enumerate(looks) for n, t in enumerate(same)]
    forms = defaultdict(set)
    for r in one_form(spark.createDataFrame(rows, "kind string, key string, entity string, text string")).collect():
        forms[r["form"]].add(r["key"])
    assert sorted(map(sorted, forms.values())) == sorted([f"{i}.{n}" for n in range(len(same))] for i, same in enumerate(looks))


def test_near_duplicates(spark):
    base = "控制律的飽和介面要先量測再記錄，軌道來源不要跟星圖混在一起，畫一條線就知道了，請把漁網想成容器"
    texts = {"a": base, "b": base, "c": base.replace("星圖", "月相"), "d": base[::-1], "e": "短", "f": None, "g": base[:20] + " \n" + base[20:], "h": base + "另外再加上一句很不一樣的話，看看相似度還剩多少才對呢"}
    rows = [(k, (t,), 1) for k, t in texts.items()] + [("a", (base,), 2), (None, (base,), 1)]
    df = spark.createDataFrame(rows, "id string, parsed struct<t:string>, rep int")
    links, members = near_duplicates(df, key="id", text="parsed.t")
    sets = {k: brute.shingles(t) for k, t in texts.items() if t and brute.shingles(t)}
    expected = sorted((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6)
    assert sorted(map(tuple, expand_pairs(links, members).distinct().collect())) == expected
    assert {r["key"]: r["rep"] for r in members.collect()} == {"a": "a", "b": "a", "g": "a", "c": "c", "d": "d", "h": "h"}
    assert sorted(map(tuple, links.select("a", "b").collect())) == sorted((a, b) for a, b in expected if {a, b} <= set("acdh"))
    links, members = near_duplicates(df.limit(0), key="id", text="parsed.t")
    assert links.count() == 0 == members.count()


def test_hashes_are_never_broadcast(spark):
    base = "控制律的飽和介面要先量測再記錄，軌道來源不要跟星圖混在一起，畫一條線就知道了，請把漁網想成容器"
    df = spark.createDataFrame([(f"k{i}", base + str(i)) for i in range(50)], "id string, t string")
    links, _ = near_duplicates(df, key="id", text="t")
    assert len(links.collect()) == 50 * 49 // 2
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [hash" not in plan and "SortMergeJoin [hash" in plan


def test_repeats_and_pages(spark):
    loop, prose = "這一句話一直重複出現，" * 9, "另外，有同學問骨架為什麼要乘以二，我畫給你看，這是慣例。" * 2
    tags = "#骨架 #血脈 #骨架溫度 #氣海 #骨架 #血脈傳訊 #骨架溫度"
    links = "".join(f'<a href="https://x{i}.example/tag/a">骨架</a>\n' for i in range(5))
    words = "骨架課程、血脈推薦、骨架推薦、血脈課程、骨架費用、血脈費用、骨架課程"
    rows = [(1, loop, 0), (1, loop, 0), (2, prose, 0), (3, tags, 0), (4, links, 0), (5, words, 0), (6, prose + "\n" + tags[:12], 0), (7, None, 0), (8, "", 0), (9, " 　", 0), (None, words, 0)]
    df = spark.createDataFrame(rows, "id int, text string, key int")
    shares = [tuple(r) for r in repeated_share(df, key="id", text="text").collect()]
    assert len(shares) == len(rows)
    for key, kept, repeated, share in shares:
        text = next(t for k, t, _ in rows if k == key) or ""
        assert (kept, repeated) == brute.repeated(text) and share == pytest.approx(repeated / max(kept, 1))
    pages = {r["id"]: r for r in keyword_pages(df, key="id", text="text").collect()}
    assert {k for k, r in pages.items() if r["spam"]} == {3, 4, 5, None}
    assert pages[7]["visible"] == pages[9]["visible"] == 0 and pages[5]["covered"] > 0.8 * pages[5]["visible"]
    assert keyword_pages(df.limit(0), key="id", text="text").count() == 0 == repeated_share(df.limit(0), key="id", text="text").count()


PROSE = {
    "de": "Der alte Müller ging jeden Morgen zum Fluss hinunter. Dort prüfte er, ob das Rad noch frei lief, und hörte auf das Wasser. Erst danach setzte er sich zu seiner Familie an den Tisch.",
    "es": "El maestro abrió la ventana porque hacía mucho calor. Los alumnos escuchaban en silencio mientras él explicaba la lección. Al final todos salieron contentos al patio.",
    "en": "Rivers carve valleys slowly. Farmers plant wheat near fertile banks every spring. Old bridges still carry carts toward market towns.",
    "zh": "春雨落下，山谷漸漸染綠。農夫清晨牽牛耕田，孩童沿溪捕魚。黃昏炊煙升起，村莊歸於寧靜。",
    "ru": "Старый мельник каждое утро спускался к реке. Он проверял колесо и слушал воду. Потом он возвращался домой к семье.",
}
KEYWORDS = {
    "mixed": "best kiln kit for you and the best servo deal for you and the best star chart app for you and the best servo deal near me and the kiln kit for you and cheap star chart app for the best servo deal",
    "cycle": "cheap kiln kit for you and the best servo deal " * 20,
    "de": "Schuhe günstig kaufen Schuhe online Schuhe Sale Damen Schuhe Herren Schuhe günstig Sneaker Schuhe online kaufen Sneaker Sale Damen Sneaker günstig kaufen Schuhe Sale Sneaker online Herren Sneaker Sale",
    "zh": "租車價格租車推薦台北租車租車優惠台北租車推薦租車價格便宜租車台北租車價格租車推薦便宜租車優惠台北租車便宜",
    "menu": "Home > Shoes > Men\nHome > Shoes > Women\nHome > Bags\nHome > Sale > Men\nHome > Bags > Leather",
    "long tags": "".join(f'<a href="https://x.test/" title="{"z" * 900}{i}">item</a>\n' for i in range(5)),
}


@pytest.mark.parametrize("corpus", [False, True])
def test_prose_and_keywords_of_any_language(spark, corpus):
    """By themselves, where the corpus teaches nothing, and among pages of other words."""
    rows = [(k + "3", (v + " ") * 3) for k, v in PROSE.items()] + list(PROSE.items()) + [("kw " + k, v) for k, v in KEYWORDS.items()]
    if corpus:
        rows += [(f"c{i}", "另外，有同學問骨架為什麼要乘以二，我畫給你看，這是慣例。The servo settles before you measure it.") for i in range(60)]
        rows += [(f"kw s{i}", f"骨架課程、血脈推薦、骨架推薦、血脈課程、骨架費用{i}、血脈費用、骨架課程") for i in range(30)]
    pages = keyword_pages(spark.createDataFrame(rows, "id string, text string"), key="id", text="text")
    assert {r["id"] for r in pages.filter("spam").collect()} == {k for k, _ in rows if k.startswith("kw ")}


def test_encoding_and_packing(spark, monkeypatch):
    merge = tokenizer("byte_bpe_50k", TOKENIZERS)
    texts = {1: "it's  a test", 2: "", 3: None, 4: "骨架的骨架，骨架", 5: "word " * 3000, 6: "<|endoftext|>", 7: "it's a test"}
    df = spark.createDataFrame([(k, t, 0) for k, t in texts.items()] + [(7, texts[7], 0)], "id long, text string, ids int")
    rows = encode(df, key="id", text="text").collect()
    assert len(rows) == 8 and all(r["ids"] == merge.encode_ordinary(texts[r["id"]] or "") for r in rows)
    # However many words share a count, the lexicon takes as many as it may.
    many = spark.createDataFrame([(1, " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)) + " ")] * 2, "id long, text string")
    seen = {}
    build = Transducer.build
    monkeypatch.setattr(Transducer, "build", staticmethod(lambda words: seen.update(words) or build(words)))
    small = build_lexicon(many, "text", "byte_bpe_50k", TOKENIZERS, words=150)
    monkeypatch.undo()
    assert 60 <= len(seen) <= 150
    assert all(r["ids"] == merge.encode_ordinary(many.first()["text"]) for r in encode(many, key="id", text="text", lexicon=small).collect())
    counted = {bytes(r["word"]): r["n"] for r in count_words(df, "text").collect()}
    assert counted[b" word"] == 2999 and counted[b"'s"] == 3 and counted[b" test"] == 3
    sizes = token_sizes(df, key="id", text="text")
    assert sorted(r["tokens"] for r in sizes.collect()) == sorted(len(r["ids"]) for r in rows)
    assert encode(df.limit(0), key="id", text="text").count() == 0
    total = sum(len(r["ids"]) for r in rows)
    for method in ("best_fit", "buckets"):
        places = pack(sizes, key="id", size="tokens", capacity=100, method=method).collect()
        boxes = defaultdict(list)
        for r in places:
            boxes[r["container_id"]].append((r["offset"], r["token_to"] - r["token_from"]))
        assert sum(n for b in boxes.values() for _, n in b) == total
        assert all(sum(n for _, n in b) <= 100 and max(o + n for o, n in b) <= 100 for b in boxes.values())
        assert {r["id"] for r in places if r["piece_no"] > 1} == {5} and not {r["id"] for r in places} & {2, 3}
    assert pack(sizes.limit(0), key="id", size="tokens", capacity=100).count() == 0
    with pytest.raises(ValueError):
        pack(sizes, key="id", size="tokens", capacity=100, method="x")
