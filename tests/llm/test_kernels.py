import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from cuegrain.llm.canon import base_map, look_map
from cuegrain.llm.flat import FlatText, chunks
from cuegrain.llm.lexicon import PATTERN, TOKENIZERS, Encoder, Transducer, tokenizer, word_starts
from cuegrain.llm.minmax import shingle_sets, signatures
from cuegrain.llm.nearest import bisect_slices
from cuegrain.llm.packing import best_fit_plan, bucket_bounds, bucket_plan
from cuegrain.llm.repeats import repeated_shares, window_hashes
from cuegrain.llm.split import boundary_strengths, cut_points
from cuegrain.llm.stuffing import PASSAGE, Clauses, Learned, Pages, SuffixAutomaton, _hashes_in_order, _in_order, copied_passages, covered_symbols, units

HARD = ["", "'s", "it's we'll  x", " 's", "''s", "'re's", "\n's x", "  \n  y", "x  ", " a", "a　　b", "'l l", "'sfoo bar", "I'D i'd", "１２3 ½", "éa", "<|endoftext|>", "😀've", "x'", "'ll", "͸ a͸'s", "\x1cs \x85 t"]


def some_texts(seed, alphabet, count=60, longest=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(count)]


def test_flat_text_and_chunks():
    column = pa.array(["ab", None, "日😀", ""])
    flat = FlatText(column.slice(0))
    assert flat.at.tolist() == [0, 2, 2, 4, 4] and [chr(c) for c in flat.cps] == list("ab日😀")
    assert FlatText(column.slice(2)).at.tolist() == [0, 2, 2]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, "y", "z" * 3, None])], ["t"])
    assert [c.num_rows for c in chunks(batch, 0, 4)] == [1, 3]
    assert list(chunks(batch.slice(0, 0), 0)) == []


def test_split_equals_plain_version():
    texts = some_texts(1, "甲乙丙丁戊己庚。！？」』，、: .\nab", longest=2600) + ["x" * 2000, "", "。" * 1200, "字" * 501, "a. " * 400]
    flat = FlatText(pa.array(texts))
    row, number, start, stop = cut_points(boundary_strengths(flat.cps, flat.at), flat.at, 500, 250, 50)
    got = sorted(zip(row.tolist(), number.tolist(), start.tolist(), stop.tolist()))
    assert got == sorted((i, *p) for i, t in enumerate(texts) if t for p in brute.pieces(t))


def test_repeats_equal_plain_version():
    texts = some_texts(2, "甲乙 ，a", longest=300) + ["", "abc", "同一句話同一句話再說一次吧" * 30, "a" * 5000, "①²½" * 50]
    flat = FlatText(pa.array(texts))
    kept, repeated = repeated_shares(flat, 12)
    assert list(zip(kept.tolist(), repeated.tolist())) == [brute.repeated(t) for t in texts]
    cps = FlatText(pa.array(["abcabcabc"])).cps
    for n in range(1, 9):
        hashes = window_hashes(cps, n)
        assert len(hashes) == 10 - n and (n > 6 or hashes[0] == hashes[3])


def test_suffix_automaton_equals_all_substrings():
    texts = [*some_texts(3, "abc", 30, 60), "", "a", "aaaa", "標籤一 標籤二 標籤一", "abab" * 9]
    flat = FlatText(pa.array(texts))
    got = SuffixAutomaton(flat.cps, flat.at).longest_repeats()
    assert got.tolist() == [n for t in texts for n in brute.longest_repeats(t)]
    assert SuffixAutomaton(flat.cps[:0], np.zeros(3, np.int64)).longest_repeats().tolist() == []


def test_coverage_and_copies():
    pages = Pages.of(["see https://a.test/x and https://b.test/y", "no 12 no 345 no 6", "", "one https://c.test/z"])
    assert [chr(c) for c in pages.symbols[: pages.at[1]]] == list("see \ue000 and \ue000") and pages.shown[4] == len("https://a.test/x")
    inside = covered_symbols(pages)
    assert inside[4] and inside[10] and not inside[pages.at[3] :].any()
    passage = "The miller walked down to the river. There he listened to the water."
    copies = Pages.of([passage + " " + passage, "kiln kit servo deal " * 9, "x" * 30 + passage])
    source = copied_passages(copies)
    later = np.flatnonzero(source != np.arange(len(source)))
    assert later.tolist() == list(range(len(passage) + 1, 2 * len(passage) + 1)) and (later - source[later] == len(passage) + 1).all()
    assert len(passage) > PASSAGE


def test_units_and_learned_weights():
    pages = Pages.of(["It's 骨架 it's", "骨"])
    at, ids = units(pages.symbols, pages.at)
    assert at.tolist() == [0, 5, 6, 8, 12] and ids[0] == ids[3] and ids[1] == ids[4] != ids[2]
    known = Learned.from_counts(np.array([7, 3]), np.array([90, 0]), np.array([0, 40]), 100, 50)
    weight, sure = known.of(np.array([3, 7, 5]))
    assert weight[0] < -1 < 1 < weight[1] and weight[2] == sure[2] == 0 and sure[1] == 90 / 110
    nothing = Learned.from_counts(np.array([7]), np.array([9]), np.array([0]), 10, 0)
    assert abs(nothing.of(np.array([7]))[0][0]) < 1e-9
    assert Clauses.of(["", ""]).features.shape == (0, 13)


def test_fitting_separates():
    from cuegrain.llm.fit_stuffing import fit

    prose = ["The miller walked down to the river. Then he listened to the water.", "春雨落下，山谷漸漸染綠。農夫清晨牽牛耕田。"] * 20
    lists = ["kiln kit, servo deal, kiln deal, servo kit, kiln kit, servo deal", "租車價格租車推薦租車價格租車優惠租車推薦"] * 20
    first, second = fit(prose + lists, lambda c: c.page >= len(prose))
    c = Clauses.of(prose + lists)
    assert ((c.features @ first > 0) == (c.page >= len(prose))).all() and len(second) == 15
    with pytest.raises(ValueError):
        fit([""] * 2001, len)


def test_words_equal_the_pattern():
    import regex

    pattern = regex.compile(PATTERN)
    texts = HARD + some_texts(4, "'sdtmrevl  \n　 aB１2,!甲é", 200, 40)
    flat = FlatText(pa.array(texts))
    starts, strange = word_starts(flat)
    for i, text in enumerate(texts):
        if i not in strange and "\x1c" not in text:
            here = starts[(starts >= flat.at[i]) & (starts < flat.at[i + 1])] - flat.at[i]
            assert here.tolist() == [m.start() for m in pattern.finditer(text)], text


def test_transducer_and_encoder(tmp_path):
    merge = tokenizer("byte_bpe_50k", TOKENIZERS)
    words = [b"a", b"ab", b"abc", b"tion", b"nation", b"station", " 甲乙".encode(), b" ", b"x" * 48]
    built = Transducer.build({w: merge._encode_single_piece(w) for w in words})
    (tmp_path / "t.bin").write_bytes(built.to_bytes())
    mapped = Transducer.mapped(str(tmp_path / "t.bin"))
    asked = [*words, b"abcd", b"b", b"nat", b"x" * 49]
    ends = np.cumsum([len(w) for w in asked])
    ranks = mapped.ranks(np.frombuffer(b"".join(asked), np.uint8), ends - [len(w) for w in asked], ends)
    assert sorted(words) == [w for _, w in sorted((r, w) for r, w in zip(ranks.tolist(), asked) if r >= 0)]
    assert (ranks[len(words) :] == -1).all()
    shared = Transducer.build({w: [1] for w in (b"tap", b"taps", b"top", b"tops")})
    assert len(shared.final) == 5  # start, t, a|o shared, p, s
    texts = [*HARD, None] + some_texts(5, "the cat nation甲乙，。 '\n😀é", 50, 80)
    for lexicon in (built, Transducer.build({})):
        encoder = Encoder(lexicon, "byte_bpe_50k", TOKENIZERS)
        flat = FlatText(pa.array(texts, pa.string()))
        ids, at = encoder.ids(flat)
        expected = [merge.encode_ordinary(t or "") for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == expected
        assert encoder.sizes(flat).tolist() == [len(x) for x in expected]


def check_plan(plan, histogram, capacity):
    used, columns = {}, plan.arrays()
    for size, n in histogram.items():
        rows = [i for i in range(len(columns["size"])) if columns["size"][i] == size]
        for r in range(n):
            i = max((i for i in rows if columns["lo"][i] <= r), key=lambda i: columns["lo"][i])
            slot = r - columns["lo"][i] + columns["skip"][i]
            place = columns["offset"][i] + slot % columns["per"][i] * columns["stride"][i]
            used.setdefault(int(columns["first"][i] + slot // columns["per"][i]), []).append((int(place), size))
    assert set(used) == set(range(plan.containers))
    for items in used.values():
        items.sort()
        assert items[-1][0] + items[-1][1] <= capacity
        assert all(a + s <= b for (a, s), (b, _) in zip(items, items[1:]))
    return sum(map(len, used.values()))


def test_plans_fit_and_fill():
    rng = random.Random(6)
    for _ in range(60):
        histogram = {rng.randrange(1, 101): rng.randrange(1, 40) for _ in range(rng.randrange(1, 30))}
        total = sum(s * n for s, n in histogram.items())
        best, buckets = best_fit_plan(histogram, 100), bucket_plan(histogram, 100, 5)
        for plan in (best, buckets):
            assert check_plan(plan, histogram, 100) == sum(histogram.values())
        halves = sum(n for s, n in histogram.items() if s > 50)
        assert max(-(-total // 100), halves) <= best.containers <= 11 * max(-(-total // 100), halves) // 9 + 2
    assert best_fit_plan({}, 100).containers == 0 == bucket_plan({}, 100, 4).containers


def test_bucket_bounds_are_optimal():
    from itertools import combinations

    rng = random.Random(7)
    for _ in range(40):
        histogram = {rng.randrange(1, 60): rng.randrange(1, 20) for _ in range(rng.randrange(1, 9))}
        sizes = sorted(histogram)
        padding = lambda bounds: sum((min(b for b in bounds if b >= s) - s) * n for s, n in histogram.items())
        best = min(padding([*c, sizes[-1]]) for k in range(3) for c in combinations(sizes[:-1], k))
        got = bucket_bounds(histogram, 3)
        assert len(got) <= 3 and got == sorted(got) and got[-1] == sizes[-1] and padding(got) == best


def test_min_max_signatures_estimate_similarity():
    texts = ["甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥" * 2, "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥" + "甲乙丙丁戊己庚辛壬癸"]
    grams, at = shingle_sets(FlatText(pa.array(texts)), 3)
    a, b = (set(grams[at[i] : at[i + 1]].tolist()) for i in (0, 1))
    s = signatures(grams, at, 600)
    assert abs((s[0] == s[1]).mean() - len(a & b) / len(a | b)) < 0.06
    assert shingle_sets(FlatText(pa.array(["ab", ""])), 3)[1].tolist() == [0, 0, 0]


def test_look_map_keeps_what_counts(spark):
    m = look_map()
    seen = {"Ａ": "A", "\u3000": " ", "\u200b": "", "а": "a", "⼼": "心", "\uf901": "更", "µ": "μ", "ﾞ": "゙", "\u00a0": " ", "\ufeff": ""}
    seen |= {"Ꭺ": "A", "օ": "o", "𝐀": "A", "ℓ": "l", "Ё": "Ë", "ό": "ó", "ὀ": "o\u0313", "″": '"', "՝": "'", "ʼ": "'", "٠": None, "۔": "-"}
    assert {k: m.get(k) for k in seen} == seen
    assert not set("²①é简A\nıøノー一口ロ〇IΩ") & set(m)
    assert m["Ι"] == "I" and m["ⅼ"] == "l" and m["𝟏"] == "1"  # case and kind stay
    base = base_map()
    assert base["é"] == "e" and base["ガ"] == "カ" and base["\u0301"] == "" and base["ὀ"] == "o"
    assert base["각"] == "ᄀ" == base["ㄱ"] and base["ᅡ"] == base["ᆨ"] == "" and "ᄀ" not in base  # syllables and their parts
    assert base["\u09cb"] == base["\u09c7"] == base["\u09be"] == ""


def test_vectorised_bisection():
    times = np.array([1.0, 2, 2, 5, 0, 7, 9])
    lo, hi = np.array([0, 0, 0, 4, 4, 3]), np.array([4, 4, 4, 7, 7, 3])
    assert bisect_slices(times, lo, hi, np.array([2.0, 6, 0, 7, 8, 1])).tolist() == [1, 4, 0, 5, 6, 3]


def test_bad_parameters():
    from cuegrain.llm.split import split_oversized

    with pytest.raises(ValueError):
        split_oversized(None, key="k", text="t", t_start="a", t_end="b", limit=10, least=10)


def test_pages_shorter_than_a_passage():
    for texts in (["short page one", "short page two"], ["", "word word word word"] * 3):
        c = Clauses.of(texts)
        alone = [Clauses.of([t]) for t in texts]
        assert c.by_page(c.shown).tolist() == [int(x.shown.sum()) for x in alone]
        assert c.by_page(c.covered).tolist() == [int(x.covered.sum()) for x in alone]


def test_few_symbols_go_through_argsort(monkeypatch):
    """Keys and places are sorted as one word, which is much cheaper; hashes that agree in their first bits are told apart."""
    texts = some_texts(8, "the cat nation甲乙丙丁，。 ", 60, 400)
    sizes, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *rest, **more: (sizes.append(len(a)), argsort(a, *rest, **more))[1])
    Clauses.of(texts).teach()
    assert sum(sizes) <= sum(map(len, texts))  # once for the units
    monkeypatch.undo()
    for hashes in ([5, 3, 4, 3, -1, -2, -1], [2**62, -(2**62), 0, 2**62], [], [7]):
        ordered, place = _hashes_in_order(np.array(hashes, np.int64))
        assert ordered.tolist() == sorted(hashes) and place.tolist() == sorted(range(len(hashes)), key=lambda i: (hashes[i], i))
    for keys in ([2**62, 1, 2**62, 0], [3, 1, 2, 1], []):
        ordered, place = _in_order(np.array(keys, np.int64))
        assert ordered.tolist() == sorted(keys) and place.tolist() == sorted(range(len(keys)), key=lambda i: (keys[i], i))


def test_very_long_texts():
    from time import monotonic

    began = monotonic()
    encoder = Encoder(Transducer.build({}), "byte_bpe_50k", TOKENIZERS)
    for text in ("a-" * 200_000 + "/", "a." * 200_000 + " x/", "骨架血脈經絡" * 50_000, "今天先講骨架，再講血脈。" * 30_000):
        flat = FlatText(pa.array([text]))
        covered = Clauses.of([text])
        assert covered.covered.sum() > 0.9 * covered.shown.sum() or "。" in text
        kept, repeated = repeated_shares(flat, 12)
        assert repeated[0] > 0.9 * kept[0]
        _, _, start, stop = cut_points(boundary_strengths(flat.cps, flat.at), flat.at, 500, 250, 50)
        assert stop[-1] == len(text) and (stop - start).max() <= 500
        ids, at = encoder.ids(flat)
        assert tokenizer("byte_bpe_50k", TOKENIZERS).decode(ids.tolist()) == text and at.tolist() == [0, len(ids)]
    assert monotonic() - began < 60  # nothing is quadratic
