"""Text functions as Column expressions; Arrow functions only where a fold over positions is needed."""

from __future__ import annotations

import hashlib
import html.entities
import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from . import fixed


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``: inside a lambda an expression would run again for every element. Null gives null."""
    return F.element_at(F.transform(F.array(value), lambda x: F.when(x.isNotNull(), use(x))), 1)


def strip_space(text: Column) -> Column:
    """Without white space in Unicode's sense."""
    return F.regexp_replace(text, r"(?U)\s+", "")


def chars(text: Column) -> Column:
    """Code points; an empty text has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def gram_list(text: Column, n: int) -> Column:
    """All substrings of ``n`` code points in order; none where the text is shorter."""
    return bind(chars(text), lambda c: F.when(F.size(c) < n, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(c, i, n), ""))))


def grams(text: Column, n: int) -> Column:
    """Set of n-grams without white space; a shorter text is its own gram, a blank one has none."""
    return bind(strip_space(text), lambda s: F.when(s == "", F.array().cast("array<string>")).when(F.length(s) < n, F.array(s)).otherwise(F.array_distinct(gram_list(s, n))))


def containment(candidate: Column, source: Column, n: int = 2) -> Column:
    """Share of the candidate's n-grams that the source has; 0 for a blank candidate, null for null."""
    return bind(grams(candidate, n), lambda a: F.when(F.size(a) <= 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, grams(source, n))) / F.size(a)))


def agreement(a: Column, b: Column, n: int = 2) -> Column:
    """The lesser containment of both directions."""
    return F.least(containment(a, b, n), containment(b, a, n))


def coverage(candidate: Column, source: Column, n: int = 3) -> Column:
    """Share of the candidate's n-gram occurrences, Han characters only, that the source contains; 0 without any."""
    han = lambda c: F.regexp_replace(c, "[^一-鿿]", "")
    return bind(gram_list(han(candidate), n), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(bind(grams(han(source), n), lambda s: F.size(F.filter(g, lambda x: F.array_contains(s, x)))) / F.size(g)))


def strip_markdown(text: Column) -> Column:
    """Plain text of markdown: bold, code, headings and bullets lose their marks, white space becomes one blank."""
    for pattern, to in fixed.MARKDOWN:
        text = F.regexp_replace(text, pattern, to)
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def split_long(text: Column, most: int) -> Column:
    """Pieces of at most ``most`` code points: sentences packed greedily, a longer sentence cut hard."""
    empty = F.array().cast("array<string>")
    zero = F.struct(empty.alias("done"), F.lit("").alias("open"))

    def step(state: Column, sentence: Column) -> Column:
        done, open_ = state["done"], state["open"]
        fits = F.length(open_) + F.length(sentence) <= most
        closed = F.when(open_ == "", done).otherwise(F.concat(done, F.array(open_)))
        count = F.greatest(F.ceil(F.length(sentence) / most).cast("int"), F.lit(1))
        pieces = F.transform(F.sequence(F.lit(0), count - 1), lambda i: sentence.substr(i * most + 1, F.lit(most)))
        long = F.length(sentence) > most
        return F.struct(
            F.when(long, F.concat(closed, F.slice(pieces, F.lit(1), count - 1))).when(fits, done).otherwise(closed).alias("done"),
            F.when(long, F.element_at(pieces, -1)).when(fits, F.concat(open_, sentence)).otherwise(sentence).alias("open"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["open"] == "", state["done"]).otherwise(F.concat(state["done"], F.array(state["open"])))

    packed = F.aggregate(F.split(text, "(?<=[。！？；])"), zero, step, finish)
    return F.when(F.length(text) <= most, F.array(text)).otherwise(packed)


def content_sha(text: Column) -> Column:
    """First 16 hex digits of the text's SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def cer(hypothesis: Column, reference: Column) -> Column:
    """Character error rate: edits by the reference's length; 0 if both are empty, 1 if only the reference is."""
    return F.when(F.length(reference) == 0, F.when(F.length(hypothesis) == 0, 0.0).otherwise(1.0)).otherwise(F.levenshtein(hypothesis, reference) / F.length(reference))


def _numbered(piece: Column) -> Column:
    """The character of a numbered reference behind its ampersand; null where there is none. The numbers of C1 stand for Windows-1252, as browsers read them."""
    digits = F.regexp_extract(piece, r"^#([0-9]+|[xX][0-9A-Fa-f]+);?", 1)
    hexadecimal = F.lower(digits.substr(1, 1)) == "x"
    number = F.when(hexadecimal, F.conv(digits.substr(F.lit(2), F.length(digits)), 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("decimal(20,0)")
    bad = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    void = number.between(1, 8) | number.between(14, 31) | number.isin(11, 127) | number.between(0xFDD0, 0xFDEF) | (number % 65536 >= 0xFFFE)
    # Four bytes of UTF-32 spell any code point.
    char = F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), "UTF-32")
    c1 = [chr(n) for n in range(0x80, 0xA0)]
    char = F.translate(char, "".join(c1), "".join(bytes([ord(c)]).decode("cp1252", "ignore") or c for c in c1))
    return F.when(digits != "", F.when(bad, "\ufffd").when(void, "").otherwise(char))


def unescape(text: Column) -> Column:
    """Character references by number and by name, each resolved once; names are those of the standard library's table, with their semicolon or, where it has them so, without."""
    table = F.from_json(F.lit(json.dumps(html.entities.html5)), "map<string,string>")
    bare = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))

    def resolved(piece: Column) -> Column:
        full, prefix = F.regexp_extract(piece, "^[^\t\n\f <&#;]{1,32};", 0), F.regexp_extract(piece, f"^(?:{'|'.join(bare)})", 0)
        name = F.when(F.map_contains_key(table, full), full).otherwise(prefix)
        rest = lambda taken: piece.substr(F.length(taken) + 1, F.length(piece))
        number = F.concat(_numbered(piece), rest(F.regexp_extract(piece, r"^#(?:[0-9]+|[xX][0-9A-Fa-f]+);?", 0)))
        return F.coalesce(number, F.when(name != "", F.concat(F.try_element_at(table, name), rest(name))), F.concat(F.lit("&"), piece))

    # Every piece but the first begins behind an ampersand.
    whole = lambda pieces: F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolved), ""))
    return F.when(F.contains(text, F.lit("&")), bind(F.split(text, "&", -1), whole)).otherwise(text)


def clean_caption(text: Column) -> Column:
    """A caption's text without tags and character references, white space as one blank."""
    text = F.trim(F.regexp_replace(text, "<[^>]+>", ""))
    return unescape(F.regexp_replace(text, r"(?U)\s+", " "))


def clock(seconds: Column) -> Column:
    """hh:mm:ss of whole seconds."""
    whole = F.floor(seconds).cast("int")
    return F.format_string("%02d:%02d:%02d", F.floor(whole / 3600).cast("int"), (F.floor(whole / 60) % 60).cast("int"), whole % 60)


def clock_seconds(text: Column) -> Column:
    """Seconds of hh:mm:ss.mmm."""
    part = lambda i: F.regexp_extract(text, r"(\d+):(\d{2}):(\d{2})[.,](\d{3})", i).cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000.0


def deep_link(url: Column, seconds: Column) -> Column:
    return F.concat(url, F.lit("&t="), F.floor(seconds).cast("int").cast("string"), F.lit("s"))


def referential_phrases(text: Column) -> Column:
    """Sorted distinct phrases that point outside the text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("(" + "|".join(fixed.REFERENTIAL) + ")"), 1)))


def named_entities(text: Column) -> Column:
    """Distinct titles, numbers, Chinese numbers before a unit, and years."""
    units, digits = "|".join(fixed.UNITS), fixed.CJK_DIGITS
    found = [
        F.regexp_extract_all(text, F.lit("《([^》]{1,30})》"), 1),
        F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), 1),
        F.regexp_extract_all(text, F.lit(f"([{digits}]{{1,8}})(?=(?:{units}))"), 1),
        F.regexp_extract_all(text, F.lit(rf"((?:\d{{2,4}}|[{digits}]{{1,6}})年)"), 1),
    ]
    return F.array_distinct(F.concat(*found))


def number_variants(entity: Column) -> Column:
    """The entity and, for one digit, its other ways of writing."""
    table = F.create_map(*[x for k, v in fixed.number_forms().items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    return F.coalesce(F.try_element_at(table, entity), F.array(entity))


def unsupported_entities(candidate: Column, source: Column) -> Column:
    """Sorted entities of the candidate none of whose forms the source has."""
    table = F.create_map(*[x for k, v in fixed.number_forms().items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    return bind(strip_space(source), lambda s: F.array_sort(F.filter(named_entities(candidate), lambda e: ~F.exists(F.coalesce(F.try_element_at(table, e), F.array(e)), lambda w: F.contains(s, w)))))


def raw_hash(cues: Column) -> Column:
    """SHA-256 over cues (array of struct index, t_start, t_end, text) in the order of index."""
    return F.sha2(F.array_join(F.transform(F.array_sort(cues), lambda c: F.concat(F.format_string("%d|%.3f|%.3f|", c["index"], c["t_start"], c["t_end"]), c["text"], F.lit("\n"))), ""), 256)


def fingerprint(*parts: Column) -> Column:
    """16 hex digits over the parts; a null part is no hit for anything, so the result is null."""
    return F.when(~F.greatest(*[p.isNull() for p in parts], F.lit(False)), F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 16))


def params_hash(params: dict) -> str:
    """16 hex digits over the parameters, whatever their order."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def terms(text: Column, least: int = 2, most: int = 12, limit: int = 60) -> Column:
    """Terms between punctuation, in order of first occurrence."""
    parts = F.split(text, r"[\s，、。；：:;,.（）()【】「」|/]+")
    return F.slice(F.array_distinct(F.filter(parts, lambda t: F.length(t).between(least, most))), 1, limit)


def han_runs(text: Column, least: int = 3, most: int = 12) -> Column:
    """Distinct runs of Han characters of the given lengths."""
    return F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit("([一-鿿]+)"), 1), lambda t: F.length(t).between(least, most)))


def convert_script(text: Column, table: dict[str, str], where: Column | None = None) -> Column:
    """Text with characters exchanged one for one, only where the condition holds: speech is converted, captions by hand are not."""
    converted = F.translate(text, "".join(table), "".join(table.values()))
    return converted if where is None else F.when(where, converted).otherwise(text)


def script_ratio(text: Column, simplified: str) -> Column:
    """Share of the Han characters that are of the simplified ones given; 0 without any Han character."""
    han = F.length(F.regexp_replace(text, "[^一-鿿]", ""))
    return F.when(han > 0, F.length(F.regexp_replace(text, f"[^{simplified}]", "")) / han).otherwise(F.when(text.isNotNull(), 0.0))


def differing(a: Column, b: Column) -> Column:
    """Number of places at which two texts of one length differ."""
    return F.size(F.filter(F.zip_with(chars(a), chars(b), lambda x, y: x != y), lambda d: d))


def _shared_start(a: Column, b: Column) -> Column:
    """Number of leading elements that two arrays share."""
    n = F.least(F.size(a), F.size(b))
    return F.coalesce(F.nullif(F.array_position(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x == y), False), F.lit(0)) - 1, n).cast("int")


def changed_stretch(before: Column, after: Column) -> tuple[Column, Column]:
    """What lies between the longest common start and, behind it, the longest common end of two texts."""
    start = _shared_start(chars(before), chars(after))
    tail = lambda c: F.reverse(F.slice(chars(c), start + 1, F.length(c)))
    end = _shared_start(tail(before), tail(after))
    middle = lambda c: F.substr(c, start + 1, F.length(c) - start - end)
    return middle(before), middle(after)


def sound_coverage(candidate: Column, source: Column, sounds: dict[str, str], n: int = 3) -> Column:
    """:func:`coverage` over one sign for each sound: what is said alike counts as alike. Characters without a sound stand for themselves."""
    signs = {k: chr(0x4E00 + i) for i, k in enumerate(sorted(set(sounds.values())))}
    said = lambda c: F.translate(c, "".join(sounds), "".join(signs[v] for v in sounds.values()))
    return coverage(said(candidate), said(source), n)


def token_similarity(a: Column, b: Column, sounds: dict[str, str] | None = None) -> Column:
    """1 - edits / greater length over sounds: each character gives way to one that stands for its sound, others to lower case.

    sounds maps characters to a key of their sound; characters of one key count as
    equal. Without it characters stand for themselves. Both empty: 1; one empty: 0.
    """

    def key(text: Column) -> Column:
        text = F.lower(text)
        if sounds:
            keys = {k: chr(0xF0000 + i) for i, k in enumerate(sorted(set(sounds.values())))}
            text = F.translate(text, "".join(sounds), "".join(keys[v] for v in sounds.values()))
        return text

    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).when(F.least(F.length(a), F.length(b)) == 0, 0.0).otherwise(1 - F.levenshtein(key(a), key(b)) / longest)


def rejection(before: Column, after: Column, sounds: dict[str, str] | None = None) -> Column:
    """Why a correction isn't allowed (case, insertion, rewrite), or null; the first reason counts."""
    inserted = F.length(after) - F.length(before)
    return (
        F.when(F.lower(before) == F.lower(after), "case")
        .when((before != "") & F.contains(after, before) & (inserted > 2), "insertion")
        .when(token_similarity(before, after, sounds) < 0.35, "rewrite")
    )


def quota_limit(message: Column) -> Column:
    """The daily limit that an error message names, or null."""
    value = F.regexp_extract(message, r"['\"]quotaValue['\"]:\s*['\"](\d+)['\"]", 1)
    limit = F.regexp_extract(message, r"limit:\s*(\d+)", 1)
    return F.when(F.contains(message, F.lit("PerDay")), F.coalesce(F.nullif(value, F.lit("")), F.nullif(limit, F.lit("")))).cast("int")


def status_code(message: Column) -> Column:
    """The status that an error message begins with or names as 'code'."""
    code = F.coalesce(F.nullif(F.regexp_extract(message, r"^(\d{3}) ", 1), F.lit("")), F.nullif(F.regexp_extract(message, r"'code': (\d{3})", 1), F.lit("")))
    return code.cast("int")


# -- Arrow functions ---------------------------------------------------------------


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points end to end, offsets, one more than texts)."""
    cps = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return cps, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _starts(at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, position) of every window of ``size`` characters, by text."""
    count = np.maximum(np.diff(at) - size + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    return text, np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + at[:-1][text]


def longest_common(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common substring of each pair.

    All pairs look for their length together, doubling it from eight on and then halving what is
    left: the windows of a pair's present length are compared by hashes, those of equal hash
    character by character.
    """
    pairs, odd = len(left), np.uint64(0x9E3779B97F4A7C15)
    (a, a_at), (b, b_at) = _flat(left), _flat(right)
    cps = np.concatenate([a, b])
    powers = np.cumprod(np.full(len(cps) + 1, odd, np.uint64)) if len(cps) else np.ones(1, np.uint64)
    mixed = (cps.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:-1])])
    lo, hi = np.zeros(pairs, np.int64), np.minimum(np.diff(a_at), np.diff(b_at))
    doubling = np.ones(pairs, bool)
    while (lo < hi).any():
        size = np.where(doubling, np.minimum(np.maximum(2 * lo, 8), hi), (lo + hi + 1) >> 1)
        live = lo < hi
        asked = np.where(live, size, len(cps) + 1)
        sides = []
        for at, base in ((a_at, 0), (b_at, len(a))):
            pair, position = _starts(at, asked)
            position = position + base
            stop = position + size[pair]
            hashed = (sums[stop] - sums[position]) * powers[len(cps) - position]
            sides.append((pair, position, hashed ^ (pair.astype(np.uint64) * odd)))
        (pa, wa, ha), (pb, wb, hb) = sides
        order = np.argsort(hb)
        at = np.searchsorted(hb[order], ha)
        near = order[np.minimum(at, max(len(hb) - 1, 0))] if len(hb) else np.zeros(0, np.int64)
        hit = np.flatnonzero((hb[near] == ha) & (pb[near] == pa)) if len(hb) else near
        first = np.unique(pa[hit], return_index=True)[1] if len(hit) else hit
        found = np.zeros(pairs, bool)
        for i in hit[first]:
            p = pa[i]
            same = (cps[wa[i] : wa[i] + size[p]] == cps[wb[near[i]] : wb[near[i]] + size[p]]).all()
            found[p] = same or a[a_at[p] : a_at[p + 1]].tobytes() != b"" and _holds(left[p], right[p], int(size[p]))
        lo, hi, doubling = np.where(live & found, size, lo), np.where(live & ~found, size - 1, hi), doubling & found
    return lo


def _holds(left: str, right: str, size: int) -> bool:
    """Whether two texts have a substring of that length in common; asked where two different windows have one hash."""
    seen = {left[i : i + size] for i in range(len(left) - size + 1)}
    return any(right[i : i + size] in seen for i in range(len(right) - size + 1))


#: Characters of a batch that the substring search holds at once; a longer pair is taken alone.
PAIR_CHARS = 1 << 20


@F.pandas_udf(DoubleType())
def common_substring_ratio(candidate: pd.Series, source: pd.Series) -> pd.Series:
    """Longest common substring by the candidate's length, white space removed; 0 if either is blank, null if either is null."""
    known = candidate.notna() & source.notna()
    left, right = (x[known].str.replace(r"\s+", "", regex=True) for x in (candidate, source))
    total = (left.str.len() + right.str.len()).cumsum()
    found = [longest_common(l.tolist(), right[l.index].tolist()) for _, l in left.groupby(total // PAIR_CHARS)]
    out = pd.Series(np.nan, candidate.index, dtype="float64")
    out[known] = np.concatenate(found) / np.maximum(left.str.len(), 1) if found else 0.0
    return out.astype(object).where(known, None)


def _gram_keys(texts: list[str]) -> np.ndarray:
    """Sorted distinct (text, bigram) as integers; a text of one character is its own gram."""
    cps, at = _flat(texts)
    gram = np.append(cps.astype(np.int64) << 21, 0)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    inside = np.append(text[1:] == text[:-1], False)[: len(cps)]
    gram[:-1][inside] |= cps[1:][inside[: len(cps) - 1]]
    alone = np.diff(at)[text] == 1
    return np.unique((text << 42 | gram[:-1])[inside | alone])


@F.pandas_udf(ArrayType(DoubleType()))
def containments(candidate: pd.Series, first: pd.Series, second: pd.Series, third: pd.Series) -> pd.Series:
    """The share of the candidate's bigrams that each of three sources has, all from one pass over the candidate's; 0 for a blank candidate or source, null for null."""
    plain = lambda x: x.fillna("").str.replace(r"\s+", "", regex=True).tolist()
    out = np.empty((len(candidate), 3), object)
    step = 1 << 20  # texts that 21 bits can number
    for start in range(0, len(candidate), step):
        rows = slice(start, start + step)
        mine = _gram_keys(plain(candidate[rows]))
        count = len(candidate[rows])
        total = np.maximum(np.bincount(mine >> 42, minlength=count), 1)
        for i, source in enumerate((first, second, third)):
            shared = np.intersect1d(mine, _gram_keys(plain(source[rows])), assume_unique=True)
            out[rows, i] = np.bincount(shared >> 42, minlength=count) / total
            out[rows, i][(candidate.isna() | source.isna())[rows].to_numpy()] = None
    return pd.Series(list(out), candidate.index, dtype=object)


def _every(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def symbol_entities(text: Column) -> Column:
    """Sorted symbol-like entities (functions, sizes, subscripts); earlier kinds claim their characters.

    What a kind has claimed is replaced by a mark for the kinds after it: one that later
    patterns can't match, and that counts as a digit where it stood for one.
    """
    function, size, subscript, plain = fixed.SYMBOLS
    beside = plain.replace(r"[A-Za-z\d]", r"[A-Za-z\d\x01]").replace(r"[\d.]", r"[\d.\x01]")

    def rest(after_functions: Column) -> Column:
        def later(after_sizes: Column) -> Column:
            return F.concat(_every(after_sizes, subscript), _every(F.regexp_replace(after_sizes, subscript, "\x02"), beside))

        return F.concat(_every(after_functions, size), bind(F.regexp_replace(after_functions, size, "\x01"), later))

    found = F.concat(_every(text, function), bind(F.regexp_replace(text, function, "\x02"), rest))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.trim(x))))


def _spoken(digits: Column) -> Column:
    return F.translate(digits, "0123456789", fixed.DIGIT_NAMES)


def symbol_forms(symbol: Column) -> Column:
    """Ways of writing a symbol, without blanks: as it is, with plain digits, sizes said or multiplied, digits said."""
    plain = F.translate(F.translate(symbol, fixed.SUBSCRIPTS[0], fixed.SUBSCRIPTS[1]), " ", "")
    part = lambda pattern, i: F.regexp_extract(plain, pattern, i)
    rows, cols = (part(r"^(\d{1,3})\s*[x×]\s*(\d{1,3})$", i) for i in (1, 2))
    letter, number = (part(r"^([A-Za-z])(\d{1,3})$", i) for i in (1, 2))
    # Words between the sides of a size, written and said.
    sizes = [F.concat(rows, F.lit(by), cols) for by in ("x", "×", "乘", "乘以")] + [F.concat(_spoken(rows), F.lit(by), _spoken(cols)) for by in ("x", "乘", "乘以")]
    none = F.array().cast("array<string>")
    return F.concat(
        F.array(F.translate(symbol, " ", ""), plain, F.translate(plain, "_", "")),
        F.when(rows != "", F.array(*sizes)).otherwise(none),
        F.when(letter != "", F.array(F.concat(letter, _spoken(number)))).otherwise(none),
    )


def unsupported_symbols(candidate: Column, source: Column) -> Column:
    """Sorted symbols of the candidate none of whose forms the source has, with its own digits or plain ones; null for a null candidate."""
    both = bind(strip_space(F.coalesce(source, F.lit(""))), lambda s: F.array(s, F.translate(s, fixed.SUBSCRIPTS[0], fixed.SUBSCRIPTS[1])))
    return bind(both, lambda texts: F.filter(symbol_entities(candidate), lambda e: ~F.exists(symbol_forms(e), lambda f: F.contains(texts[0], f) | F.contains(texts[1], f))))


def replace_unprotected(text: str, before: str, after: str) -> str:
    """Replace ``before`` except where it lies within an ``after`` that is already there."""
    if not before:
        return text
    if before not in after:
        return text.replace(before, after)
    spans = [m.span() for m in re.finditer(re.escape(after), text)]
    keep = lambda m: any(a <= m.start() and m.end() <= b for a, b in spans)
    return re.sub(re.escape(before), lambda m: before if keep(m) else after, text)


@F.pandas_udf(StringType())
def replace_outside(text: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else replace_unprotected(t, b or "", a or "") for t, b, a in zip(text, before, after)], dtype=object)


@F.pandas_udf(StringType())
def apply_corrections(raw: pd.Series, befores: pd.Series, afters: pd.Series) -> pd.Series:
    """The raw text with every correction whose ``before`` it holds, in order; null without one."""
    out = []
    for text, bs, as_ in zip(raw, befores, afters):
        new = text
        for b, a in zip(bs if bs is not None else [], as_ if as_ is not None else []):
            if text is not None and b and b in text:
                new = replace_unprotected(new, b, a)
        out.append(new if new != text else None)
    return pd.Series(out, dtype=object)
