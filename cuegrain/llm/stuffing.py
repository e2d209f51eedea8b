"""Pages of strung-together keywords, links, tags and labels.

Two kinds of evidence are combined for every clause of a page. The first is coverage:
the share of its characters that lie in maximal substrings which the page repeats, from
the page's suffix automaton. Strung-together keywords repeat a few phrases in ever new
order, price labels and menu paths repeat their frame, prose does neither. The second is
clause structure: how much the clause's words and characters are those that the corpus
uses in clauses of little coverage rather than in those of great coverage, learned from
the document frequencies of all pages. No list of words of any language is used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .flat import FlatText, chunks, visible
from .repeats import window_hashes

_MARKUP = re.compile(
    r"<[A-Za-z/!][^<>\n]*>"
    r"|(?:https?://|www\.)[^\s<>\"'()\[\]，。；、｜]+"
    r"|(?<![A-Za-z0-9.-])(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,12}+/[^\s<>\"'()\[\]，。；、｜]*"
    r"|[#＃@＠][^\s#＃@＠,，。;；、]+"
)
#: Every match of the pattern holds one of these; a full stop alone opens none.
_OPENERS = ("<", "/", "www.", "#", "＃", "@", "＠")
_MARK, _DIGIT = 0xE000, 0x30

#: Bits that a character tells about the text: a letter or sign, one of a large script, a number. A substring
#: counts as repeated from twice log2(page length) bits, about the longest repeat that chance gives.
LETTER_BITS, LARGE_BITS, NUMBER_BITS = 2.0, 5.5, 3.0
#: A passage that comes again is so long at least, after at least so many symbols, and has a sign behind a clause of so many units (a word is two).
PASSAGE, PASSAGE_SHIFT, PASSAGE_CLAUSE = 24, 8, 8
#: Pages that the pooled frequency counts for in the learned weights, and the share of pages below which a unit has none.
PRIOR_PAGES, LEAST_SHARE = 20, 0.002
#: A clause teaches from this distance to the first model's threshold on; weights are cut at the second.
TEACHES, STRONGEST = 0.5, 3.0
#: Bytes of text that are taken at once.
BYTES = 1 << 20
#: Runs of at most, or at least, so many words or characters between signs.
SHORT_RUN, LONG_RUN = 6, 40

FEATURES = ["constant"] + [f"{name}{where}" for name in ("cover", "short runs", "long runs", "sentence end", "links and tags", "sentence case") for where in ("", ", with neighbours")]
# Fitted by fit_stuffing.py. FIRST has the columns of FEATURES; SECOND has the mean weight, and that with neighbours, besides.
FIRST = np.array([-1.17, 0.94, 4.61, -0.13, 1.45, -0.91, -1.11, -3.39, 0.15, 2.58, 1.25, -0.37, -0.36])
SECOND = np.array([3.43, 0.62, 2.26, 0.34, 0.01, -0.19, -0.25, -1.58, 1.21, 2.23, 1.59, 0.31, 1.25, -1.69, -2.18])


def _in_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys in ascending order, their places), equal keys by place. Keys are 0 or more.

    Key and place are sorted as one word where they fit into it, which takes a fifth of the time of argsort.
    """
    n = len(key)
    wide = n.bit_length()
    if not n or int(key.max()).bit_length() + wide > 63:
        place = np.argsort(key, kind="stable")
        return key[place], place
    word = (key << wide) | np.arange(n)
    word.sort()
    return word >> wide, word & ((1 << wide) - 1)


def _hashes_in_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for int64 hashes: their first bits are sorted, and where those of different hashes agree the whole."""
    low = (1 << len(key).bit_length()) - 1
    word = (key & ~low) | np.arange(len(key))
    word.sort()
    place = word & low
    ordered = key[place]
    if (((word[1:] | low) == (word[:-1] | low)) & (ordered[1:] != ordered[:-1])).any():
        place = np.argsort(key, kind="stable")
        ordered = key[place]
    return ordered, place


class SuffixAutomaton:
    """The suffix automata of many pages at once, in array form.

    A state is a class of substrings with the same ends. Sorted by their reversed
    prefixes, the ends of a state are neighbours, so that states are the intervals of
    that order, a state's longest substring is the common suffix of its interval, and a
    suffix link leads to the enclosing interval. This form needs no table of edges per
    state and is built by doubling ranks, for all pages of a batch in the same sorts;
    a page's size changes nothing but the memory, about 100 bytes a character.
    """

    def __init__(self, symbols: np.ndarray, at: np.ndarray) -> None:
        n = len(symbols)
        self.n = n
        kind = np.int32 if n < 2**31 else np.int64
        self.order = np.empty(n, kind)
        #: By position what stands for the 1, 2, 4, ... symbols from there on: equal where they are.
        self.levels: list[np.ndarray] = []
        if not n:
            return
        page = np.repeat(np.arange(len(at) - 1), np.diff(at))[::-1]
        there = np.zeros(int(symbols.max()) + 1, bool)
        there[symbols] = True
        code = np.cumsum(there)
        many = int(code[-1]) + 1
        symbol = code[symbols][::-1]
        # End (exclusive) of every reversed prefix: where its page begins.
        stop = n - np.repeat(at[:-1], np.diff(at))[::-1]
        single = page * many + symbol
        second = np.zeros(n, np.int64)
        second[:-1] = np.where(page[1:] == page[:-1], symbol[1:], 0)
        pair, place = _in_order(single * many + second)
        rank = np.empty(n, kind)
        rank[place] = self._starts(pair)
        self.levels += [single, rank]
        width, active = 2, self._shared(pair, place)
        while len(active):
            beyond = active + width
            second = np.where(beyond < stop[active], rank[np.minimum(beyond, n - 1)] + 1, 0)
            pair, sort = _in_order(rank[active].astype(np.int64) * (n + 1) + second)
            place = active[sort]
            first = rank[place]
            rank = rank.copy()
            rank[place] = first + self._starts(pair) - self._starts(first)
            self.levels.append(rank)
            active = self._shared(pair, place)
            width *= 2
        self.order[rank] = np.arange(n, dtype=kind)

    @staticmethod
    def _starts(ordered: np.ndarray) -> np.ndarray:
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))

    @staticmethod
    def _shared(ordered: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Places whose rank isn't theirs alone, by rank."""
        same = ordered[1:] == ordered[:-1]
        return place[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(place) else place

    def longest_repeats(self) -> np.ndarray:
        """For every position the length of the longest substring ending there that its page holds more than once."""
        n = self.n
        if n < 2:
            return np.zeros(n, np.int64)
        a, b = self.order[:-1], self.order[1:]
        common = np.zeros(n - 1, np.int64)
        # Neighbours that agree on a level's width, from the narrowest on; then their common part from the widest back.
        ordered = self.levels[0][self.order]
        pairs = np.flatnonzero(ordered[1:] == ordered[:-1])
        agreeing = []
        for rank in self.levels[1:]:
            wider = rank[a[pairs]] == rank[b[pairs]]
            agreeing.append((pairs[~wider], pairs[wider]))
            pairs = pairs[wider]
        agreeing.append((pairs, pairs[:0]))
        # Those that agree on no wider level begin with this one's width; the others' common part goes on behind what is known of it.
        for level in range(len(self.levels) - 1, -1, -1):
            rank, (widest, longer) = self.levels[level], agreeing[level]
            common[widest] = 1 << level
            left, right = a[longer] + common[longer], b[longer] + common[longer]
            inside = np.flatnonzero((left < n) & (right < n))
            inside = inside[rank[left[inside]] == rank[right[inside]]]
            common[longer[inside]] += 1 << level
        most = np.zeros(n, np.int64)
        most[1:] = common
        most[:-1] = np.maximum(most[:-1], common)
        out = np.empty(n, np.int64)
        out[self.order] = most
        return out[::-1]


@dataclass
class Pages:
    """Pages as symbols: links and tags one symbol each, numbers one, letters in lower case. shown: visible characters that a symbol stands for."""

    symbols: np.ndarray
    at: np.ndarray
    shown: np.ndarray
    capital: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Pages:
        masked = [_MARKUP.sub(lambda m: chr(_MARK) * len(m[0]), t) if any(c in t for c in _OPENERS) else t for t in texts]
        flat = FlatText(pa.array(masked, pa.large_string()))
        cps, first = flat.cps, np.zeros(len(flat.cps) + 1, bool)
        first[flat.at] = True
        digit = (cps >= 0x30) & (cps <= 0x39)
        symbols = np.where(digit, np.uint32(_DIGIT), np.where((cps >= 0x41) & (cps <= 0x5A), cps | 0x20, cps)).astype(np.uint32)
        joins = np.zeros(len(cps), bool)
        joins[1:] = (symbols[1:] == symbols[:-1]) & (digit[1:] | (symbols[1:] == _MARK)) & ~first[1 : len(cps)]
        starts = np.flatnonzero(~joins)
        seen = (visible(cps).astype(bool) | (cps == _MARK)).astype(np.int64)
        shown = np.add.reduceat(seen, starts) if len(starts) else seen
        capital = ((cps >= 0x41) & (cps <= 0x5A)) | ((cps >= 0xC0) & (cps <= 0xDE)) | ((cps >= 0x0391) & (cps <= 0x03A9)) | ((cps >= 0x0400) & (cps <= 0x042F))
        return Pages(symbols[starts], np.searchsorted(starts, flat.at), shown, capital[starts])

    def only(self, kept: np.ndarray) -> Pages:
        return Pages(self.symbols[kept], np.concatenate([[0], np.cumsum(kept)])[self.at], self.shown[kept], self.capital[kept])

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def texts(self) -> pa.Array:
        """The symbols as text, page by page."""
        raw = self.symbols.astype("<u4").tobytes().decode("utf-32-le").encode()
        wide = 1 + (self.symbols >= 0x80).astype(np.int64) + (self.symbols >= 0x800) + (self.symbols >= 0x10000)
        at = np.concatenate([[0], np.cumsum(wide)])[self.at]
        return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.string())


def _large(symbols: np.ndarray) -> np.ndarray:
    return ((symbols >= 0x3040) & (symbols <= 0x9FFF)) | ((symbols >= 0xAC00) & (symbols <= 0xD7A3)) | ((symbols >= 0xF900) & (symbols <= 0xFAFF)) | ((symbols >= 0x20000) & (symbols <= 0x3FFFF)) | ((symbols >= 0x3400) & (symbols <= 0x4DBF))


_STOPS = np.zeros(0x10000, bool)
_STOPS[[ord(c) for c in "。｡！!？?；;…"]] = True


def _sentence_ends(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a sentence ends with the symbol."""
    n = len(symbols)
    out = _STOPS[np.minimum(symbols, 0xFFFF)]
    after = np.full(n, 0x20, np.uint32)
    after[:-1] = symbols[1:]
    after[at[1:][np.diff(at) > 0] - 1] = 0x20
    return out | ((symbols == ord(".")) & ((after == 0x20) | (after == 0x0A)))


def _clause_ends(pages: Pages, at: np.ndarray) -> np.ndarray:
    """Whether the symbol ends a sentence or clause of at least PASSAGE_CLAUSE units."""
    symbols, n = pages.symbols, len(pages.symbols)
    stops = _sentence_ends(symbols, pages.at)
    signs = stops | (symbols == ord("，")) | (symbols == ord(","))
    weight = np.zeros(n)
    weight[at] = np.where(_large(symbols[at]), 1, 2)
    breaks = ~((weight > 0) | _letters(symbols) | (symbols == 0x20) | (symbols == _DIGIT))
    breaks[pages.at[:-1][np.diff(pages.at) > 0]] = True
    run = np.cumsum(breaks)
    before = np.concatenate([[0], run[:-1]])
    signs[pages.at[:-1][np.diff(pages.at) > 0]] = False
    return signs & (np.bincount(run, weight, n + 1)[before] >= PASSAGE_CLAUSE)


def copied_passages(pages: Pages, unit_at: np.ndarray | None = None) -> np.ndarray:
    """Source of every symbol: itself, or in a later copy of a passage of clauses the symbol it copies.

    Speech and copied paragraphs come again with their signs at the end of clauses; strings
    of keywords have none, or short items between them.
    """
    n = len(pages.symbols)
    source = np.arange(n)
    if n <= PASSAGE:
        return source
    owner = pages.owner()
    hashes = window_hashes(pages.symbols, PASSAGE)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[PASSAGE - 1 :])
    if not len(inside):
        return source
    key, order = _hashes_in_order((hashes[inside] ^ (owner[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64))
    place = inside[order]
    same = key[1:] == key[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    key, place = key[shared], place[shared]
    if not len(key):
        return source
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    groups = np.flatnonzero(new)
    first = np.repeat(np.minimum.reduceat(place, groups), np.diff(np.append(groups, len(key))))
    later, shift = place[place != first], (place - first)[place != first]
    keep = (shift >= PASSAGE_SHIFT) & (owner[later] == owner[later - shift])
    for i in range(PASSAGE):  # equal hashes are compared character by character
        keep &= pages.symbols[later + i] == pages.symbols[later - shift + i]
    later, shift = later[keep], shift[keep]
    if not len(later):
        return source
    sort = np.argsort(later)
    later, shift = later[sort], shift[sort]
    opens = np.ones(len(later), bool)
    opens[1:] = (later[1:] != later[:-1] + 1) | (shift[1:] != shift[:-1])
    begin = later[opens]
    end = np.append(later[:-1][opens[1:]], later[-1]) + PASSAGE
    ended = np.concatenate([[0], np.cumsum(_clause_ends(pages, units(pages.symbols, pages.at)[0] if unit_at is None else unit_at))])
    for lo, hi, back in zip(begin, end, shift[opens]):
        if ended[hi] > ended[lo]:
            source[lo:hi] = source[np.arange(lo, hi) - back]
    return source


def covered_symbols(pages: Pages) -> np.ndarray:
    """Whether each symbol lies in a maximal substring that its page repeats; links and tags count with the second."""
    n = len(pages.symbols)
    if not n:
        return np.zeros(0, bool)
    repeats = SuffixAutomaton(pages.symbols, pages.at).longest_repeats()
    need = 2 * np.log2(np.maximum(np.diff(pages.at), 2))[pages.owner()]
    bits = np.where(_large(pages.symbols), LARGE_BITS, LETTER_BITS)
    bits[pages.symbols == _DIGIT] = NUMBER_BITS
    mark = pages.symbols == _MARK
    bits[mark] = need[mark]
    total = np.concatenate([[0.0], np.cumsum(bits)])
    end = np.arange(1, n + 1)
    hit = np.flatnonzero((repeats > 0) & (total[end] - total[end - repeats] >= need - 1e-6))
    cover = np.zeros(n + 1, np.int64)
    cover += np.bincount(hit + 1 - repeats[hit], minlength=n + 1)
    cover[hit + 1] -= 1
    return np.cumsum(cover)[:n] > 0


def _letters(symbols: np.ndarray) -> np.ndarray:
    return ((symbols >= 0x61) & (symbols <= 0x7A)) | (symbols == 0x27) | ((symbols >= 0xC0) & (symbols <= 0x1FFF)) | ((symbols >= 0x2C00) & (symbols <= 0x2DFF))


def units(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, id) of every unit: a character of a large script, or a word of letters, by a 64-bit hash."""
    n = len(symbols)
    large = _large(symbols)
    letter = _letters(symbols)
    first = np.zeros(n + 1, bool)
    first[at] = True
    opens = letter.copy()
    opens[1:] &= ~letter[:-1] | first[1:n]
    start = np.flatnonzero(opens)
    mixed = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    word = np.zeros(len(start), np.uint64)
    live, step = np.arange(len(start)), 0
    while len(live):
        word[live] = (word[live] * np.uint64(0x9E3779B97F4A7C15)) ^ mixed[start[live] + step]
        step += 1
        here = start[live] + step
        ok = here < n
        ok[ok] = letter[here[ok]] & ~first[here[ok]]
        live = live[ok]
    position = np.concatenate([np.flatnonzero(large), start])
    ids = np.concatenate([mixed[large], word])
    order = np.argsort(position, kind="stable")
    return position[order], ids[order].view(np.int64)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1e-9)


@dataclass
class Clauses:
    """Clauses of a batch's pages and what is measured of each.

    page, shown, marked, covered: by clause its page, visible characters, those of links
    and tags, and those in repeats, copies of passages counted with their source.
    features: by clause, the columns of FEATURES. unit_clause, unit: its words and characters.
    """

    pages: int
    page: np.ndarray
    shown: np.ndarray
    marked: np.ndarray
    covered: np.ndarray
    features: np.ndarray
    unit_clause: np.ndarray
    unit: np.ndarray
    once: Pages

    @staticmethod
    def of(texts: list[str]) -> Clauses:
        every = Pages.of(texts)
        unit_at, unit = units(every.symbols, every.at)
        source = copied_passages(every, unit_at)
        kept = source == np.arange(len(source))
        once = every.only(kept)
        symbols, at, n = once.symbols, once.at, len(once.symbols)
        stops = _sentence_ends(symbols, at)
        opens = clause_starts(symbols, at, stops)
        clause = np.cumsum(opens) - 1
        count = int(clause[-1]) + 1 if n else 0
        page = once.owner()[opens]
        mark = symbols == _MARK
        inside = covered_symbols(once)
        if not kept.all():
            unit_at, unit = units(symbols, at)
        opened = np.flatnonzero(opens)
        total = lambda by: np.add.reduceat(by.astype(float), opened) if count else np.zeros(0)
        shown, is_unit = total(once.shown), np.zeros(n)
        is_unit[unit_at] = 1
        many = total(is_unit)
        # Runs of words between signs and line ends: lists have short ones, or none that end.
        space = (symbols == 0x20) | (symbols == _DIGIT)
        breaks = ~(is_unit.astype(bool) | _letters(symbols) | space)
        breaks[at[:-1][np.diff(at) > 0]] = True
        run = np.cumsum(breaks)
        length = np.bincount(run, is_unit)[run] if n else is_unit
        last = np.zeros(count, np.int64)
        last[clause] = np.arange(n)
        seen = np.flatnonzero((symbols != 0x20) & (symbols != 0x0A))
        head = np.full(count, -1)
        head[clause[seen][::-1]] = seen[::-1]
        ended = stops[last].astype(float)
        cased = ended * (head >= 0) * once.capital[np.maximum(head, 0)] * (many >= 4) if count else ended

        def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """The ratio over the clause and its two neighbours."""
            return _ratio(_with_neighbours(a, page), _with_neighbours(b, page))

        one = np.ones(count)
        pairs = [(total(once.shown * inside), shown), (total(is_unit * (length <= SHORT_RUN)), many), (total(is_unit * (length >= LONG_RUN)), many), (ended, one), (total(once.shown * mark), shown), (cased, one)]
        features = np.stack([one] + [x for a, b in pairs for x in (_ratio(a, b), near(a, b))], 1)
        weight = np.bincount((np.cumsum(kept) - 1)[source], every.shown, n) if n else np.zeros(0)
        return Clauses(len(texts), page, total(weight), total(weight * mark), total(weight * inside), features, clause[unit_at], unit, once)

    def teach(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
        """(unit, pages whose sentences have it, pages whose lists have it, pages with sentences, pages with lists), by the first model."""
        score = self.features @ FIRST
        ordered, place = _hashes_in_order(self.unit)
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        unit, code = ordered[new], np.empty(len(ordered), np.int64)
        code[place] = np.cumsum(new) - 1
        found, sizes = [], []
        for chosen in (score < -TEACHES, score > TEACHES):
            page = self.page[chosen]  # in order
            sizes.append(int((page[1:] != page[:-1]).sum()) + 1 if len(page) else 0)
            mine = chosen[self.unit_clause]
            each = self.page[self.unit_clause[mine]] * np.int64(len(unit) + 1) + code[mine]
            each.sort()
            new = np.ones(len(each), bool)
            new[1:] = each[1:] != each[:-1]
            found.append(np.bincount(each[new] % (len(unit) + 1), minlength=len(unit)))
        return unit, found[0], found[1], sizes[0], sizes[1]

    def by_page(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.page, values, self.pages).astype(np.int64)


def clause_starts(symbols: np.ndarray, at: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Whether a clause starts with the symbol: behind ends of sentences, lines and pages."""
    opens = np.zeros(len(symbols) + 1, bool)
    opens[at] = True
    opens[1:] |= stops | (symbols == 0x0A)
    return opens[:-1]


def glue(page: np.ndarray, unit_clause: np.ndarray, unit: np.ndarray, known: Learned) -> np.ndarray:
    """Columns: a clause's mean weight, the same with its neighbours, and how far its units are known."""
    count = len(page)
    weight, sure = known.of(unit)
    many = np.bincount(unit_clause, minlength=count).astype(float)
    sums, sures = np.bincount(unit_clause, weight, count), np.bincount(unit_clause, sure, count)
    wide = lambda x: _with_neighbours(x, page)
    return np.stack([sums / np.maximum(many, 3), _ratio(wide(sums), wide(np.maximum(many, 3))), _ratio(wide(sures), wide(many))], 1)


def scores(by_form: np.ndarray, by_both: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """Above 0: a list. by_form: of the first model; by_both: of the second, without what ``learned`` adds.

    As far as the corpus doesn't know a clause's units, coverage and form alone decide.
    """
    return learned[:, 2] * (by_both + learned[:, :2] @ SECOND[len(FEATURES) :]) + (1 - learned[:, 2]) * by_form


def _with_neighbours(values: np.ndarray, page: np.ndarray) -> np.ndarray:
    out = values.astype(float).copy()
    if len(page):
        same = page[1:] == page[:-1]
        out[1:] += values[:-1] * same
        out[:-1] += values[1:] * same
    return out


@dataclass
class Learned:
    """Weights of units (sorted): above 0 in sentences, below in lists; sure: 0 to 1 by the pages that show it."""

    unit: np.ndarray
    weight: np.ndarray
    sure: np.ndarray

    @staticmethod
    def from_counts(unit: np.ndarray, in_sentences: np.ndarray, in_lists: np.ndarray, sentences: int, lists: int) -> Learned:
        order = np.argsort(unit)
        unit, a, b = unit[order], in_sentences[order].astype(float), in_lists[order].astype(float)
        pooled = (a + b) / max(sentences + lists, 1)
        weight = np.log((a + PRIOR_PAGES * pooled) / (sentences + PRIOR_PAGES)) - np.log((b + PRIOR_PAGES * pooled) / (lists + PRIOR_PAGES))
        return Learned(unit, np.clip(weight, -STRONGEST, STRONGEST), (a + b) / (a + b + PRIOR_PAGES))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.unit):
            return np.zeros(len(ids)), np.zeros(len(ids))
        at = np.minimum(np.searchsorted(self.unit, ids), len(self.unit) - 1)
        known = self.unit[at] == ids
        return np.where(known, self.weight[at], 0.0), np.where(known, self.sure[at], 0.0)


_CLAUSE = np.dtype([("by_form", "<f4"), ("by_both", "<f4"), ("shown", "<u4"), ("marked", "<u4")])


def _measured(rows: DataFrame) -> DataFrame:
    """Rows (key, text) measured in one pass, which holds the automata, and kept in the shared folder.

    A row of each page: key, once (its symbols without copies), clauses (an array of
    _CLAUSE), visible, covered. A row of each batch and unit: unit, a and b, the pages of
    the batch whose sentences and lists have it; one with a null unit counts the pages themselves.
    """
    kind = dict(rows.dtypes)["key"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, 1, BYTES):
                c = Clauses.of(batch.column(1).fill_null("").to_pylist())
                unit, a, b, sentences, lists = c.teach()
                extra = len(unit) + 1
                form, both = c.features @ FIRST, c.features @ SECOND[: len(FEATURES)]
                packed = np.empty(len(form), _CLAUSE)
                packed["by_form"], packed["by_both"], packed["shown"], packed["marked"] = form, both, c.shown, c.marked
                clause_at = np.searchsorted(c.page, np.arange(c.pages + 1)) * _CLAUSE.itemsize
                blob = pa.Array.from_buffers(pa.large_binary(), c.pages, [None, pa.py_buffer(clause_at.astype(np.int64)), pa.py_buffer(packed.tobytes())])
                none = lambda t: pa.nulls(extra, t)
                counted = lambda x: pa.concat_arrays([pa.nulls(c.pages, pa.int64()), pa.array(x, pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([batch.column(0), none(batch.column(0).type)]),
                        pa.concat_arrays([c.once.texts(), none(pa.string())]),
                        pa.concat_arrays([blob.cast(pa.binary()), none(pa.binary())]),
                        pa.concat_arrays([pa.array(c.by_page(c.shown)), none(pa.int64())]),
                        pa.concat_arrays([pa.array(c.by_page(c.covered)), none(pa.int64())]),
                        pa.concat_arrays([pa.nulls(c.pages, pa.int64()), pa.array(unit), pa.nulls(1, pa.int64())]),
                        counted(np.append(a, sentences)),
                        counted(np.append(b, lists)),
                    ],
                    ["key", "once", "clauses", "visible", "covered", "unit", "a", "b"],
                )

    return cut(rows.mapInArrow(measure, f"key {kind}, once string, clauses binary, visible bigint, covered bigint, unit bigint, a bigint, b bigint"), "pages")


def learn(measured: DataFrame) -> Learned:
    """Weights of the units of all pages, by the pages whose sentences or lists have them.

    Each batch has sent its counts by unit, which are added up in a shuffle. Units of at
    least LEAST_SHARE of the pages come to the driver: at most a page's mean number of
    different units, divided by that share, whatever the number of pages.
    """
    counts = cut(measured.filter("once IS NULL").groupBy("unit").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "units")
    pages = counts.filter("unit IS NULL").collect()
    sentences, lists = (pages[0]["a"], pages[0]["b"]) if pages else (0, 0)
    rows = counts.filter(F.col("unit").isNotNull() & (F.col("a") + F.col("b") >= LEAST_SHARE * (sentences + lists))).toArrow()
    return Learned.from_counts(*(np.asarray(rows[c].to_numpy(), np.int64) for c in ("unit", "a", "b")), sentences, lists)


def keyword_pages(df: DataFrame, *, key: str, text: str, share: float = 0.5) -> DataFrame:
    """(key, visible, listed, covered, spam) of every row.

    visible: visible characters; covered: those in maximal substrings that the page
    repeats, by its suffix automaton; listed: those of clauses that coverage and clause
    structure together make a list, and of links and tags anywhere. spam: more than
    ``share`` of the visible characters are listed. Later copies of a whole passage of
    clauses are judged as its first copy is, so that prose said twice stays prose.

    Null, empty and blank texts have no visible character and are no spam; repeated
    rows give a row each. Other columns are not read. The texts are read once, in a job
    of its own that leaves what the decision needs in the shared folder.
    """
    measured = _measured(df.select(F.col(key).alias("key"), F.col(text).alias("text")))
    known = df.sparkSession.sparkContext.broadcast(learn(measured))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, 1, 4 * BYTES):
                flat = FlatText(batch.column(1))
                opens = clause_starts(flat.cps, flat.at, _sentence_ends(flat.cps, flat.at))
                page, clause = flat.owner()[opens], np.cumsum(opens) - 1
                packed = np.frombuffer(b"".join(batch.column(2).to_pylist()), _CLAUSE)
                position, unit = units(flat.cps, flat.at)
                learned = glue(page, clause[position], unit, known.value)
                listed = np.where(scores(packed["by_form"], packed["by_both"], learned) > 0, packed["shown"], packed["marked"])
                inside = np.bincount(page, listed, batch.num_rows).astype(np.int64)
                spam = inside > share * batch.column(3).to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(inside), batch.column(4), pa.array(spam)], ["key", "visible", "listed", "covered", "spam"])

    pages = measured.filter("once IS NOT NULL").select("key", "once", "clauses", "visible", "covered")
    return pages.mapInArrow(judge, f"key {dict(pages.dtypes)['key']}, visible bigint, listed bigint, covered bigint, spam boolean").withColumnRenamed("key", key)
