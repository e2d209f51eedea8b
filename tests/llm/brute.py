"""Plain versions of the operators, a row at a time."""

import re
import unicodedata


def pieces(text, limit=500, least=250, overlap=50):
    ends = {m.end() for m in re.finditer(r"[。｡！!？?；;…\n]+[」』”’）)]*", text)} | {m.end() for m in re.finditer(r"\.(?=[ \n]|\Z)", text)}
    clauses = {m.end() for m in re.finditer("[，,、､：: \u3000]", text)}
    out, start = [], 0
    while True:
        if len(text) - start <= limit:
            out.append((len(out) + 1, start, len(text)))
            return out
        window = range(start + least + 1, start + limit + 1)
        stop = max([e for e in window if e in ends], default=0) or max([e for e in window if e in clauses], default=0) or start + limit
        out.append((len(out) + 1, start, stop))
        start = stop - overlap


def repeated(text, n=12):
    kept = "".join(c for c in text if unicodedata.category(c)[0] in "LN")
    seen, mark = set(), [False] * len(kept)
    for i in range(len(kept) - n + 1):
        gram = kept[i : i + n]
        if gram in seen:
            mark[i : i + n] = [True] * n
        seen.add(gram)
    return len(kept), sum(mark)


def shingles(text, n=3):
    x = text.replace(" ", "").replace("\n", "")
    return {x[i : i + n] for i in range(len(x) - n + 1)} if len(x) >= 40 else None


def longest_repeats(text):
    """For every position the longest substring ending there that occurs more than once."""
    return [max((n for n in range(1, end + 1) if sum(text.startswith(text[end - n : end], i) for i in range(len(text))) > 1), default=0) for end in range(1, len(text) + 1)]
