"""SQL twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

import unicodedata

P2 = """
WITH b AS (SELECT DISTINCT boundary_id, video_id, t FROM golden_boundaries WHERE status = 'confirmed' AND t IS NOT NULL),
s AS (SELECT DISTINCT segment_id, video_id, t_start FROM segments WHERE t_start IS NOT NULL),
j AS (SELECT boundary_id, segment_id, abs(t - t_start) AS gap,
             row_number() OVER (PARTITION BY boundary_id, b.video_id, t ORDER BY abs(t - t_start), segment_id) AS n
      FROM b JOIN s ON b.video_id = s.video_id)
SELECT DISTINCT boundary_id, segment_id FROM j WHERE n = 1 AND gap <= 10.0
"""

_P5 = """
WITH RECURSIVE t AS (
  SELECT DISTINCT read_id, replace(replace(parsed.slide_text, ' ', ''), chr(10), '') AS x FROM slide_out),
g AS (
  SELECT read_id, x, list_distinct(list_transform(range(1, length(x) - 1), lambda i: substr(x, i::INT, 3))) AS grams
  FROM t WHERE length(x) >= 40),
e AS (SELECT read_id, len(grams) AS n, unnest(grams) AS gram FROM g),
c AS (
  SELECT a.read_id AS read_a, b.read_id AS read_b, count(*) AS shared, any_value(a.n) + any_value(b.n) AS total
  FROM e a JOIN e b ON a.gram = b.gram AND a.read_id < b.read_id GROUP BY ALL),
found AS (SELECT DISTINCT read_a, read_b FROM c WHERE shared / (total - shared) >= 0.6)
"""

P5 = _P5 + "SELECT read_a, read_b FROM found"

P5_GROUPS = (
    _P5
    + """, ed AS (SELECT read_a AS x, read_b AS y FROM found UNION SELECT read_b, read_a FROM found),
rc AS (SELECT x AS n, y AS m FROM ed UNION SELECT rc.n, ed.y FROM rc JOIN ed ON rc.m = ed.x),
cm AS (SELECT n, min(m) AS m FROM rc GROUP BY n),
k AS (SELECT a.read_id, count(DISTINCT b.x) AS links FROM g a JOIN ed ON ed.x = a.read_id JOIN g b ON b.read_id = ed.y AND b.x <> a.x GROUP BY a.read_id)
SELECT g.read_id, least(g.read_id, coalesce(cm.m, g.read_id)) AS page, coalesce(links, 0) AS links
FROM g LEFT JOIN cm ON cm.n = g.read_id LEFT JOIN k ON k.read_id = g.read_id
"""
)

# Boundaries by character, the strongest cut for every start by a window frame, then the steps.
P3 = """
WITH RECURSIVE t AS (SELECT DISTINCT segment_id, transcript_raw AS x, length(transcript_raw) AS n FROM segments WHERE length(transcript_raw) > 500),
ch AS (SELECT segment_id, i, substr(x, i::INT, 1) AS c, substr(x, (i + 1)::INT, 1) AS d FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM t)),
f AS (SELECT *, contains('。｡！!？?；;…' || chr(10), c) AS r, contains('」』”’）)', c) AS q, contains('，,、､：: ' || chr(12288), c) AS clause FROM ch),
g AS (SELECT *, r OR (q AND coalesce(last_value(CASE WHEN NOT q THEN r END IGNORE NULLS) OVER (PARTITION BY segment_id ORDER BY i ROWS UNBOUNDED PRECEDING), false)) AS inside FROM f),
h AS (SELECT *, coalesce(lead(inside) OVER w, false) AS follows, coalesce(lead(r) OVER w, false) AS next_r FROM g WINDOW w AS (PARTITION BY segment_id ORDER BY i)),
b AS (SELECT segment_id, i AS e, CASE WHEN (inside AND (NOT follows OR (q AND next_r))) OR (c = '.' AND d IN ('', ' ', chr(10))) THEN 2 WHEN clause THEN 1 ELSE 0 END AS w FROM h
      UNION ALL SELECT segment_id, 0, 0 FROM t),
m AS (SELECT segment_id, e AS s, max(w * 1000000000 + e) OVER (PARTITION BY segment_id ORDER BY e ROWS BETWEEN 251 FOLLOWING AND 500 FOLLOWING) % 1000000000 AS stop FROM b),
p AS (SELECT segment_id, n, 1 AS piece_no, 0::BIGINT AS s, CASE WHEN n <= 500 THEN n ELSE stop END AS stop FROM t JOIN m USING (segment_id) WHERE s = 0
      UNION ALL SELECT p.segment_id, p.n, piece_no + 1, m.s, CASE WHEN p.n - m.s <= 500 THEN p.n ELSE m.stop END FROM p JOIN m ON m.segment_id = p.segment_id AND m.s = p.stop - 50 WHERE p.stop < p.n)
SELECT segment_id, piece_no, s::INT AS char_from, stop::INT AS char_to FROM p
"""

P6 = r"""
WITH s AS (SELECT DISTINCT segment_id, regexp_replace(transcript_raw, '[^\p{L}\p{N}]', '', 'g') AS k FROM segments WHERE transcript_raw IS NOT NULL),
g AS (SELECT segment_id, i, substr(k, i::INT, 12) AS gram FROM (SELECT *, unnest(range(1, length(k) - 10)) AS i FROM s WHERE length(k) >= 12)),
r AS (SELECT segment_id, i FROM (SELECT *, row_number() OVER (PARTITION BY segment_id, gram ORDER BY i) AS n FROM g) WHERE n > 1),
c AS (SELECT segment_id, count(DISTINCT i + o) AS repeated FROM r, range(0, 12) u(o) GROUP BY segment_id)
SELECT DISTINCT segment_id FROM s JOIN c USING (segment_id) WHERE repeated / length(k) >= 0.30
"""


# Letters and signs of other alphabets, and those they look like.
_ALIKE = {
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳνοϲ": "ABEZHIKMNOPTYXCjvoc",
    "АВЕКМНОРСТУХЅІЈԌԚԜѴ": "ABEKMHOPCTYXSIJGQWV",
    "асеорухѕіјһԁԛԝѵ": "aceopyxsijhdqwv",
    "ЁЇёї": "ËÏëï",
    "ɡꞌ": "g'",
    "‐‑‒−﹣": "-----",
    "’‘ʼ＇′": "'''''",
    "“”″": '"""',
    "∶꞉": "::",
    "⁄∕": "//",
    "∣": "|",
    "․": ".",
    "‚": ",",
    "‧⋅∙・•": "·····",
}


def _plain() -> dict[str, str]:
    """Width, radicals, spaces and invisible characters by Unicode's compatibility forms, and the list above."""
    out = {a: b for froms, tos in _ALIKE.items() for a, b in zip(froms, tos, strict=True)}
    for cp in (0xB5, *range(0x2E80, 0x2FD6), *range(0xF900, 0xFB00), *range(0xFF01, 0xFFEF), 0x2126, 0x212A, 0x212B, *range(0x2F800, 0x2FA1E)):
        seen = unicodedata.normalize("NFKC", chr(cp))
        if len(seen) == 1:
            out[chr(cp)] = out.get(seen, seen)
    for ch in map(chr, [*range(0x7F, 0x3001), 0xFEFF, *range(0xFE00, 0xFE10)]):
        kind = unicodedata.category(ch)
        if kind in ("Zs", "Cf", "Cc") or 0xFE00 <= ord(ch) <= 0xFE0F:
            out[ch] = " " if kind == "Zs" else ""
    return {a: b for a, b in out.items() if a != b}


def _looks() -> str:
    table = _plain()
    froms = sorted(table, key=lambda ch: not table[ch])
    quoted = ["'" + "".join(x).replace("'", "''") + "'" for x in (froms, [table[ch] for ch in froms])]
    return f"""
WITH a AS (SELECT DISTINCT 'segment' AS rec_kind, segment_id AS key, video_id, transcript_raw AS x FROM segments WHERE transcript_raw IS NOT NULL
  UNION SELECT 'slide', read_id, video_id, parsed.slide_text FROM slide_raw WHERE parsed.slide_text IS NOT NULL),
m AS (SELECT *, translate(x, {quoted[0]}, {quoted[1]}) AS mapped FROM a),
f AS (SELECT *, nfc_normalize(mapped) AS form FROM m WHERE regexp_matches(mapped, '[^\\s]'))
"""


P4 = (
    _looks()
    + """
SELECT DISTINCT l.rec_kind, l.key AS key_a, r.key AS key_b FROM f l JOIN f r ON l.rec_kind = r.rec_kind AND l.video_id = r.video_id AND l.form = r.form AND l.key < r.key AND l.x <> r.x
"""
)

P4_FORMS = _looks() + "SELECT DISTINCT rec_kind, key, min(mapped) OVER (PARTITION BY form) AS form FROM f"
