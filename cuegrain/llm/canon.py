"""One form for texts that look the same.

A character map takes width, kinds of space, invisible characters and the alphabet of
look-alikes away; what remains, composition above all, is decided by an
accent-sensitive Unicode collation in SQL, under which the mapped values are grouped.
The least mapped value by code point stands for its class and is joined back.

Which letters and signs of other alphabets look like those of ASCII is taken from the
confusables data of Unicode (UTS #39), in the version of the ICU library among Spark's
own jars (ICU 77.1, Unicode 16 with Spark 4.1).
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

# Look-alikes that the confusables data doesn't have.
MISSING_LOOK_ALIKES = {"\u051a": "Q"}

_SPACE, _BREAK = " ", "\n"


def _invisible(ch: str) -> bool:
    cp = ord(ch)
    return (
        unicodedata.category(ch) == "Cf"
        or (unicodedata.category(ch) == "Cc" and ch not in "\t\n\r\x0b\x0c\x85")
        or 0xFE00 <= cp <= 0xFE0F
        or 0xE0100 <= cp <= 0xE01EF
        or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0)
    )


def _alone(ch: str) -> str:
    """The character that a reader sees for ``ch`` taken alone; '' for none.

    Full and half width, and single characters that Unicode marks as another form of
    one character (radicals, the micro sign), give way; raised, circled and squared
    characters don't.
    """
    if _invisible(ch):
        return ""
    if unicodedata.category(ch) == "Zs" or ch == "\t":
        return _SPACE
    if ch in "\u2028\u2029\x85":
        return _BREAK
    tag, _, rest = unicodedata.decomposition(ch).rpartition(">")
    parts = rest.split()
    if tag in ("<wide", "<narrow", "<small", "<compat") and len(parts) == 1:
        return _alone(chr(int(parts[0], 16)))
    if not tag and len(parts) == 1:
        return _alone(chr(int(parts[0], 16)))
    return ch


def _kind(ch: str) -> str:
    """Upper, lower, caseless or modifier letter, decimal digit, sign; '' for what is never taken for a character of ASCII."""
    category = unicodedata.category(ch)
    if category[0] in "PS" or 0x01C0 <= ord(ch) <= 0x01C3:  # the click letters are bars and marks
        return "sign"
    return {"Lu": "upper", "Lt": "upper", "Ll": "lower", "Lo": "caseless", "Lm": "modifier", "Nd": "digit"}.get(category, "")


def _assigned() -> list[str]:
    gaps = (range(0x3400, 0xA000), range(0xAC00, 0xF900), range(0x17000, 0x18D00), range(0x20000, 0x2F800), range(0x2FA20, 0xE0000), range(0xE01F0, 0x110000))
    skipped = {cp for gap in gaps for cp in gap}
    return [chr(cp) for cp in range(0x21, 0x110000) if cp not in skipped and unicodedata.category(chr(cp)) not in ("Cn", "Co", "Cs")]


@lru_cache(1)
def _alphabets() -> dict[str, str]:
    """Letters and signs that are confusable with one of ASCII of the same kind, and that one.

    Case and the difference of letters, digits and signs stay, though fonts blur them (l,
    I, 1). The accented and other letters of Latin alphabets in use (U+00C0 to U+024F) are
    themselves; so are characters that resemble none of ASCII.
    """
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    checker = getattr(spark.sparkContext._jvm.com.ibm.icu.text, "SpoofChecker$Builder")().build()
    chars = _assigned()
    skeletons = dict(zip(chars, checker.getSkeleton("\n".join(chars)).split("\n"), strict=True))
    ascii_of = {(skeletons[ch], _kind(ch)): ch for ch in map(chr, range(0x7E, 0x20, -1))}
    out = {}
    for ch in chars:
        if ord(ch) < 0x80 or 0xC0 <= ord(ch) <= 0x24F and _kind(ch) != "sign":
            continue
        kind = _kind(ch)
        kinds = {"": [], "caseless": ["lower"], "modifier": ["lower", "sign"], "upper": ["upper", "sign"], "lower": ["lower", "sign"]}.get(kind, [kind])
        out.update({ch: ascii_of[skeletons[ch], k] for k in kinds[::-1] if (skeletons[ch], k) in ascii_of})
    # Signs that resemble no sign of ASCII but each other stand for the middle dot.
    dot = skeletons["\u00b7"]
    out.update({ch: "\u00b7" for ch in chars if skeletons[ch] == dot and _kind(ch) == "sign" and ch != "\u00b7"})
    return out | MISSING_LOOK_ALIKES


@lru_cache(1)
def look_map() -> dict[str, str]:
    """Characters whose visible form is another text, or nothing, and that text.

    A letter with marks goes by its letter, so that both compositions of it have one form.
    """
    alphabets, out = _alphabets(), {}
    for ch in [*map(chr, range(0x80, 0xA1)), *_assigned()]:
        if ord(ch) < 0x80:
            continue
        seen = _alone(ch)
        seen = alphabets.get(seen, seen)
        first, *marks = unicodedata.normalize("NFD", seen) or [""]
        if marks and first in alphabets:
            seen = unicodedata.normalize("NFC", alphabets[first] + "".join(marks))
        if seen != ch:
            out[ch] = seen
    out.update({chr(cp): "" for cp in (*range(0x20), 0x7F) if chr(cp) not in "\t\n\r\x0b\x0c"})
    out["\t"] = _SPACE
    return out


@lru_cache(1)
def base_map() -> dict[str, str]:
    """The look map with all marks taken off as well: equal for all texts of a class, and for some others.

    A Hangul syllable goes by its first letter, since its parts may stand one by one.
    """
    out = {}
    for ch in [*look_map(), *_assigned()]:
        seen = look_map().get(ch, ch)
        base = "".join(c for c in unicodedata.normalize("NFD", seen) if unicodedata.category(c)[0] != "M")
        base = "".join(look_map().get(c, c) for c in base if not 0x1160 <= ord(c) <= 0x11FF)
        if base != ch:
            out[ch] = base
    for cp in range(0xAC00, 0xD7A4):
        out[chr(cp)] = unicodedata.normalize("NFD", chr(cp))[0]
    return out


def translate_arguments(table: dict[str, str]) -> tuple[str, str]:
    """from and to of SQL's translate: characters without a counterpart are deleted; those with a longer one are :func:`spelled`."""
    kept = sorted(k for k, v in table.items() if len(v) == 1)
    gone = sorted(k for k, v in table.items() if not v)
    return "".join(kept + gone), "".join(table[k] for k in kept)


def spelled(text: Column, table: dict[str, str]) -> Column:
    """Text with the characters whose counterpart is longer than one written out; few texts have any."""
    longer = {k: v for k, v in sorted(table.items()) if len(v) > 1}
    if not longer:
        return text
    entries = F.map_from_arrays(F.array(*map(F.lit, longer)), F.array(*map(F.lit, longer.values())))
    written = F.array_join(F.transform(F.split(text, ""), lambda ch: F.coalesce(entries[ch], ch)), "")
    return F.when(text.rlike("[" + "".join(longer) + "]"), written).otherwise(text)


def mapped(text: Column, table: dict[str, str]) -> Column:
    """Text with all characters replaced by the table."""
    return F.translate(spelled(text, table), *translate_arguments(table))


def shows(text: Column) -> Column:
    """Whether a text, which isn't null, has a visible character."""
    unseen = sorted(k for k, v in look_map().items() if not v.strip())
    return text.isNotNull() & text.rlike("[^\\s" + "".join(f"\\x{{{ord(ch):x}}}" for ch in unseen) + "]")


_CLASSES = """
WITH seen AS (SELECT raw, base, shape COLLATE UNICODE AS shape FROM {texts}),
classes AS (SELECT shape, min(CAST(shape AS STRING COLLATE UTF8_BINARY)) AS form FROM seen GROUP BY shape)
SELECT seen.raw, seen.base, classes.form FROM seen JOIN classes ON seen.shape = classes.shape
"""


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, forms) of rows (kind, key, entity, text).

    records (kind, key, entity, raw, base): hashes of the text as stored, and of its letters
    without marks, of rows with a visible character. forms (raw, base, form): of the
    texts that share their letters with another text anywhere, which is where the
    collation has anything to decide; it sees each such text once.
    """
    spark = rows.sparkSession
    raw, base = F.xxhash64("text"), mapped(F.col("text"), base_map())
    records = cut(rows.filter(shows(F.col("text"))).select("kind", "key", "entity", raw.alias("raw"), F.xxhash64(base).alias("base")), "looks")
    several = records.groupBy("base").agg(F.min("raw").alias("_lo"), F.max("raw").alias("_hi")).filter("_lo <> _hi").select("base")
    suspects = records.select("raw", "base").distinct().join(several, "base", "left_semi")
    texts = rows.select(F.col("text"), raw.alias("raw")).filter(shows(F.col("text"))).join(suspects, "raw").groupBy("raw", "base").agg(F.first("text").alias("text"))
    texts = texts.select("raw", "base", mapped(F.col("text"), look_map()).alias("shape"))
    return records, cut(spark.sql(_CLASSES, texts=texts), "forms")


def one_form(rows: DataFrame) -> DataFrame:
    """(kind, key, entity, form) of rows (kind, key, entity, text).

    form is the least mapped text of all rows, of whatever kind and entity, that look the
    same: two rows have equal forms exactly if their texts look the same. Rows whose text
    is null or has no visible character give no row; repeated rows give one.
    """
    _, forms = _classes(rows)
    text = F.col("text")
    each = rows.filter(shows(text)).select("kind", "key", "entity", F.xxhash64("text").alias("raw"), mapped(text, look_map()).alias("own"))
    # A text that shares its letters with no other is a class of its own.
    found = each.join(forms.select("raw", "form"), "raw", "left")
    return found.select("kind", "key", "entity", F.coalesce("form", "own").alias("form")).distinct()


def look_alike_pairs(rows: DataFrame) -> DataFrame:
    """(kind, key_a, key_b): two rows of one kind and entity that look the same but differ in their characters. Null entities match nothing."""
    records, forms = _classes(rows)
    looks = records.join(forms.select("raw", "base", F.xxhash64("form").alias("form")), ["raw", "base"]).select("kind", "entity", "form", "key", "raw").distinct()
    a = looks.select("kind", "entity", "form", F.col("key").alias("key_a"), F.col("raw").alias("raw_a"))
    b = looks.select(F.col("kind").alias("k"), F.col("entity").alias("e"), F.col("form").alias("f"), F.col("key").alias("key_b"), F.col("raw").alias("raw_b"))
    same = (a["kind"] == b["k"]) & (a["entity"] == b["e"]) & (a["form"] == b["f"])
    return a.join(b, same & (a["raw_a"] != b["raw_b"]) & (a["key_a"] < b["key_b"])).select("kind", "key_a", "key_b").distinct()
