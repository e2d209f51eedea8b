"""Queries over single texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text as T
from ..registry import Registry, load

REGISTRY = Registry()

#: White space in Unicode's sense, for a regex engine whose class is ASCII.
WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', '', 'g')"


def sql_list(x: str, n: int) -> str:
    return f"list_transform(range(1, greatest(length({x}) - {n - 2}, 1)), lambda i: substr({x}, i::INT, {n}))"


def sql_grams(x: str, n: int = 2) -> str:
    """n-gram set of a text that is stripped already."""
    return f"CASE WHEN {x} = '' THEN []::VARCHAR[] WHEN length({x}) < {n} THEN [{x}] ELSE list_distinct({sql_list(x, n)}) END"


def sql_containment(a: str, b: str) -> str:
    """Of gram lists."""
    return f"CASE WHEN len({a}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len({a}) END"


def sql_longest_common(rows: str) -> str:
    """CTEs that end in lc (k, n): the longest common substring of columns x and s of ``rows`` (k, x, s), from runs of equal characters along diagonals."""
    return f"""pa AS (SELECT k, i, substr(x, i::INT, 1) AS ch FROM (SELECT k, x, unnest(range(1, length(x) + 1)) AS i FROM {rows})),
pb AS (SELECT k, j, substr(s, j::INT, 1) AS ch FROM (SELECT k, s, unnest(range(1, length(s) + 1)) AS j FROM {rows})),
rn AS (SELECT k, i - j AS d, i - row_number() OVER (PARTITION BY k, i - j ORDER BY i) AS g FROM pa JOIN pb USING (k, ch)),
lc AS (SELECT k, max(n) AS n FROM (SELECT k, count(*) AS n FROM rn GROUP BY k, d, g) GROUP BY k)"""


def reads(spark: SparkSession, sf_dir: str, table: str = "slide_out") -> DataFrame:
    """Slide reads without repeated rows."""
    return load(spark, sf_dir, table).select("read_id", "video_id", "slide_id", "parsed.*").distinct()


_SLIDES = "SELECT DISTINCT read_id, parsed.slide_text AS a, parsed.description AS b FROM slide_out WHERE parsed.slide_text IS NOT NULL AND parsed.description IS NOT NULL"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).select("read_id", F.col("slide_text").alias("a"), F.col("description").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()


@REGISTRY.add(
    "text_containment",
    f"""WITH s AS ({_SLIDES}), c AS (SELECT read_id, {sql_strip('a')} AS a, {sql_strip('b')} AS b FROM s),
    g AS (SELECT read_id, {sql_grams('a')} AS ga, {sql_grams('b')} AS gb FROM c),
    r AS (SELECT read_id, {sql_containment('gb', 'ga')} AS x, {sql_containment('ga', 'gb')} AS y FROM g)
    SELECT read_id, round(x, 9) AS containment, round(least(x, y), 9) AS agreement FROM r""",
)
def text_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a slide's description its text holds."""
    return _pairs(spark, sf_dir).select("read_id", F.round(T.containment(F.col("b"), F.col("a")), 9).alias("containment"), F.round(T.agreement(F.col("a"), F.col("b")), 9).alias("agreement"))


@REGISTRY.add(
    "han_coverage",
    f"""WITH s AS ({_SLIDES}), c AS (SELECT read_id, regexp_replace(a, '[^一-鿿]', '', 'g') AS a, regexp_replace(b, '[^一-鿿]', '', 'g') AS b FROM s),
    g AS (SELECT read_id, {sql_grams('a', 3)} AS ga, CASE WHEN length(b) < 3 THEN []::VARCHAR[] ELSE {sql_list('b', 3)} END AS gb FROM c)
    SELECT read_id, round(CASE WHEN len(gb) = 0 THEN 0.0 ELSE len(list_filter(gb, lambda x: list_contains(ga, x))) / len(gb) END, 9) AS coverage FROM g""",
)
def han_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("read_id", F.round(T.coverage(F.col("b"), F.col("a")), 9).alias("coverage"))


@REGISTRY.add(
    "gram_counts",
    f"""WITH c AS (SELECT DISTINCT segment_id, {sql_strip('transcript_raw')} AS x FROM segments WHERE transcript_raw IS NOT NULL)
    SELECT gram, count(*) AS n FROM (SELECT unnest({sql_list('x', 2)}) AS gram FROM c WHERE length(x) >= 2) GROUP BY gram""",
)
def gram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram multiset of all transcripts."""
    seg = load(spark, sf_dir, "segments").select("segment_id", "transcript_raw").distinct()
    return seg.select(F.explode(T.gram_list(T.strip_space(F.col("transcript_raw")), 2)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def sql_markdown(x: str) -> str:
    for pattern, to in fixed.MARKDOWN:
        x = f"regexp_replace({x}, '{pattern}', '{to.replace('$', chr(92))}', 'g')"
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


@REGISTRY.add("plain_text", f"SELECT doc_id, length(p) AS n_chars, substr(sha256(p), 1, 16) AS content_sha FROM (SELECT doc_id, {sql_markdown('text')} AS p FROM documents WHERE text IS NOT NULL)")
def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without markdown, and their content hash."""
    plain = load(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", T.strip_markdown(F.col("text")).alias("p"))
    return plain.select("doc_id", F.length("p").alias("n_chars"), T.content_sha(F.col("p")).alias("content_sha"))


def sql_split_long(x: str, most: int) -> str:
    """Pieces of a text: a reduction over its sentences, as (done, open) pairs."""
    closed = "CASE WHEN a.open = '' THEN a.done ELSE list_append(a.done, a.open) END"
    hard = f"list_transform(range(0, ((length(x.open) - 1) // {most})), lambda i: substr(x.open, (i * {most} + 1)::INT, {most}))"
    rest = f"substr(x.open, ((length(x.open) - 1) // {most} * {most} + 1)::INT, {most})"
    row = "{'done': []::VARCHAR[], 'open': %s}"
    folded = f"""list_reduce(list_prepend({row % "''"}, list_transform(regexp_extract_all({x}, '[^。！？；]*[。！？；]|[^。！？；]+$'), lambda s: {row % 's'})), lambda a, x:
      CASE WHEN length(x.open) > {most} THEN {{'done': list_concat({closed}, {hard}), 'open': {rest}}}
           WHEN length(a.open) + length(x.open) <= {most} THEN {{'done': a.done, 'open': a.open || x.open}} ELSE {{'done': {closed}, 'open': x.open}} END)"""
    return f"CASE WHEN length({x}) <= {most} THEN [{x}] ELSE (SELECT CASE WHEN f.open = '' THEN f.done ELSE list_append(f.done, f.open) END FROM (SELECT {folded} AS f)) END"


@REGISTRY.add("long_text_pieces", f"SELECT doc_id, (i - 1)::INT AS piece, length(x) AS n_chars, substr(sha256(x), 1, 16) AS content_sha FROM (SELECT doc_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, {sql_split_long('text', 800)} AS p FROM documents WHERE text IS NOT NULL))")
def long_text_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence-packed pieces of at most 800 characters."""
    docs = load(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", F.posexplode(T.split_long(F.col("text"), 800)).alias("piece", "text")).select("doc_id", "piece", F.length("text").alias("n_chars"), T.content_sha(F.col("text")).alias("content_sha"))


@REGISTRY.add("referential_phrases", f"SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '({'|'.join(fixed.REFERENTIAL)})'))) AS phrases FROM documents WHERE text IS NOT NULL")
def referential_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", T.referential_phrases(F.col("text")).alias("phrases"))


_UNITS = "|".join(fixed.UNITS)
_SQL_ENTITIES = f"""list_distinct(list_concat(
  regexp_extract_all({{x}}, '《([^》]{{{{1,30}}}})》', 1), regexp_extract_all({{x}}, '\\d+(?:\\.\\d+)?'),
  regexp_extract_all({{x}}, '([{fixed.CJK_DIGITS}]{{{{1,8}}}})(?:{_UNITS})', 1), regexp_extract_all({{x}}, '(?:\\d{{{{2,4}}}}|[{fixed.CJK_DIGITS}]{{{{1,6}}}})年')))"""


@REGISTRY.add("named_entities", f"SELECT doc_id, list_sort({_SQL_ENTITIES.format(x='text')}) AS entities FROM documents WHERE text IS NOT NULL")
def named_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, numbers, counted things and years of every document."""
    return load(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", F.array_sort(T.named_entities(F.col("text"))).alias("entities"))


_FORMS = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in fixed.number_forms().items()) + "}"


@REGISTRY.add(
    "unsupported_entities",
    f"""WITH s AS ({_SLIDES}), c AS (SELECT read_id, {sql_strip('a')} AS src, {_SQL_ENTITIES.format(x='b')} AS e FROM s)
    SELECT read_id, list_sort(list_filter(e, lambda x: len(list_filter(coalesce({_FORMS}[x], [x]), lambda w: contains(src, w))) = 0)) AS missing FROM c""",
)
def unsupported_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of a slide's description that its text lacks in any form."""
    return _pairs(spark, sf_dir).select("read_id", T.unsupported_entities(F.col("b"), F.col("a")).alias("missing"))


@REGISTRY.add("symbol_support")
def symbol_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols of a slide's text, and those that its description has alone."""
    return _pairs(spark, sf_dir).select("read_id", T.symbol_entities(F.col("a")).alias("symbols"), T.unsupported_symbols(F.col("b"), F.col("a")).alias("missing"))


@REGISTRY.add("copy_ratio", f"WITH sl AS ({_SLIDES}), rw AS (SELECT row_number() OVER () AS k, read_id, {sql_strip('b')} AS x, {sql_strip('a')} AS s FROM sl), {sql_longest_common('rw')} SELECT read_id, round(coalesce(n, 0) / greatest(length(x), 1), 9) AS ratio FROM rw LEFT JOIN lc USING (k)")
def copy_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest passage of a slide's description that is copied from its text."""
    return _pairs(spark, sf_dir).select("read_id", F.round(T.common_substring_ratio(F.col("b"), F.col("a")), 9).alias("ratio"))


@REGISTRY.add("character_error_rate")
def character_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reads against the reads kept after deduplication."""
    raw = reads(spark, sf_dir, "slide_raw").select("read_id", F.col("slide_text").alias("hypothesis"))
    kept = reads(spark, sf_dir).select("read_id", F.col("slide_text").alias("reference"))
    return raw.join(kept, "read_id").select("read_id", F.round(T.cer(F.col("hypothesis"), F.col("reference")), 9).alias("cer")).distinct()


@REGISTRY.add(
    "slide_terms",
    """WITH p AS (SELECT DISTINCT read_id, string_split_regex(parsed.slide_text, '[\\s\\x{0B}，、。；：:;,.（）()【】「」|/]+') AS parts FROM slide_out WHERE parsed.slide_text IS NOT NULL),
    u AS (SELECT read_id, unnest(parts) AS term, generate_subscripts(parts, 1) AS i FROM p),
    f AS (SELECT read_id, term, min(i) AS i FROM u WHERE length(term) BETWEEN 2 AND 12 GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY i) AS n FROM f)
    SELECT read_id, term, n::INT AS n FROM r WHERE n <= 60""",
)
def slide_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 60 terms of a slide in order: the limit is the operator's own."""
    rows = reads(spark, sf_dir).filter("slide_text IS NOT NULL").select("read_id", T.terms(F.col("slide_text")).alias("terms")).distinct()
    return rows.select("read_id", F.posexplode("terms").alias("n", "term")).select("read_id", "term", (F.col("n") + 1).alias("n"))


@REGISTRY.add(
    "cue_hash",
    """WITH s AS (SELECT DISTINCT segment_id, video_id, t_start, t_end, transcript_raw FROM segments WHERE transcript_raw IS NOT NULL),
    n AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY segment_id) AS i FROM s)
    SELECT video_id, sha256(string_agg(printf('%d|%.3f|%.3f|%s', i, t_start, t_end, transcript_raw) || chr(10), '' ORDER BY i)) AS raw_hash FROM n GROUP BY video_id""",
)
def cue_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of each video's raw transcript in order."""
    seg = load(spark, sf_dir, "segments").filter("transcript_raw IS NOT NULL").select("segment_id", "video_id", "t_start", "t_end", "transcript_raw").distinct()
    cues = seg.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("segment_id", "t_start", "t_end", "transcript_raw"))).alias("c"))
    numbered = F.transform("c", lambda c, i: F.struct((i + 1).alias("index"), c["t_start"].alias("t_start"), c["t_end"].alias("t_end"), c["transcript_raw"].alias("text")))
    return cues.select("video_id", T.raw_hash(numbered).alias("raw_hash"))


@REGISTRY.add(
    "chunk_links",
    """WITH v AS (SELECT DISTINCT video_id, url FROM videos), s AS (SELECT DISTINCT segment_id, video_id, floor(t_start)::INT AS t FROM segments)
    SELECT segment_id, printf('%02d:%02d:%02d', t // 3600, t // 60 % 60, t % 60) AS clock, url || '&t=' || t || 's' AS link FROM s JOIN v USING (video_id)""",
)
def chunk_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and link of every segment."""
    videos = load(spark, sf_dir, "videos").select("video_id", "url").distinct()
    seg = load(spark, sf_dir, "segments").select("segment_id", "video_id", "t_start").distinct()
    return seg.join(videos, "video_id").select("segment_id", T.clock(F.col("t_start")).alias("clock"), T.deep_link(F.col("url"), F.col("t_start")).alias("link"))


@REGISTRY.add(
    "transcript_signals",
    f"""WITH s AS (SELECT DISTINCT segment_id, t_end - t_start AS d, transcript_raw AS t FROM segments WHERE transcript_raw IS NOT NULL),
    g AS (SELECT segment_id, max(n) AS top FROM (SELECT segment_id, gram, count(*) AS n FROM (SELECT segment_id, unnest({sql_list('t', 6)}) AS gram FROM s WHERE length(t) >= 6) GROUP BY ALL) GROUP BY segment_id)
    SELECT segment_id, round(CASE WHEN d > 0 THEN length(t) / d END, 6) AS chars_per_sec, coalesce(top, 0) AS top_6gram,
      round(CASE WHEN length(t) > 0 THEN len(regexp_extract_all(t, '[，。！？；：、]')) / length(t) END, 6) AS punctuation FROM s LEFT JOIN g USING (segment_id)""",
)
def transcript_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech rate, most frequent 6-gram and punctuation of transcripts."""
    seg = load(spark, sf_dir, "segments").filter("transcript_raw IS NOT NULL").select("segment_id", (F.col("t_end") - F.col("t_start")).alias("d"), F.col("transcript_raw").alias("t")).distinct()
    # Equal grams lie side by side once sorted, so that the longest run is found within the row.
    zero = F.struct(F.lit(None).cast("string").alias("g"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state: Column, gram: Column) -> Column:
        run = F.when(gram == state["g"], state["run"] + 1).otherwise(1)
        return F.struct(gram.alias("g"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    top = F.aggregate(F.sort_array(T.gram_list(F.col("t"), 6)), zero, step, lambda s: s["best"])
    return seg.withColumn("top", top).select(
        "segment_id",
        F.round(F.when(F.col("d") > 0, F.length("t") / F.col("d")), 6).alias("chars_per_sec"),
        F.col("top").cast("bigint").alias("top_6gram"),
        F.round(F.when(F.length("t") > 0, F.regexp_count("t", F.lit("[，。！？；：、]")) / F.length("t")), 6).alias("punctuation"),
    )
