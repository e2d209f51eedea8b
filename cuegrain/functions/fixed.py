"""Fixed values that results depend on: word lists, patterns and tables."""

# Marks that markdown leaves, and what they become.
MARKDOWN = [
    (r"\*\*(.+?)\*\*", "$1"),
    (r"__(.+?)__", "$1"),
    (r"(?s)`{1,3}(.+?)`{1,3}", "$1"),
    (r"(?m)^#{1,6}\s*", ""),
    (r"(?m)^\s*[-*+]\s+", ""),
]
# Phrases that refer to something outside the text.
REFERENTIAL = "如上圖 如下圖 上圖 下圖 前面提到 前述 上述 如前所述 這個式子 這張圖 剛才說的 以下 如右 如左".split()
# Chinese digits, and units of which longer ones come first.
CJK_DIGITS = "零一二三四五六七八九十百千萬億兩"
UNITS = "公分 公尺 公里 公斤 公克 毫升 毫米 世紀 年 月 日 時 分 秒 週 周 天 旬 季 個 張 條 章 卷 篇 位 次 倍 種 類 項 點 步 層 級 成 度 歲 % ％".split()
DIGIT_NAMES = "零一二三四五六七八九"
# Kinds of symbols, in the order in which they claim characters.
SYMBOLS = [
    r"[A-Za-z]{2,}\([^)]{1,20}\)",
    r"\d{1,3}\s*[x×]\s*\d{1,3}",
    r"[A-Za-z][₀-₉ₓᵧ]{1,3}",
    r"(?<![A-Za-z\d])[A-Za-z]_?\d{1,3}(?![\d.])",
]
SUBSCRIPTS = ("₀₁₂₃₄₅₆₇₈₉", "0123456789")
# Stages and the stages that they need.
STAGE_NEEDS = {
    "S0": [],
    "S1a": ["S0"],
    "S1b": ["S0"],
    "S1c": ["S1b"],
    "S3": ["S1a", "S1c"],
    "S4a": ["S3"],
    "S4": ["S4a"],
    "S5": ["S4"],
    "S6": ["S5"],
}
# Thresholds of the checks of derived text against its source.
MIN_SIMILARITY = 0.25
MIN_SIMILARITY_BY_TYPE = {"經文原文": 0.60, "白話解說": 0.10, "口頭延伸": 0.05, "圖表描述": 0.0}
MIN_SOURCE_RATIO, COPY_SIMILARITY = 0.15, 0.98
MIN_CHARS_PER_1K_SOURCE = 100.0
MAX_COPY_BY_TYPE = {"經文原文": 1.0, "圖表描述": 0.5, "白話解說": 0.8, "口頭延伸": 0.8}
# Every threshold by name, and those that are only observed, never a gate.
THRESHOLDS = {
    "min_similarity": MIN_SIMILARITY,
    "min_source_ratio": MIN_SOURCE_RATIO,
    "copy_similarity": COPY_SIMILARITY,
    "min_chars_per_1k_source": MIN_CHARS_PER_1K_SOURCE,
    "needs_review": 0.05,
    "overall_pass_rate": 0.95,
}
OBSERVED_ONLY = {"overall_pass_rate"}


def number_forms() -> dict[str, list[str]]:
    """Ways of writing a number below ten."""
    forms = {}
    for value, name in enumerate(DIGIT_NAMES):
        same = [name, str(value)] + (["兩"] if value == 2 else [])
        forms[name] = same
        forms[str(value)] = same
    forms["兩"] = ["兩", "2", "二"]
    return forms
