"""Text functions as Spark columns.

Character classes are spelled out where Java's, Python's and SQL engines' defaults differ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that OCR scoring counts as common English.
COMMON_WORDS = (
    "the be to of and a in that have i "
    "it for not on with he as you do at "
    "this but his by from they we say her she "
    "or an will my one all would there their what"
).split()
# Characters that OCR leaves in place of damaged print.
SCAN_SYMBOLS = "^~|_*\\§#<>{}[]=@`"
#: First month of each season but winter, which takes December to February.
SEASONS = {3: "Spring", 6: "Summer", 9: "Fall"}


def blank_to(c: Column, default) -> Column:
    """``default`` where ``c`` is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def words(text: Column) -> Column:
    """Whitespace-separated words (Unicode whitespace), none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def terms(text: Column) -> Column:
    """Lower-case terms of [a-z0-9]."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def stem_of(term: str) -> str:
    """``stem`` of a single word of a query."""
    rules = (("ies", 4, 3, "y"), ("es", 3, 2, ""), ("s", 3, 1, ""), ("ing", 5, 3, ""), ("ed", 4, 2, ""))
    for end, longer, cut, to in rules:
        if term.endswith(end) and len(term) > longer and not (end == "s" and term.endswith("ss")):
            return term[:-cut] + to
    return term


def variants(stemmed: str) -> list[str]:
    """All words with this stem."""
    forms = [stemmed + end for end in ("", "s", "es", "ing", "ed")] + ([stemmed[:-1] + "ies"] if stemmed.endswith("y") else [])
    return [f for f in forms if stem_of(f) == stemmed]


def stem(term: Column) -> Column:
    """Light English stemming: plural, -ing and -ed endings of words that are long enough."""
    n = F.length(term)
    cut = lambda k: F.left(term, n - k)
    rules = (
        (term.endswith("ies") & (n > 4), F.concat(cut(3), F.lit("y"))),
        (term.endswith("es") & (n > 3), cut(2)),
        (term.endswith("s") & ~term.endswith("ss") & (n > 3), cut(1)),
        (term.endswith("ing") & (n > 5), cut(3)),
        (term.endswith("ed") & (n > 4), cut(2)),
    )
    return F.coalesce(*(F.when(test, to) for test, to in rules), term)


def clean_title(title: Column) -> Column:
    """A publication's title without place and years; the title itself if nothing would be left."""
    short = F.trim(F.regexp_replace(title, r"\s*\([^)]*\).*", ""))
    for years in (r"\d{4}[-–][\d?]{4}$", r"\d{4}$"):
        short = F.trim(F.regexp_replace(short, years, ""))
    return F.coalesce(F.nullif(short, F.lit("")), title)


def slug(text: Column, joint: str = "_") -> Column:
    """Lower case, letters, digits and joints only."""
    kept = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s-]", ""))
    return F.regexp_replace(kept, r"[-\s]+", joint)


def season(month: Column) -> Column:
    out = F.lit("Winter")
    for first, name in SEASONS.items():
        out = F.when(month.between(first, first + 2), name).otherwise(out)
    return F.when(month.between(1, 12), out)


def snippet(text: Column, length: int = 260) -> Column:
    """Whitespace collapsed, cut at a word and marked by an ellipsis if longer than ``length``."""
    flat = F.trim(F.regexp_replace(text, r"[\s]+", " "))
    head = F.substring(flat, 1, length)
    return F.when(F.length(flat) <= length, flat).otherwise(F.concat(F.when(head.contains(" "), F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head), F.lit(" …")))


def size_bytes(text: Column) -> Column:
    """"12.3 MB" as bytes, truncated; 0 unless it is a number and a known unit."""
    parts = F.split(F.trim(text), r"\s+")
    number, unit = F.get(parts, F.lit(0)).try_cast("double"), F.upper(F.get(parts, F.lit(1)))
    factor = F.when(unit.contains("KB"), 1 << 10).when(unit.contains("MB"), 1 << 20).when(unit.contains("GB"), 1 << 30).when(unit.contains("BYTES"), 1)
    return F.coalesce(F.when(F.size(parts) == 2, (number * factor).cast("long")), F.lit(0).cast("long"))


def int_or(text: Column, default: int) -> Column:
    """An all-digit string as int, else ``default``."""
    return F.coalesce(F.when(text.rlike("^[0-9]+$"), text.try_cast("int")), F.lit(default))


def string_list(json_or_csv: Column) -> Column:
    """A JSON list of strings; what is not one is split at commas."""
    split = F.filter(F.transform(F.split(json_or_csv, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.from_json(json_or_csv, "array<string>"), split)


def near_terms(term: Column, wanted: str, most: int | None = None) -> Column:
    """Is a term within the edit distance that its length allows (1, or 2 from 8 letters on)?"""
    most = min(most or (1 if len(wanted) < 8 else 2), 2)
    return F.levenshtein(term, F.lit(wanted), most) >= 0


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def ocr_quality(text: Column) -> Column:
    """Ratios of characters and words, and a score that steps down where a ratio is out of its usual range."""
    text = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    whole = lambda pattern: f"(?<![a-zA-Z])(?:{pattern})(?![a-zA-Z])"
    counted = F.struct(
        F.length(text).alias("chars"), without(r"\p{L}+").alias("letters"), (F.length(text) - F.length(F.translate(text, SCAN_SYMBOLS, ""))).alias("symbols"),
        count("[a-zA-Z]+").alias("n"), without("[a-zA-Z]+").alias("plain"), count("[a-zA-Z]*[aeiouyAEIOUY][a-zA-Z]*").alias("voiced"),
        count("(?i)" + whole("|".join(COMMON_WORDS))).alias("common"), count(whole("[b-hj-zB-HJ-Z]")).alias("single"),
    )
    # A list of one: its element's counts are worked out once and used many times.
    return F.get(F.transform(F.array(counted), _scored), F.lit(0))


def _scored(c: Column) -> Column:
    n = c["n"]
    ratios = {"alpha_ratio": _ratio(c["letters"], c["chars"]), "symbol_noise": _ratio(c["symbols"], c["chars"]), "vowel_ratio": _ratio(c["voiced"], n), "common_ratio": _ratio(c["common"], n), "fragmentation": _ratio(c["single"], n)}
    # Fixed values: (ratio, is it worse below?, (limit, penalty) from the worst on); all penalties in hundredths
    steps = (
        ("alpha_ratio", True, ((0.60, 35), (0.72, 15))),
        ("symbol_noise", False, ((0.03, 30), (0.01, 15))),
        ("vowel_ratio", True, ((0.80, 30), (0.90, 15))),
        ("common_ratio", True, ((0.10, 25), (0.18, 10))),
        ("fragmentation", False, ((0.10, 25),)),
    )
    penalty = F.lit(0)
    for name, below, limits in steps:
        r = ratios[name]
        penalty = penalty + F.coalesce(*(F.when(r < at if below else r > at, by) for at, by in limits), F.lit(0))
    score = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0), 100 - penalty) / 100)
    mean = _ratio(c["plain"], n)
    return F.struct(*(F.round(r, 3).alias(k) for k, r in ratios.items()), F.round(mean, 2).alias("mean_word"), n.cast("long").alias("n_words"), score.alias("score"))


def ocr_verdict(lexical: Column, noise: Column, flaws: Column, gibberish: Column) -> tuple[Column, Column]:
    """Composite score (0 to 100) and verdict from the lexical score and a model's probabilities."""
    health = F.least(F.greatest(F.lit(0.0), 1 - (0.6 * noise + 0.4 * flaws)), 1 - gibberish)
    score = F.rint(50 * health + 50 * lexical).cast("int")
    bad = (score <= 45) | (noise >= 0.55) | (lexical <= 0.35) | (gibberish >= 0.70)
    return score, F.when((score >= 70) & (noise < 0.35) & (lexical >= 0.65), "GOOD_OCR").when(bad, "BAD_OCR").otherwise("MARGINAL_OCR")


def normalized_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Corners in 0..1000 of a page; halves round to even, a missing page size counts as 1000."""

    def scaled(v: Column, of: Column) -> Column:
        of = F.greatest(F.coalesce(F.nullif(of, F.lit(0)), F.lit(1000)), F.lit(1))
        return F.least(F.greatest(F.rint(v / of * 1000), F.lit(0)), F.lit(1000)).cast("short")

    x, y = (F.greatest(F.coalesce(v, F.lit(0)), F.lit(0)) for v in (x, y))
    w, h = (F.greatest(F.coalesce(v, F.lit(0)), F.lit(0)) for v in (w, h))
    return F.array(scaled(x, width), scaled(y, height), scaled(x + w, width), scaled(y + h, height))
