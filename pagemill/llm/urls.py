r"""URL filters: pattern rules fetched by their rarest literal token, and domain rules by longest match.

A pattern rule is a regular expression with a verdict.  Its literal tokens are the runs of [a-z0-9] of three or more
characters that every match must contain; of these the one that the fewest of the given urls hold becomes its key.
Where groups and optional parts leave a choice, a rule has several keys of which every match holds one.
A url's tokens fetch the rules with those keys, and only these run their expressions.  A rule without any literal
token (of the rules below: the one with ``porn[a-z]*``) has the empty key, which every url fetches.

Domain rules (host suffix and path prefix) come first; the pattern rules judge what no domain rule fits.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no domain rule; pattern rules
see the whole lower-cased url (null: empty); of several that match, the one with the longest pattern decides, allow
before block on a tie; a url that nothing matches is allowed; equal urls get equal verdicts; rows with a null or
repeated page_id stay rows of their own; very long urls are judged whole; other columns stay, whatever their names,
but for those that are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from re import _constants as code
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import quoted, small, whole_row
from pagemill.scratch import written

#: (verdict, host, path)
DOMAIN_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: (verdict, pattern); patterns match anywhere in the lower-cased url.
PATTERN_RULES = (
    ("block", r"/(?:wp-)?login(?:\.php|/|\?|$)"),
    ("block", r"/sign-?in(?:/|\?|$)"),
    ("block", r"/checkout(?:/|\?|$)"),
    ("block", r"/(?:add-to-)?cart(?:/|\?|$)"),
    ("block", r"[?&]phpsessid="),
    ("block", r"[?&]session_?id=[0-9a-f]+"),
    ("block", r"[?&]replytocom=\d+"),
    ("block", r"/calendar/\d{4}/\d{2}"),
    ("block", r"/feed(?:/|\.xml|$)"),
    ("block", r"/xmlrpc\.php"),
    ("block", r"[./-]casino[./-]"),
    ("block", r"[./-]porn[a-z]*[./-]"),
    ("block", r"[./-]torrents?[./-]"),
    ("block", r"\.(?:exe|apk|dmg|zip|iso)(?:\?|$)"),
    ("block", r"[?&]utm_campaign=[^&]*sale"),
    ("allow", r"/wiki/[^?]+$"),
    ("allow", r"/docs?/[^?]+\.html$"),
)
_TOKEN = "[a-z0-9]{3,}"


def literal_tokens(pattern: str) -> list[str]:
    """Runs of [a-z0-9] of 3+ characters that every match holds between other characters, or at which it may go on.

    Whatever is in groups, classes or before a quantifier is left out.  A run counts only if the pattern delimits it
    on both sides by a literal that is no token character, so that it is a whole token of any matching url.
    """
    depth, flat, i = 0, "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            nxt = pattern[i + 1 : i + 2]
            flat += ("\x00" if nxt.isalnum() else nxt) if depth == 0 else ""
            i += 2
        elif c == "[":
            end = pattern.index("]", i + 2)
            inner = pattern[i + 1 : end]
            # A class of delimiters delimits; any other may hold token characters.
            flat += ("/" if not re.search(r"[a-z0-9\\^]", inner) else "\x00") if depth == 0 else ""
            i = end + 1
        elif c in "()":
            depth += 1 if c == "(" else -1
            flat += "\x00"
            i += 1
        elif c in "?*+{":
            end = pattern.index("}", i) + 1 if c == "{" else i + 1
            flat = flat[:-1] + "\x00"
            i = end
        else:
            flat += ("\x00" if c in ".^$" else c) if depth == 0 else ""
            i += 1
    if "|" in flat:
        return []
    return re.findall(rf"(?<=[^a-z0-9\x00])({_TOKEN})(?=[^a-z0-9\x00])", flat)


#: Ways through a pattern that are followed at most.
_WAYS = 256


def _ways(parsed: Iterable) -> list[str]:
    """What each way through a parsed pattern spells: its literals, / for other delimiters and ends, NUL for the unknown."""
    ways = [""]
    for op, arg in parsed:
        if op is code.LITERAL:
            tails = [chr(arg)]
        elif op is code.IN and all(o is code.LITERAL and not re.match("[a-z0-9]", chr(x)) for o, x in arg):
            tails = ["/"]
        elif op is code.AT and arg in (code.AT_BEGINNING, code.AT_END):
            tails = ["/"]
        elif op is code.SUBPATTERN and not arg[1] and not arg[2]:
            tails = _ways(arg[3])
        elif op is code.BRANCH:
            tails = [w for branch in arg[1] for w in _ways(branch)]
        elif op in (code.MAX_REPEAT, code.MIN_REPEAT) and tuple(arg[:2]) == (0, 1):
            tails = ["", *_ways(arg[2])]
        else:
            tails = ["\x00"]
        ways = [w + t for w in ways for t in (tails if len(ways) * len(tails) <= _WAYS else ["\x00"])]
    return ways


def token_sets(pattern: str) -> list[list[str]]:
    """Sets of tokens; every match of the pattern holds, as a whole token, at least one of each set."""
    ways = [re.findall(rf"(?<=[^a-z0-9\x00])({_TOKEN})(?=[^a-z0-9\x00])", w) for w in _ways(parser.parse(pattern))]
    common = set(literal_tokens(pattern)).union(set.intersection(*map(set, ways)))
    others = [[t for t in w if t not in common] for w in ways]
    choice = sorted({max(w, key=lambda t: (len(t), t)) for w in others}) if all(others) else []
    return [[t] for t in sorted(common)] + ([choice] if len(choice) > 1 else [])


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    url = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, parts, 2)


def domain_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, suffix, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == suffix) | F.endswith(host, F.lit("." + suffix))) & F.startswith(path, F.lit(prefix))
        rule, verdict = F.when(fits, suffix + prefix).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def pattern_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls``: url; ``rules``: pattern, kind, tokens (sets of which every match holds a token). Returns url, pattern, kind for each distinct url that a rule matches."""
    rules = rules.dropDuplicates(["pattern"])
    # A url has a row for each of its tokens, with its hash alone: the url would be copied as often as it is long.  Urls of
    # one hash are tested for each other's rules, too; the pattern decides.
    low = F.lower(F.coalesce("url", F.lit("")))
    urls = written(urls.select("url").distinct().select("url", F.xxhash64("url").alias("at")), "urls")
    tokens = F.array_distinct(F.concat(F.regexp_extract_all(low, F.lit(f"({_TOKEN})"), F.lit(1)), F.array(F.lit(""))))
    words = urls.select("at", F.explode(tokens).alias("token"))
    keys = rules.select("pattern", F.posexplode_outer("tokens").alias("at", "set")).select("pattern", "at", F.explode_outer("set").alias("token")).withColumn("token", F.coalesce("token", F.lit("")))
    names = small(keys.select("token").distinct())
    held = words.join(names, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    sets = keys.join(held, "token", "left").groupBy("pattern", "at").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.array_sort(F.collect_set("token")).alias("set"))
    rarest = sets.groupBy("pattern").agg(F.min_by("set", F.struct("n", "set")).alias("set")).select("pattern", F.explode("set").alias("token"))
    index = written(rules.select("pattern", "kind").join(rarest, "pattern"), "url-index")
    asked = words.join(small(index), "token").select("at", "pattern", "kind")
    found = urls.join(asked, "at").withColumn("low", low).filter("regexp_like(low, pattern)")
    best = F.max(F.struct(F.length("pattern").alias("len"), F.when(F.col("kind") == "allow", 1).otherwise(0).alias("ok"), "pattern", "kind")).alias("m")
    return found.groupBy("url").agg(best).select("url", "m.pattern", "m.kind")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]] = PATTERN_RULES) -> DataFrame:
    """Pattern rules as a table of literals (no Python on the executors); larger sets can be read from storage instead."""
    strings = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    sets = lambda p: F.array(*map(strings, token_sets(p))).cast("array<array<string>>")
    rows = [F.struct(F.lit(p).alias("pattern"), F.lit(k).alias("kind"), sets(p).alias("tokens")) for k, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(pages: DataFrame, domains: Sequence[tuple[str, str, str]] = DOMAIN_RULES, patterns: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule, pattern and verdict (columns of these names are replaced)."""
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "pattern", "verdict")]
    # The caller's row is one column, so that no name of its columns can meet one of ours.
    rows = pages.select(whole_row(pages, keep).alias("row"), F.coalesce(pages["url"], F.lit("")).alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, kind = domain_rule(F.col("host"), F.col("path"), domains)
    rows = rows.withColumns({"rule": rule, "kind": kind})
    rules = patterns if patterns is not None else rule_table(pages.sparkSession)
    hits = written(pattern_verdicts(rows.filter("kind IS NULL").select("url"), rules), "url-hits")
    hits = hits.select(F.col("url").alias("hit"), "pattern", F.col("kind").alias("found"))
    out = rows.join(small(hits), F.col("kind").isNull() & (F.col("url") == F.col("hit")), "left")
    return out.select(*[F.col("row." + quoted(c)) for c in keep], "host", "path", "rule", "pattern", F.coalesce("kind", "found", F.lit("allow")).alias("verdict"))
