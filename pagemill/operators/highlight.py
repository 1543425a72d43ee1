"""Marking a query's terms in texts, with Spark expressions over a text's tokens."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import stem

_TOKENS = r"([A-Za-z0-9]+(?:'[A-Za-z]+)?|[^A-Za-z0-9]+)"


def escaped(text: Column) -> Column:
    out = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def highlight(text: Column, terms: Sequence[str] = (), prefixes: Sequence[str] = (), fuzzy: Sequence[tuple[str, int]] = (), patterns: Sequence[str] = ()) -> Column:
    """HTML of ``text`` with each word marked that has the stem of a term, a prefix of four letters or more, lies
    within a term's edit distance (2 at most), or matches a pattern."""
    wanted = [t.lower() for t in terms]

    def marked(token: Column) -> Column:
        low = F.lower(token)
        tests = [stem(low) == stem(F.lit(t)) for t in wanted]
        tests += [low.startswith(p.lower()) for p in prefixes if len(p) >= 4]
        tests += [F.levenshtein(low, F.lit(t.lower()), min(d, 2)) >= 0 for t, d in fuzzy]
        tests += [low.rlike(f"^(?:{p})$") for p in patterns]
        hit = token.rlike("^[A-Za-z0-9]") & reduce(or_, tests) if tests else F.lit(False)
        return F.when(hit, F.concat(F.lit('<mark class="hl">'), escaped(token), F.lit("</mark>"))).otherwise(escaped(token))

    return F.array_join(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKENS), F.lit(1)), marked), "")


def query_marks(query: Column) -> Column:
    """The parts of a query string that are more than plain words: phrases, slop, fuzzy, boosts, patterns."""
    found = lambda p: F.regexp_extract_all(query, F.lit(p), F.lit(1))
    return F.struct(found(r'("[^"]+")(?![~0-9])').alias("phrases"), found(r'("[^"]+"~\d+)').alias("slop"), found(r"(?<![\w\"])([A-Za-z]+~\d*)").alias("fuzzy"), found(r"(\S+\^[\d.]+)").alias("boosts"), found(r"(/[^/\s][^/]*/)").alias("patterns"))


def plain_terms(query: str) -> list[str]:
    """The words of a query without operators, exclusions, numbers of slop or boost, and field names."""
    kept = re.sub(r"-\S+|\bNOT\s+\S+|[~^][\d.]*|\b(?:text|title|body|content):|/[^/]*/", " ", query)
    return [w for w in re.findall(r"[A-Za-z0-9]+", kept) if w not in ("AND", "OR", "NOT", "TO")]
