"""Secret scans with multipart credential linking.

Base spans are what the three patterns find.  Credentials are often split: an access identifier, a secret and an
endpoint stand near each other, and the secret alone looks like any long token.  So identifiers, endpoints and
weak secret candidates of a text become intervals, and an interval join within scopes of SCOPE code points reports
a weak candidate only if complementary parts lie in its scope: an identifier, or an endpoint if a key word also names
the candidate (``token=``, ``"secret": ``).  Each is reported with the parts that it is linked to.  The parts of a
text never leave its row, so the join runs on sorted starts inside the task.

A candidate may be a value (``key=...``) and may stand inside its endpoint: the password in an endpoint's userinfo
(``://user:password@``, of 6 characters or more, whatever the scheme) has its identifier and endpoint beside it, and an
endpoint is complementary to a candidate among its own parameters (after ``?`` or ``#``).  To a candidate in its own
path it is not: long paths are no secrets.

Defined cases: a null text is empty; repeated rows each get their spans; very long texts are searched whole; an empty
table gives no rows; other columns stay, whatever their names, but for ``spans``, which is replaced.  Positions are
code points, ends exclusive.  Added spans never overlap base spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order; the last is what the linking adds.
KINDS = ("assign", "access", "hex", "linked")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Longest runs; shorter ones need not be looked at, since a run is matched from its first character on.
HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Parts for linking.
IDENTIFIER = re.compile(r"""(?:client_?id|access_?key(?:_?id)?|account(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"""(?:https?|s3|ftp|postgres(?:ql)?|mysql|mongodb)://[^\s"'<>]{4,}|\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}""", re.IGNORECASE | re.ASCII)
WEAK = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
#: User and password; a password with slashes, which a URL should not hold, must look secret.
USERINFO = re.compile(r"""://([^\s"'<>/?#:@]*):([^\s"'<>/?#]{6,}|[A-Za-z0-9+/_=-]{20,})@""")
#: What names a secret, right before it.
KEYWORD = re.compile(r"""(?:key|secret|token|pass(?:word|wd|phrase)?|pwd|auth(?:orization)?|bearer|credentials?|sig(?:nature)?)[A-Za-z0-9_.-]{0,16}["']?\x20*[:=\x20]\x20*["']?$""", re.IGNORECASE | re.ASCII)
#: Code points before a candidate in which its key word is looked for.
NAME = 40
#: Greatest distance, in code points, between parts of one credential.
SCOPE = 240


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), ordered by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _looks_secret(token: str) -> bool:
    return bool(re.search(r"[0-9]", token) and re.search(r"[a-z]", token) and re.search(r"[A-Z]", token)) and len(set(token)) >= 10


def _near(parts: list[tuple[int, int]], start: int, end: int) -> tuple[int, int] | None:
    """The nearest of the intervals, ascending and apart, that lies within SCOPE of [start, end) without overlapping it."""
    before, after = bisect_right(parts, start, key=lambda p: p[1]) - 1, bisect_left(parts, end, key=lambda p: p[0])
    found = [p for p in (parts[before] if before >= 0 else None, parts[after] if after < len(parts) else None) if p]
    found = [(max(start - p[1], p[0] - end), p) for p in found]
    return min((f for f in found if f[0] <= SCOPE), default=(0, None))[1]


def _around(endpoints: list[tuple[int, int]], text: str, start: int) -> tuple[int, int] | None:
    """The interval that ``start`` lies in, after its ``?`` or ``#``."""
    i = bisect_right(endpoints, start, key=lambda p: p[0]) - 1
    inside = i >= 0 and start < endpoints[i][1] and any(text.find(c, endpoints[i][0], start) >= 0 for c in "?#")
    return endpoints[i] if inside else None


#: A secret's start and end, and (kind, start, end) of what it is linked to.
Credential = tuple[int, int, list[tuple[str, int, int]]]


def credentials(text: str, base: list[tuple[int, int, str]]) -> list[Credential]:
    """Secrets that no base span covers, by start, each with its complementary parts."""
    users = [m for m in USERINFO.finditer(text) if "/" not in m[2] or _looks_secret(m[2])] if "://" in text else []
    passwords = [m.span(2) for m in users]
    weak = [m.span() for m in WEAK.finditer(text) if _looks_secret(m.group())]
    if not weak and not passwords:
        return []
    taken = _flat(sorted((s, e) for s, e, _ in base))
    starts = [t[0] for t in taken]
    free = lambda s, e: (i := bisect_left(starts, e) - 1) < 0 or taken[i][1] <= s
    out: list[Credential] = [(*m.span(2), [*([("identifier", *m.span(1))] if m[1] else []), ("endpoint", *m.span())]) for m in users if free(*m.span(2))]
    identifiers = _flat(sorted([m.span() for m in IDENTIFIER.finditer(text)] + [(s, e) for s, e, k in base if k == "access"] + [m.span(1) for m in users if m[1]]))
    endpoints = [m.span() for m in ENDPOINT.finditer(text)]
    for s, e in weak:
        i = bisect_right(passwords, s, key=lambda p: p[0]) - 1
        if not free(s, e) or (i >= 0 and passwords[i][1] > s):
            continue
        identifier, endpoint = _near(identifiers, s, e), _near(endpoints, s, e) or _around(endpoints, text, s)
        if identifier or (endpoint and KEYWORD.search(text[max(0, s - NAME) : s])):
            out.append((s, e, [(k, *p) for k, p in (("identifier", identifier), ("endpoint", endpoint)) if p]))
    return sorted(out)


def _flat(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def all_spans(text: str) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    return sorted(base + [(s, e, "linked") for s, e, _ in credentials(text, base)], key=lambda s: (s[0], KINDS.index(s[2])))


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by a mark; overlapping spans become one."""
    if not text:
        return text
    out, at = [], 0
    for s, e in _flat([(s, e) for s, e, _ in all_spans(text)]):
        out += [text[at:s], "[secret]"]
        at = e
    return "".join([*out, text[at:]])


_SPANS = "array<struct<start int, rank int, end int, kind string, parts array<struct<kind string, start int, end int>>>>"


def _struct(start: int, end: int, kind: str, parts: list[tuple[str, int, int]]) -> dict:
    return {"start": start, "rank": KINDS.index(kind), "end": end, "kind": kind, "parts": [{"kind": k, "start": s, "end": e} for k, s, e in parts]}


def _found(text: str) -> list[dict]:
    base = base_spans(text)
    out = [_struct(*b, []) for b in base] + [_struct(s, e, "linked", parts) for s, e, parts in credentials(text, base)]
    return sorted(out, key=lambda x: (x["start"], x["rank"]))


def _spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([_found(t or "") for t in texts], index=texts.index, dtype=object)


def _redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(redacted, na_action="ignore")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: start, rank, end, kind, parts (of linked ones), in order (replaces a column of that name)."""
    return docs.withColumn("spans", F.pandas_udf(_spans, _SPANS)("text"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced; ``n_chars``, if there, follows."""
    out = docs.withColumn("text", F.pandas_udf(_redact, "string")("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def secrets_digest(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != "linked")
    named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    join = lambda spans: F.array_join(F.transform(spans, named), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    links = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] == "linked"), lambda s: F.concat(named(s), F.lit("<"), F.array_join(F.transform(s["parts"], named), "+"))), ",")
    return found.select("doc_id", *map(count, KINDS), F.sha2(join(base), 256).alias("base_sha256"), join("spans").alias("spans"), links.alias("links"))
