"""Plain, single-process versions of the operators, by their definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near_duplicates(rows):
    """rows: (doc_id, text) with distinct ids. doc_id: (n_shingles, component_id)."""
    sets = {}
    for d, t in rows:
        w = words(lower(t))
        sets[d] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    by, parent = defaultdict(list), {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sets:
        for s in sets[d]:
            by[s].append(d)
    common = defaultdict(int)
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def secrets(text):
    """(n_assign, n_access, n_hex, base string)."""
    text = text or ""
    kinds = (
        ("assign", re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(2)) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 24),
    )
    found = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(kinds) for m in p.finditer(text) if ok(m)]
    counts = [sum(f[1] == k for f in found) for k in range(3)]
    return (*counts, ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(found)))


def top_k(rows, k=5, every=50):
    """rows: (vec_id, list) with distinct ids."""
    vectors = {i: [math.floor(256 * float(x)) for x in v] for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q in vectors:
        if q % every == 0:
            scores = [(-sum(a * b for a, b in zip(vectors[q], vectors[c], strict=True)), c) for c in vectors if c != q]
            out[q] = [(r + 1, c, -s) for r, (s, c) in enumerate(sorted(scores)[:k])]
    return out


def substrings(rows):
    """rows: (doc_id, text) with distinct ids. doc_id: (n_words, n_removed, kept_sha256)."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            g = tuple(w[i : i + 20])
            if g in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(g)
        kept = [x for x, y in zip(w, gone, strict=True) if not y]
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    rep = {j for s in at.values() if len(s) > 1 for i in s for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w)


def chat(rows):
    """rows: (turn, role, text) of one conversation: n_turns, turns_sha256, loss_chars, loss_sha256."""
    rows = sorted((t, r or "", x or "") for t, r, x in rows)
    said = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    loss = "".join(x for _, r, x in rows if r == "assistant")
    return len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def runs(w):
    """(start, length, period) of all runs of at least 12 words."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s >= max(q, 12 - q):
                found.setdefault((s, i + q), q)
            i = i + 1 if i == s else i
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs_by_equality(w):
    """``runs`` of a long text: the words q apart compared at once."""
    import numpy as np

    x, found = np.unique(np.array(w, dtype=object), return_inverse=True)[1], {}
    for q in range(1, len(w) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], x[:-q] == x[q:], [0]))))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s >= max(q, 12 - q):
                found.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id, text):
    w, h = words(text), zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return text or ""
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def period_digest(text):
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    w = words(text)
    found = runs_by_equality(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in found), " ".join(x for i, x in enumerate(w) if i not in gone))]
    if not found:
        return 0, None, None, None, None, *digests
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
    return len(found), s, n, q, 1000 * n // q, *digests


def infill(doc_id, text):
    """n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    form = "plain" if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    chars = (None, None) if form == "plain" else (len(p), len(m))
    return len(tokens), form, *chars, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def license_phrases(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    w = license_words(text)
    at = {(i, label) for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")) for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()}
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))
