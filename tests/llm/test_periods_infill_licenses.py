"""Periodic runs, fill-in-the-middle and license scans against plain versions, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import brute
import numpy as np
import pytest

from pagemill.llm import infill, licenses, periods, queries

CLASHING = "doc_id long, text string, n int, form int, runs int, words int, spans int, h int, p int, start int"


def documents(spark, rows):
    """rows: (doc_id, text); the other columns bear names that the operators use."""
    return spark.createDataFrame([(d, t, *[0] * 8) for d, t in rows], CLASHING)


def repeating(rng, n, period, letters):
    """Random words with a periodic stretch of about four periods in their midst."""
    w = [f"w{rng.randrange(letters)}" for _ in range(n)]
    begin = rng.randrange(max(1, n - 2 * period))
    for i in range(begin + period, min(n, begin + 4 * period)):
        w[i] = w[i - period]
    return w


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b " * 30), (6, "x " * 11), (7, "x " * 12), (None, "y " * 40), (None, "u v w " * 9), (8, "a b " * 30), (8, "a b " * 30), (8, "c d e " * 30)]
    out += [(100 + i, " ".join(repeating(rng, rng.randrange(1, 400), rng.randrange(1, 60), rng.choice([2, 3, 1000])))) for i in range(60)]
    return out + [(20 + i, "same passage of words again and again, " * 4) for i in range(30)]


# 11


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_parts(seed):
    rng = random.Random(seed)
    parts = [repeating(rng, rng.randrange(1, 150), rng.randrange(1, 40), rng.choice([1, 2, 3, 50])) for _ in range(40)]
    codes = [np.array([int(x[1:]) for x in p], dtype=np.int64) for p in parts]
    part, start, end, period = periods.solve(codes)
    for i, p in enumerate(parts):
        found = {}
        for s, e, q in zip(start[part == i], end[part == i], period[part == i], strict=True):
            found[s, e] = min(q, found.get((s, e), q))
        assert sorted((s, e - s, q) for (s, e), q in found.items()) == brute.runs(p)


def test_every_short_stretch_is_in_a_tile():
    for n in (13, 4096, 4097, 50_000):
        of: dict = {}
        for first, end, at, to in periods.tiles(n):
            of.setdefault((first, end), []).append((at, to))
        assert [x[0] for x in sorted(of)] == [0, *range(periods.FEW, periods.FEW + len(of) - 1)]
        assert 1 << max(e for _, e in of) > n // 2
        for (_, end), spans in of.items():
            assert spans[0][0] == 0 and spans[-1][1] == n
            # A run's two longest periods may begin anywhere.
            assert all(to == n or b + max(periods.LEAST, 2 * ((1 << end) - 1)) <= to + 1 for (_, to), (b, _) in zip(spans, spans[1:], strict=False))


def test_equal_hashes_are_found_out(monkeypatch):
    monkeypatch.setattr(periods, "mixed", lambda x: x & np.uint64(1))
    w = [*range(40), *range(100, 110), *range(100, 110), *range(100, 105), *range(200, 240)]
    _, s, e, q = periods.solve([np.array(w)])
    assert (40, 65, 10) in set(zip(s.tolist(), e.tolist(), q.tolist(), strict=True))
    assert all(w[a : b - p] == w[a + p : b] for a, b, p in zip(s.tolist(), e.tolist(), q.tolist(), strict=True))


def check_periods(got, rows):
    assert len(got) == len(rows)
    want = sorted((repr(d), *brute.period_digest(t)) for d, t in rows)
    assert sorted((repr(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got) == want


def test_periods(spark, rows):
    check_periods(periods.period_digest(documents(spark, rows)).collect(), rows)


def test_periods_of_dealt_tiles(spark, rows, monkeypatch):
    """Long texts: tiles of several octaves, runs that reach over many of them."""
    rng = random.Random(9)
    long = [(500 + i, " ".join(repeating(rng, n, p, a))) for i, (n, p, a) in enumerate([(30_000, 7, 5000), (30_000, 3000, 5000), (20_000, 900, 10**6), (9_000, 4_400, 10**6), (6_000, 1, 10**6), (5_000, 300, 3)])]
    long += [(600, "z " * 9_000), (601, " ".join(f"k{i % 2500}" for i in range(9_000))), (602, " ".join(f"k{i}" for i in range(9_000))), (602, " ".join(f"k{i}" for i in range(9_000)))]
    docs = documents(spark, rows[:12] + long)
    scan = periods.scanned(docs)
    assert scan.filter("tile IS NOT NULL").groupBy("doc_id", "first").count().filter("count > 1").count() > 5
    want = sorted((d, *r) for d, t in dict(long).items() for r in brute.runs_by_equality(t.split()))
    got = periods.runs(documents(spark, long)).collect()
    assert sorted((r.doc_id, r.start, r.length, r.period) for r in got) == want


def test_collapsed_words(spark):
    out = {r.doc_id: r for r in periods.collapsed(documents(spark, [(1, "go " + "a b c " * 5 + "end"), (2, "no run\nhere")])).collect()}
    assert out[1].collapsed == "go a b c end" and [tuple(r) for r in out[1].runs] == [(1, 15, 3)] and out[1].n_words == 17
    assert out[2].collapsed is None and out[2].collapsed_sha256 == hashlib.sha256(b"no run here").hexdigest()


def test_planted(spark, rows):
    rows = [(d, t) for d, t in rows if d is not None]
    got = sorted((r.doc_id, r.text or "") for r in periods.planted(documents(spark, rows)).collect())
    assert got == sorted((d, brute.planted(d, t)) for d, t in rows)
    assert sum(a[1] != (b[1] or "") for a, b in zip(got, sorted((d, t or "") for d, t in rows), strict=True)) >= 3


def test_query_of_periods(spark, sf):
    rows = [(r.doc_id, brute.planted(r.doc_id, r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_periods(queries.op11_periods(spark, sf).collect(), rows)


# 12


def test_ranks():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 4, n).astype(np.uint8)
        m, at = infill.WaveletMatrix(s), np.arange(n + 1)
        for c in range(4):
            assert m.rank(c, at).tolist() == [int((s[:i] == c).sum()) for i in range(n + 1)]


def check_infill(got, rows):
    assert sorted((repr(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in got) == sorted((repr(d), *brute.infill(d, t)) for d, t in rows)


def test_infill(spark, rows, monkeypatch):
    more = [(1000 + i, t) for i, t in enumerate(["<P>", "x <S> y", "a<M", "é€𝄞 ab-é1é\n\r\n", "ß" * 70, "é", "A", "<", "<P", "a\0b", "word " * 40_000, "𝄞a" * 500])]
    more += [(2000 + i, f"Ab{i} é, c<P d<S> e" if i % 9 == 0 else f"Ab{i} é, c<P d<S e<M𝄞") for i in range(200)]
    check_infill(infill.infill_digest(documents(spark, rows + more)).collect(), rows + more)
    assert {brute.infill(d, t)[1] for d, t in more} == {"plain", "psm", "spm"}


def test_infill_in_small_groups(rows, monkeypatch):
    """Texts that share the work, and longer ones alone."""
    monkeypatch.setattr(infill, "TOGETHER", 50)
    import pyarrow as pa

    texts = [t for _, t in rows] * 2
    n = len(texts)
    h = pa.array(range(7, 7 + n), pa.int64())
    for offset in (0, 3):
        columns = [x.slice(offset) for x in (pa.array(texts, pa.string()), pa.array([False] * n), pa.array([i % 2 == 0 for i in range(n)]), h, h)]
        out = next(infill._transformed(iter([tuple(columns)]))).to_pylist()
        for i, r in enumerate(out, offset):
            tokens = re.findall("[A-Za-z]+|[^A-Za-z]", texts[i] or "")
            k = (7 + i) % (len(tokens) + 1)
            p, s = "".join(tokens[:k]), "".join(tokens[k:])
            assert (r["n"], r["prefix_chars"], r["middle_chars"]) == (len(tokens), len(p), 0)
            assert r["output"] == (f"<S>{s}<P>{p}<M>" if i % 2 == 0 else f"<P>{p}<S>{s}<M>")


def test_infill_of_nothing(spark):
    assert infill.infill_digest(documents(spark, [])).count() == 0
    assert periods.period_digest(documents(spark, [])).count() == 0
    assert licenses.license_digest(documents(spark, [])).count() == 0


# 13


def pattern(template):
    """The template as a regular expression over words with a space before each."""
    out = ""
    for t in re.findall(r"<<[^>]*>>|[^\s<>]+", template):
        if t == "<<optional>>":
            out += "(?:"
        elif t == "<<end>>":
            out += ")?"
        elif t.startswith("<<any"):
            least, most = t[6:-2].split("-")
            out += f"(?: [^ ]+){{{least},{most}}}"
        else:
            out += " " + re.escape(t)
    return out


def accepted(template, words):
    """(start, end) of the longest accepted stretches, from left to right, by trying all ends."""
    p, out, done = re.compile(pattern(template)), [], 0
    for i in range(len(words)):
        if i >= done:
            ends = [j for j in range(len(words), i, -1) if p.fullmatch("".join(" " + w for w in words[i:j]))]
            if ends:
                out.append((i, ends[0]))
                done = ends[0]
    return out


SMALL = [("x", "a <<optional>>b <<optional>>c<<end>> d<<end>> e"), ("y", "<<optional>>b<<end>> c <<any 0-2>> a <<any 1-2>>"), ("z", "<<optional>>a<<end>> <<optional>>b<<end>> e <<optional>><<any 1-3>> c<<end>>"), ("w", "d")]


@pytest.mark.parametrize("label, template", SMALL)
def test_automaton(label, template):
    rng, scanner = random.Random(label), licenses.Scanner({}, [(label, template)])
    hits = 0
    for _ in range(400):
        words = [rng.choice("aabbccddeef") for _ in range(rng.randrange(1, 16))]
        got = [(s, e) for s, e, _, _ in scanner.spans(" ".join(words).encode())[1]]
        assert got == accepted(template, words)
        hits += bool(got)
    assert hits > 50


def written_out(template, rng, optional):
    """A text that a template accepts."""
    while "<<optional>>" in template:
        template = re.sub(r"<<optional>>((?:(?!<<optional>>|<<end>>).)*)<<end>>", lambda m: m.group(1) if optional else "", template)
    template = re.sub(r"<<any (\d+)-(\d+)>>", lambda m: " ".join(f"Name{i}" for i in range(rng.randint(int(m.group(1)), int(m.group(2))))), template)
    return "".join(w + rng.choice([" ", ", ", ".\n", " (\"", " -- "]) for w in template.split())


@pytest.mark.parametrize("n", range(len(licenses.TEMPLATES)))
def test_templates(n):
    label, template = licenses.TEMPLATES[n]
    rng, scanner = random.Random(n), licenses.Scanner({}, licenses.TEMPLATES)
    for optional in (False, True):
        text = written_out(template, rng, optional)
        words = re.findall("[a-z0-9]+", text.lower())
        found = scanner.spans(f"Some preface here. {text.upper()} and the rest".encode())[1]
        assert any(s == 3 and e == 3 + len(words) and x == label for s, e, x, _ in found)
    if label == "all-rights-reserved":
        return  # a changed word of its optional part is one of the free ones
    mandatory = [i for i, w in enumerate(words) if not w.startswith("name")]
    for i in rng.sample(mandatory, min(12, len(mandatory))):
        # With a mandatory or optional word changed the whole is not accepted; what stays accepted is less.
        changed = " ".join([*words[:i], "otherword", *words[i + 1 :]])
        assert not [s for s in scanner.spans(changed.encode())[1] if s[2] == label and s[:2] == (0, len(words))]


def check_licenses(got, rows):
    assert sorted((repr(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == sorted((repr(d), *brute.license_phrases(t)) for d, t in rows)
    texts = sorted((repr(d), t or "") for d, t in rows)
    for r, (_, t) in zip(sorted(got, key=lambda r: (repr(r.doc_id), r.n_words)), sorted(texts, key=lambda x: (x[0], len(brute.license_words(x[1])))), strict=True):
        words, covered, labels = brute.license_words(t), set(), set()
        line = "".join(" " + w for w in words)
        for label, template in licenses.TEMPLATES:
            if re.search(pattern(template) + "(?![^ ])", line):
                spans = accepted(template, words)
                labels |= {label} if spans else set()
                covered |= {i for s, e in spans for i in range(s, e)}
        for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
            k = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(k)] == k]
            labels |= {label} if at else set()
            covered |= {i + j for i in at for j in range(len(k))}
        assert r.labels == ",".join(sorted(labels))
        assert r.score == pytest.approx(len(covered) / len(words) if words else 0.0) and 0 <= r.score <= 1


def test_licenses(spark, rows):
    rng = random.Random(1)
    more = [(3000 + i, f"Intro é{i}. {written_out(t, rng, i % 2 == 0)}") for i, (_, t) in enumerate(licenses.TEMPLATES)]
    more += [(4000, "Under the MIT license; under\tthe\nmit LICENSE?"), (4001, "under the mit licenses"), (4002, "cc-by-nc cc by nc CC_BY_NC"), (4003, "éunder the mit license"), (4004, "Copyright (c) 2019 Someone. All rights reserved."), (4005, "Under the İMIT license K"), (4006, "This work is licensed under the GNU General Public License, version 3.")]
    got = licenses.license_digest(documents(spark, rows + more)).collect()
    check_licenses(got, rows + more)
    of = {r.doc_id: r for r in got}
    assert (of[4006].labels, of[4006].base_labels, of[4006].score) == ("gpl-3", "", 9 / 12)


def test_query_of_licenses(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_licenses(queries.op13_licenses(spark, sf).collect(), rows)


def test_a_template_opens_with_a_word():
    for bad in ("<<any 0-3>> a", "<<optional>>a<<end>>", "<<optional>>a"):
        with pytest.raises(ValueError):
            licenses.Automaton(bad)


def test_crc_of_ids():
    assert brute.planted(0, "a b") == ("a b" if zlib.crc32(b"0") % 10 else brute.planted(0, "a b"))
