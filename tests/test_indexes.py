"""The inverted index, its phrases and its vocabulary against plain versions."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pagemill.functions.text import stem_of
from pagemill.operators import postings, vocabulary
from pagemill.operators.postings import Index
from pagemill.operators.vocabulary import Vocabulary

ROWS = "ns string, key long, text string"


def words_of(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def rows(n, seed, rare="zebra"):
    rng = random.Random(seed)
    words = ["the", "of", "cats", "cat", "hats", "running", "run", "old"]
    out = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(1, 60))] + ([rare] if rng.random() < 0.02 else [])
        out.append((f"n{i % 2}", 1000 * seed + i, " ".join(w)))
    return out


def best(docs, query, k):
    """(ns, key, score, rank) by the formula, over all documents."""
    out = []
    for ns in {d[0] for d in docs}:
        mine = {key: [stem_of(w) for w in words_of(t)] for n, key, t in docs if n == ns}
        mean, scores = sum(map(len, mine.values())) / len(mine), defaultdict(float)
        for term, boost in query.items():
            df = sum(term in w for w in mine.values())
            idf = math.log(1 + (len(mine) - df + 0.5) / (df + 0.5))
            for key, w in mine.items():
                if term in w:
                    tf = w.count(term)
                    scores[key] += boost * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        top = sorted((-round(s, 5), key) for key, s in scores.items())[:k]
        out += [(ns, key, pytest.approx(-s, abs=2e-5), i + 1) for i, (s, key) in enumerate(top)]
    return sorted(out, key=lambda r: (r[0], r[3]))


def check(index, docs, query, k):
    got = sorted(((r.ns, r.key, r.score, r["rank"]) for r in index.bm25(query, k).collect()), key=lambda r: (r[0], r[3]))
    assert got == best(docs, {stem_of(w): b for w, b in query.items()}, k)


def test_segments_add_up_and_merge(spark, tmp_path):
    index = Index(spark, f"file://{tmp_path}/index", 4, cell=16)
    assert index.bm25({"cat": 1.0}, 3).count() == 0
    first, second = rows(150, 1), rows(90, 2)
    index.add(spark.createDataFrame(first, ROWS))
    check(index, first, {"cats": 1.0, "running": 2.0, "nothing": 1.0}, 5)
    index.add(spark.createDataFrame(second, ROWS))
    index.add(spark.createDataFrame([], ROWS))
    assert len(index._segments()) == 2
    query = {"old": 1.0, "zebra": 3.0}
    check(index, first + second, query, 5)
    before = index.blocks(["old", "zebra"]).count()
    index.merge()
    assert len(index._segments()) == 1 and index.blocks(["old", "zebra"]).count() == before
    check(index, first + second, query, 5)
    assert {(r.ns, r.docs) for r in index.figures().collect()} == {("n0", 120), ("n1", 120)}


def test_cells_are_passed_over(spark, tmp_path):
    rng, docs = random.Random(4), []
    for i in range(1200):
        docs.append(("a", i, " ".join(rng.choice(["the", "of", "and"]) for _ in range(rng.randrange(5, 300)))))
    docs += [("a", 5000 + i, "the quick " * 3) for i in range(6)]
    index = Index(spark, f"file://{tmp_path}/index", 4, cell=8)
    index.add(spark.createDataFrame(docs, ROWS))
    hits, cells = index.bm25_counted({"the": 1.0, "quick": 1.0}, 5)
    assert [(r.key, r["rank"]) for r in hits.orderBy("rank").collect()] == [(r[1], r[3]) for r in best(docs, {"the": 1.0, "quick": 1.0}, 5)]
    looked = {r.scored: r["count"] for r in cells.groupBy("scored").count().collect()}
    assert looked[False] > 4 * looked[True]


def test_the_plan_reads_postings_only(spark, tmp_path):
    docs = spark.createDataFrame(rows(50, 3), ROWS)
    docs.write.parquet(f"file://{tmp_path}/texts")
    index = Index(spark, f"file://{tmp_path}/index", 8)
    index.add(spark.read.parquet(f"file://{tmp_path}/texts"))
    blocks = index.blocks(["cat"])
    plan = blocks.select("ns", "n_docs")._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema: (.*)", plan)
    assert "folder" in filters.group(1) and "EqualTo(term,cat)" in filters.group(2) and "EqualTo(h," in filters.group(2) and "positions" not in filters.group(3)
    assert blocks.count() and not any("/texts/" in f for f in index.bm25({"cat": 1.0}, 3).inputFiles())


def matches(tokens, phrase, slop):
    """The m at which some choice of different positions puts all words at places from m to m + slop."""
    places = [[p - i for p, w in enumerate(tokens) if w == word] for i, word in enumerate(phrase)]
    out = 0
    for m in sorted({x for ps in places for x in ps}):
        fits = [[x for x in ps if m <= x <= m + slop] for ps in places]
        out += any(len({x + i for i, x in enumerate(choice)}) == len(phrase) for choice in itertools.product(*fits))
    return out


@pytest.mark.parametrize("words, slop", [("a b", 0), ("b a", 2), ("a a", 0), ("a a", 1), ("a b a", 0), ("a b a", 2), ("a a a", 2), ("a b c", 1), ("c b a", 4), ("a b c d", 3), ("a b b a", 3)])
def test_phrases(spark, tmp_path, words, slop):
    rng = random.Random(words + str(slop))
    docs = [("n", i, " ".join(rng.choice("aabbccdx") for _ in range(rng.randrange(0, 14)))) for i in range(120)] + [("n", 999, None)]
    index = Index(spark, f"file://{tmp_path}/index", 2)
    index.add(spark.createDataFrame(docs, ROWS))
    phrase = words.split()
    want = {key: matches(words_of(t), phrase, slop) for _, key, t in docs}
    hits = index.phrase(phrase, slop).collect()
    assert {r.key: r.freq for r in hits} == {k: n for k, n in want.items() if n}
    assert all(r.n == len(words_of(docs[r.key][2])) for r in hits) and len(hits) > 5
    scored = {r.key: r.score for r in index.scored_phrase(phrase, slop).collect()}
    texts = [words_of(t) for _, _, t in docs]
    mean = sum(map(len, texts)) / len(texts)
    idf = sum(math.log(1 + (len(texts) - df + 0.5) / (df + 0.5)) for df in (sum(w in t for t in texts) for w in phrase))
    for key, score in scored.items():
        assert score == pytest.approx(idf * want[key] * 2.2 / (want[key] + 1.2 * (0.25 + 0.75 * len(texts[key]) / mean)), abs=2e-5)


def test_awkward_documents(spark, tmp_path):
    docs = [("n", 1, None), ("n", 2, ""), (None, 3, "cat"), ("n", None, "cat"), ("n", 4, "cat " * 30_000), ("n", 5, "Cat-cats, CAT!"), ("n", -6, "cat"), ("n", 7, "cat")]
    index = Index(spark, f"file://{tmp_path}/index", 2)
    index.add(spark.createDataFrame(docs, ROWS))
    assert [(r.docs, r.words) for r in index.figures().collect()] == [(6, 30_005)]
    found = {r.key: r["rank"] for r in index.bm25({"cats": 1.0}, 9).collect()}
    assert set(found) == {4, 5, -6, 7} and found[-6] + 1 == found[7]
    assert {r.key: r.freq for r in index.phrase(["cat", "cats"]).collect()} == {5: 1}


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_near_terms(spark, tmp_path):
    rng = random.Random(2)
    terms = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(120)} | {"abcdefghij" + "k" * i for i in range(6)} | {"x" * 40, "x" * 42, "y" + "x" * 40, "abcdefghijklmnop", "bcdefghijklmnop", "zzabcdefghijklmnop"}
    v = Vocabulary(spark, f"file://{tmp_path}/voc", 3)
    frame = lambda ts: spark.createDataFrame([(t,) for t in sorted(ts)] + [(None,), ("",)], "term string")
    some = set(sorted(terms)[::2])
    v.add(frame(some))
    v.add(frame(terms))
    assert len(v._parts()) == 2 and v.terms().count() == len(terms)
    queries = [(q, m) for q in [*sorted(terms)[::5], "q", "abcdefghijklm", "x" * 41] for m in (1, 2)]
    for _ in range(2):
        got = {(r.q, r.term, r.distance) for r in v.near(spark.createDataFrame(queries, "q string, most int")).collect()}
        assert got == {(q, t, distance(q, t)) for q, m in queries for t in terms if distance(q, t) <= m}
        v.merge()
    assert len(v._parts()) == 1
    plan = v.near(spark.createDataFrame(queries, "q string, most int"))
    assert all("/forms/" in f for f in plan.inputFiles())


def test_patterns(spark, tmp_path):
    rng = random.Random(3)
    terms = {"".join(rng.choice("abc1") for _ in range(rng.randrange(1, 9))) for _ in range(400)}
    v = Vocabulary(spark, f"file://{tmp_path}/voc", 3)
    v.add(spark.createDataFrame([(t,) for t in terms], "term string"))
    for p in ("a.c", "ab.*", ".*abc", "a+b+c*", "(ab|ba).*", "ab|bc", "abc?1?", "[ab]{2}c.*", "ab(c|1)a", "abc", "a{2}b", "ab+ca?", r"a\wc"):
        assert {r.term for r in v.matching(p).collect()} == {t for t in terms if re.fullmatch(p, t)}, p
        assert all(g in f"^{t}$" for g in vocabulary.literal_grams(p) for t in terms if re.fullmatch(p, t)), p
    assert {r.term for r in v.beginning("abc").collect()} == {t for t in terms if t.startswith("abc")}
    assert {r.term for r in v.beginning("a").collect()} == {t for t in terms if t.startswith("a")}
    assert all("/grams/" in f for f in v.matching("ab.*").inputFiles())
    assert Vocabulary(spark, f"file://{tmp_path}/none").matching("abc").count() == 0


def test_forms(spark):
    got = set(spark.range(1).select(vocabulary.forms(F.lit("abc"))).head()[0])
    assert got == {"abc", "ab", "ac", "bc", "a", "b", "c"}


def test_terms_are_filed_under_few_forms(spark):
    """A term of ten letters was filed under 56 forms; every pair within reach still meets in one."""
    rng = random.Random(5)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(150)} | {"a", "ab", "z" * 30, "z" * 31 + "y", "y" + "z" * 30})
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    filed = {r.term: r.f for r in t.select("term", vocabulary.filed_forms(F.col("term")).alias("f")).collect()}
    assert all(len(f) == len(set(f)) <= len(x) + 4 for x, f in filed.items())
    asked = {(r.term, r.m): set(r.f) for r in t.crossJoin(spark.range(1, 3).select(F.col("id").cast("int").alias("m"))).select("term", "m", vocabulary.asked_forms(F.col("term"), F.col("m")).alias("f")).collect()}
    met = {(q, m, x) for (q, m), f in asked.items() for x in terms if not f.isdisjoint(filed[x])}
    assert {(q, m, x) for q in terms for x in terms for m in (1, 2) if distance(q, x) <= m} <= met


def test_blocks_count_only_once_their_job_has_ended(spark, tmp_path):
    """Tasks write their blocks themselves; what an attempt wrote is passed over until the commit names it."""
    import pyarrow as pa

    docs = rows(80, 6)
    batch = pa.RecordBatch.from_pydict({"ns": [r[0] for r in docs], "key": [r[1] for r in docs], "low": [(r[2] or "").lower() for r in docs]})
    writer = postings.SegmentWriter({"path": f"file://{tmp_path}/segment", "folders": "3", "cell": "16"})
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))
    read = lambda: spark.read.schema("ns string, term string, n_docs int, keys array<long>, h long, folder int").parquet(f"file://{tmp_path}/segment")
    assert len(lost.names) == len(kept.names) == 7 and read().count() == 0
    writer.commit([kept, None])
    assert sorted(k for r in read().filter("folder = 6").collect() for k in r.keys) == sorted(r[1] for r in docs)
    wanted = {(w, stem) for r in docs for w in words_of(r[2]) for stem in (False, True)}
    found = read().filter("folder < 6").collect()
    assert {(r.term, False) for r in found if r.folder >= 3} == {x for x in wanted if not x[1]} and {r.term for r in found if r.folder < 3} == {stem_of(w) for w, _ in wanted}
    assert read().filter("folder < 6 AND (h <> crc32(CAST(term AS BINARY)) OR folder % 3 <> h % 3)").count() == 0
