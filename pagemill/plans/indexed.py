"""Queries answered from an inverted index of the pages, and from its vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.text import terms
from pagemill.operators.postings import Index
from pagemill.operators.vocabulary import Vocabulary
from pagemill.plans import query, table
from pagemill.plans.retrieval import _TERMS, _bm25_sql
from pagemill.plans.views import PAGES_SQL, TERMS_SQL, pages
from pagemill.scratch import scratch_path


#: Folders of the queries' indexes; more for more terms.
FOLDERS = 4


def page_index(spark: SparkSession, sf: str, batches: int = 1) -> Index:
    """The pages' index, with the year as namespace; a segment for each batch."""
    index = Index(spark, scratch_path(spark, "index"), FOLDERS)
    p = pages(spark, sf).select(F.col("year").cast("string").alias("ns"), F.col("doc_id").alias("key"), "text")
    for b in range(batches):
        index.add(p.filter(F.col("key") % batches == b) if batches > 1 else p)
    return index


@query(f"""WITH {PAGES_SQL}, {_bm25_sql('pages_v', 'year')}
SELECT ns, doc_id, round(score, 5) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY round(score, 5) DESC, doc_id) AS INTEGER) AS rank FROM bm) WHERE rank <= 10""")
def index_bm25(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best pages of every year, from the postings of two segments alone."""
    return page_index(spark, sf, 2).bm25(_TERMS, 10).select(F.col("ns").cast("int").alias("ns"), F.col("key").alias("doc_id"), "score", "rank")


#: Phrases and their slop: as they stand, with gaps, in reverse, of four words, with a word that comes twice.
PHRASES = ((("of", "the"), 0), (("of", "and"), 3), (("the", "of"), 2), (("of", "the", "and"), 4), (("and", "the", "of", "to"), 9), (("the", "of", "the"), 3), (("le", "la", "le", "le"), 8), (("re", "re"), 2))
_SLOTS_SQL = ", ".join(f"({p}, {s}, {i}, '{w}')" for p, (words, s) in enumerate(PHRASES) for i, w in enumerate(words))
#: A match at m: for each slot a position at a place from m to m + slop, and for slots of one word as many positions as slots.
_PHRASE_SQL = f"""{PAGES_SQL}, toks AS (SELECT doc_id, year, {TERMS_SQL.format('text')} AS ts FROM pages_v), pos AS (SELECT doc_id, year, len(ts) AS n, unnest(ts) AS w, unnest(range(len(ts))) AS p FROM toks),
slots(pid, slop, slot, w) AS (VALUES {_SLOTS_SQL}),
adj AS (SELECT pid, slop, slot, slots.w, doc_id, p - slot AS place FROM slots JOIN pos ON slots.w = pos.w),
dem AS (SELECT a.pid, a.slot, a.slop + b.slot - a.slot AS reach, (SELECT count(*) FROM slots c WHERE c.pid = a.pid AND c.w = a.w AND c.slot BETWEEN a.slot AND b.slot) AS least FROM slots a JOIN slots b ON a.pid = b.pid AND a.w = b.w AND a.slot <= b.slot),
num AS (SELECT pid, count(*) AS n FROM dem GROUP BY 1),
anc AS (SELECT DISTINCT pid, doc_id, place FROM adj),
met AS (SELECT anc.pid, anc.doc_id, anc.place, dem.slot, dem.reach FROM anc JOIN dem USING (pid) JOIN adj ON adj.pid = anc.pid AND adj.doc_id = anc.doc_id AND adj.slot = dem.slot AND adj.place BETWEEN anc.place AND anc.place + dem.reach GROUP BY 1, 2, 3, 4, 5, dem.least HAVING count(*) >= dem.least),
ok AS (SELECT pid, doc_id, place FROM met GROUP BY 1, 2, 3 HAVING count(*) = (SELECT n FROM num WHERE num.pid = met.pid)),
fr AS (SELECT pid, doc_id, count(*) AS freq FROM ok GROUP BY 1, 2)"""


@query(f"WITH {_PHRASE_SQL} SELECT pid AS phrase, doc_id, freq FROM fr")
def index_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Where phrases stand, with moves, from the positions in the postings."""
    index, out = page_index(spark, sf), None
    for i, (words, slop) in enumerate(PHRASES):
        hits = index.phrase(words, slop).select(F.lit(i).alias("phrase"), F.col("key").alias("doc_id"), "freq")
        out = hits if out is None else out.unionByName(hits)
    return out


@query(f"""WITH {_PHRASE_SQL}, fig AS (SELECT year, count(*) AS nd, avg(len(ts)) AS mean FROM toks GROUP BY 1), df AS (SELECT year, w, count(DISTINCT doc_id) AS df FROM pos GROUP BY 1, 2),
idf AS (SELECT pid, year, sum(ln(1 + (nd - df + 0.5) / (df + 0.5))) AS idf FROM slots JOIN df USING (w) JOIN fig USING (year) GROUP BY 1, 2),
sc AS (SELECT pid, year, doc_id, round(idf * freq * 2.2 / (freq + 1.2 * (0.25 + 0.75 * len(ts) / mean)), 5) AS score FROM fr JOIN toks USING (doc_id) JOIN fig USING (year) JOIN idf USING (pid, year))
SELECT pid AS phrase, year, doc_id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY pid, year ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc) WHERE rank <= 3""")
def index_phrases_scored(spark: SparkSession, sf: str) -> DataFrame:
    """The three best pages of every year for each phrase, by how often it matches."""
    from pagemill.operators.search import ranked

    index, out = page_index(spark, sf), None
    for i, (words, slop) in enumerate(PHRASES):
        hits = index.scored_phrase(words, slop).select(F.lit(i).alias("phrase"), F.col("ns").cast("int").alias("year"), F.col("key").alias("doc_id"), "score")
        out = hits if out is None else out.unionByName(hits)
    return ranked(out, ["phrase", "year"], "doc_id", 3).select("phrase", "year", "doc_id", "score", "rank")


def page_vocabulary(spark: SparkSession, sf: str) -> Vocabulary:
    """The terms of the pages' index."""
    vocabulary = Vocabulary(spark, scratch_path(spark, "vocabulary"), FOLDERS)
    vocabulary.add(page_index(spark, sf).terms())
    return vocabulary


_VOCABULARY_SQL = f"voc AS (SELECT DISTINCT unnest({TERMS_SQL.format('text')}) AS term FROM documents)"


@query(f"""WITH {_VOCABULARY_SQL}, q AS (SELECT DISTINCT unnest({TERMS_SQL.format('text')}) AS q FROM benchmark)
SELECT q, term, levenshtein(q, term) AS distance FROM q JOIN voc ON abs(length(q) - length(term)) <= 2 AND levenshtein(q, term) <= CASE WHEN length(q) < 8 THEN 1 ELSE 2 END""")
def index_near_terms(spark: SparkSession, sf: str) -> DataFrame:
    """For every term of the benchmark its near spellings among the documents' terms."""
    q = table(spark, sf, "benchmark").select(F.explode(terms(F.col("text"))).alias("q")).distinct()
    return page_vocabulary(spark, sf).near(q.withColumn("most", F.when(F.length("q") < 8, 1).otherwise(2)))


PATTERNS = ("th[aeiou]t", "ent.*", ".*tion", "(the|an)re", "quev?i[a-z]+", "h.sh")


@query(f"WITH {_VOCABULARY_SQL}, p(pattern) AS (VALUES {', '.join(f'({p!r})' for p in PATTERNS)}) SELECT pattern, term FROM voc JOIN p ON regexp_full_match(term, pattern) UNION ALL SELECT '^ther', term FROM voc WHERE starts_with(term, 'ther')")
def index_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Terms by patterns and by a prefix."""
    vocabulary = page_vocabulary(spark, sf)
    out = vocabulary.beginning("ther").select(F.lit("^ther").alias("pattern"), "term")
    for p in PATTERNS:
        out = out.unionByName(vocabulary.matching(p).select(F.lit(p).alias("pattern"), "term"))
    return out
