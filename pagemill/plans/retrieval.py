"""Retrieval queries over pages and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.text import stem_of, terms
from pagemill.operators import search as s
from pagemill.operators.filters import metadata
from pagemill.operators.ranking import fused, top_per_group
from pagemill.plans import query, table
from pagemill.plans.views import PAGES_SQL, STEM_SQL, TERMS_SQL, pages

_K1, _B = 1.2, 0.75
#: Query terms and boosts.
_TERMS = {"hash": 1.0, "thering": 2.0, "and": 1.0}
_STEMS_SQL = f"list_transform({TERMS_SQL.format('text')}, lambda w: {STEM_SQL.format('w')})"


def _bm25_sql(source: str, ns: str, terms: dict[str, float] = _TERMS) -> str:
    terms = {stem_of(w): b for w, b in terms.items()}
    tf = ", ".join(f"len(list_filter(tokens, lambda t: t = '{w}')) AS tf{i}" for i, w in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    score = " + ".join(f"{b} * ln(1 + (nd - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * ({_K1} + 1) / (tf{i} + {_K1} * (1 - {_B} + {_B} * n / mean))" for i, b in enumerate(terms.values()))
    return f"""tok AS (SELECT doc_id, {ns} AS ns, date, sequence, slug, month, day, {_STEMS_SQL} AS tokens FROM {source}),
tfs AS (SELECT doc_id, ns, date, sequence, slug, month, day, len(tokens) AS n, {tf} FROM tok),
fig AS (SELECT ns, count(*) AS nd, avg(n) AS mean, {df} FROM tfs GROUP BY 1),
bm AS (SELECT doc_id, tfs.ns, date, sequence, slug, month, day, {score} AS score FROM tfs JOIN fig ON tfs.ns = fig.ns WHERE {" + ".join(f"tf{i}" for i in range(len(terms)))} > 0)"""


def _bm25(spark: SparkSession, sf: str, ns: str, terms: dict[str, float] = _TERMS) -> DataFrame:
    t = pages(spark, sf).select("doc_id", F.col(ns).alias("ns"), "date", "sequence", "slug", "month", "day", "text")
    return s.bm25(t, "ns", "doc_id", terms)


@query(f"""WITH {PAGES_SQL}, {_bm25_sql('pages_v', 'year')}
SELECT ns, doc_id, round(score, 5) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY round(score, 5) DESC, doc_id) AS INTEGER) AS rank FROM bm) WHERE rank <= 10""")
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-year search: the ten best of every year, in one query."""
    scored = _bm25(spark, sf, "year").withColumn("score", F.round("score", 5))
    return s.ranked(scored, ["ns"], "doc_id", 10).select("ns", "doc_id", "score", "rank")


@query(f"""WITH {PAGES_SQL}, {_bm25_sql('pages_v', 'year')}
SELECT date, sequence, doc_id, slug, n_year FROM (SELECT *, row_number() OVER (PARTITION BY ns ORDER BY round(score, 5) DESC, doc_id) AS rank, count(*) OVER (PARTITION BY ns) AS n_year FROM bm) WHERE rank <= 5""")
def cross_year_chronological(spark: SparkSession, sf: str) -> DataFrame:
    """The five best of every year with the year's number of hits, for reading by date."""
    scored = _bm25(spark, sf, "year").withColumn("score", F.round("score", 5))
    counts = scored.groupBy(F.col("ns").alias("y")).agg(F.count(F.lit(1)).alias("n_year"))
    best = s.ranked(scored, ["ns"], "doc_id", 5)
    return best.join(counts, best["ns"] == counts["y"]).orderBy("date", "sequence", "doc_id").select("date", "sequence", "doc_id", "slug", "n_year")


@query(f"""WITH {PAGES_SQL}, {_bm25_sql('pages_v', 'year')}
SELECT slug, ns AS year, doc_id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY slug, ns ORDER BY round(score, 5) DESC, doc_id) AS INTEGER) AS rank FROM bm WHERE slug IN ('src0', 'src1', 'src2')) WHERE rank <= 3""")
def side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    scored = _bm25(spark, sf, "year").filter(metadata({"slug": {"$in": ["src0", "src1", "src2"]}})).withColumn("score", F.round("score", 5))
    return s.ranked(scored, ["slug", "ns"], "doc_id", 3).select("slug", F.col("ns").alias("year"), "doc_id", "rank")


@query(f"""WITH {PAGES_SQL} SELECT year, doc_id, date, sequence, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY sequence, doc_id) AS INTEGER) AS rank FROM pages_v WHERE month = 7 AND day IN (7, 19)) WHERE rank <= 8""")
def calendar_date(spark: SparkSession, sf: str) -> DataFrame:
    day = pages(spark, sf).filter(metadata({"month": 7, "day": {"$in": [7, 19]}}))
    return top_per_group(day, ["year"], [F.col("sequence"), F.col("doc_id")], 8).select("year", "doc_id", "date", "sequence", "rank")


_CLAUSES_SQL = f"""t AS (SELECT doc_id, {TERMS_SQL.format('text')} AS tokens, ' ' || array_to_string({TERMS_SQL.format('text')}, ' ') || ' ' AS line FROM documents)"""


@query(f"""WITH {_CLAUSES_SQL} SELECT doc_id, list_has_all(tokens, ['of', 'the']) AS all_terms, list_has_any(tokens, ['casino', 'is']) AS any_term, contains(line, ' of the ') AS phrase,
  regexp_matches(line, ' of(?: \\S+){{0,2}} and ') AS near, len(list_filter(range(1, len(tokens) + 1), lambda i: tokens[i] = 'the' AND regexp_matches(array_to_string(tokens[i : i + 5], ' ') || ' ', '^the (?:\\S+ )*?of (?:\\S+ )*?and '))) > 0 AS near_three, len(list_filter(tokens, lambda x: starts_with(x, 'thering'))) > 0 AS prefix, len(list_filter(tokens, lambda x: levenshtein(x, 'tions') <= 1)) > 0 AS fuzzy,
  len(list_filter(tokens, lambda x: regexp_full_match(x, 'th[aeiou]t'))) > 0 AS regex FROM t""")
def term_filters(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", terms(F.col("text")).alias("t"))
    t = F.col("t")
    return d.select("doc_id", s.match_all(t, ["of", "the"]).alias("all_terms"), s.match_any(t, ["casino", "is"]).alias("any_term"), s.match_phrase(t, ["of", "the"]).alias("phrase"), s.match_phrase(t, ["of", "and"], 2).alias("near"), s.match_phrase(t, ["the", "of", "and"], 3).alias("near_three"), s.match_prefix(t, "thering").alias("prefix"), s.match_fuzzy(t, "tions").alias("fuzzy"), s.match_regex(t, "th[aeiou]t").alias("regex"))


@query(f"""WITH {_CLAUSES_SQL} SELECT doc_id FROM t WHERE (list_contains(tokens, 'the') AND (contains(line, ' of the ') OR list_contains(tokens, 'que'))) AND NOT list_contains(tokens, 'hash')""")
def boolean_search(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", terms(F.col("text")).alias("t"))
    t = F.col("t")
    either = s.boolean(should=[s.match_phrase(t, ["of", "the"]), F.array_contains(t, "que")])
    return d.filter(s.boolean(must=[F.array_contains(t, "the"), either], must_not=[F.array_contains(t, "hash")])).select("doc_id")


_DENSE_SQL = """q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0),
dense AS (SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score FROM embeddings, q)"""


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return s.dense(e, e.filter("vec_id = 0").select(F.col("embedding").alias("q"))).withColumn("score", F.round("score", 6))


@query(f"""WITH {_DENSE_SQL} SELECT label, vec_id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM dense) WHERE rank <= 10""")
def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    return s.ranked(_dense(spark, sf), ["label"], "vec_id", 10).select("label", "vec_id", "score", "rank")


@query(f"""WITH {_DENSE_SQL}, h AS (SELECT label, vec_id, score FROM dense JOIN documents ON vec_id = doc_id WHERE contains(' ' || array_to_string({TERMS_SQL.format('text')}, ' ') || ' ', ' of the '))
SELECT label, vec_id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM h) WHERE rank <= 10""")
def hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Dense ranking of what passes a lexical filter."""
    docs = table(spark, sf, "documents").filter(s.match_phrase(terms(F.col("text")), ["of", "the"])).select(F.col("doc_id").alias("vec_id"))
    return s.ranked(_dense(spark, sf).join(docs, "vec_id"), ["label"], "vec_id", 10).select("label", "vec_id", "score", "rank")


@query(f"""WITH {PAGES_SQL}, {_DENSE_SQL}, {_bm25_sql('(SELECT p.*, label FROM pages_v p JOIN embeddings ON vec_id = doc_id)', 'label')},
d AS (SELECT label AS ns, vec_id AS id, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS r FROM dense),
f AS (SELECT ns, doc_id AS id, row_number() OVER (PARTITION BY ns ORDER BY round(score, 5) DESC, doc_id) AS r FROM bm),
u AS (SELECT coalesce(d.ns, f.ns) AS label, coalesce(d.id, f.id) AS id, d.r AS dr, f.r AS fr FROM (FROM d WHERE r <= 20) d FULL JOIN (FROM f WHERE r <= 20) f ON d.ns = f.ns AND d.id = f.id),
s AS (SELECT *, coalesce(1.0 / (60 + dr), 0) + coalesce(1.0 / (60 + fr), 0) AS score FROM u)
SELECT label, id, round(score, 9) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, coalesce(dr, 1 << 30), coalesce(fr, 1 << 30), id) AS INTEGER) AS rank FROM s) WHERE rank <= 10""")
def rrf_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Dense and lexical rankings of each namespace, fused by reciprocal ranks."""
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    lexical = s.bm25(table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id"), "label", "doc_id", _TERMS).withColumn("score", F.round("score", 5))
    lists = [s.ranked(_dense(spark, sf), ["label"], "vec_id", 20).withColumnRenamed("vec_id", "id"), s.ranked(lexical, ["label"], "doc_id", 20).withColumnRenamed("doc_id", "id")]
    return fused(lists, ["label"], "id", 10).withColumn("score", F.round("score", 9))


def _fixed_chunks_sql(size: int) -> str:
    return f"""w AS (SELECT doc_id, source, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '') AS ws FROM documents),
c AS (SELECT doc_id, source, ws, unnest(range(0, CAST(ceil(len(ws) / {size}) AS BIGINT))) AS i FROM w)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(ceil(len(ws) / {size}) AS INTEGER) AS chunk_count, CAST(least({size}, len(ws) - i * {size}) AS INTEGER) AS token_count,
  array_to_string(ws[i * {size} + 1 : (i + 1) * {size}], ' ') AS text FROM c"""


@query("WITH " + _fixed_chunks_sql(200))
def chunk_pages(spark: SparkSession, sf: str) -> DataFrame:
    from pagemill.operators.chunks import word_chunks

    return word_chunks(table(spark, sf, "documents").select("doc_id", "text"), 200)


_MARK_SQL = f"""list_transform(regexp_extract_all(text, '[A-Za-z0-9]+(?:''[A-Za-z]+)?|[^A-Za-z0-9]+'), lambda w: CASE WHEN regexp_matches(w, '^[A-Za-z0-9]') AND (({STEM_SQL.format("lower(w)")}) IN ('thing', 'hash') OR starts_with(lower(w), 'ther') OR levenshtein(lower(w), 'tions') <= 1)
  THEN '<mark class="hl">' || replace(w, chr(39), '&#x27;') || '</mark>' ELSE replace(replace(replace(replace(replace(w, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') END)"""


@query(f"SELECT doc_id, array_to_string({_MARK_SQL}, '') AS html FROM documents")
def highlights(spark: SparkSession, sf: str) -> DataFrame:
    from pagemill.operators.highlight import highlight

    return table(spark, sf, "documents").select("doc_id", highlight(F.col("text"), ["things", "hash"], ["ther"], [("tions", 1)]).alias("html"))


_SIDES_SQL = f"""{PAGES_SQL}, {_bm25_sql('pages_v', 'year')}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug, ns ORDER BY round(score, 5) DESC, doc_id) AS rank FROM bm WHERE slug IN ('src0', 'src1', 'src2')) WHERE rank <= 3)"""


def _sides(spark: SparkSession, sf: str) -> DataFrame:
    scored = _bm25(spark, sf, "year").filter(metadata({"slug": {"$in": ["src0", "src1", "src2"]}})).withColumn("score", F.round("score", 5))
    return s.ranked(scored, ["slug", "ns"], "doc_id", 3)


@query(f"WITH {_SIDES_SQL} SELECT slug, ns AS year, count(*) AS hits, CAST(sum(count(*)) OVER (PARTITION BY slug) AS BIGINT) AS total FROM best GROUP BY 1, 2")
def side_by_side_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of each publication by year, and its total."""
    counts = _sides(spark, sf).groupBy("slug", F.col("ns").alias("year")).agg(F.count(F.lit(1)).alias("hits"))
    return counts.join(counts.groupBy("slug").agg(F.sum("hits").alias("total")), "slug")


@query(f"WITH {_SIDES_SQL} SELECT slug, doc_id, date, sequence, CAST(row_number() OVER (ORDER BY date, sequence, doc_id) AS INTEGER) AS position FROM best")
def side_by_side_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The publications' best in one list, in the order in which they appeared."""
    from pagemill.operators.ranking import numbered_spread

    best = _sides(spark, sf).select("slug", "doc_id", "date", "sequence").withColumn("all", F.lit(0))
    return numbered_spread(best, ["all"], ["date", "sequence", "doc_id"], "position").withColumn("position", F.col("position").cast("int")).drop("all")


@query(f"""WITH {PAGES_SQL}, {_DENSE_SQL}, {_bm25_sql("pages_v", "slug || '/' || (year % 3)")},
v AS (SELECT slug || '/' || (year % 3) AS ns, doc_id AS id, score FROM dense JOIN pages_v ON vec_id = doc_id),
d AS (SELECT ns, id, row_number() OVER (PARTITION BY ns ORDER BY score DESC, id) AS r FROM v),
f AS (SELECT ns, doc_id AS id, row_number() OVER (PARTITION BY ns ORDER BY round(score, 5) DESC, doc_id) AS r FROM bm),
u AS (SELECT coalesce(d.ns, f.ns) AS ns, coalesce(d.id, f.id) AS id, d.r AS dr, f.r AS fr FROM (FROM d WHERE r <= 10) d FULL JOIN (FROM f WHERE r <= 10) f ON d.ns = f.ns AND d.id = f.id),
s AS (SELECT *, coalesce(1.0 / (60 + dr), 0) + coalesce(1.0 / (60 + fr), 0) AS score FROM u)
SELECT split_part(ns, '/', 1) AS slug, CAST(split_part(ns, '/', 2) AS INTEGER) AS part, id, round(score, 9) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ns ORDER BY score DESC, coalesce(dr, 1 << 30), coalesce(fr, 1 << 30), id) AS INTEGER) AS rank FROM s) WHERE rank <= 5""")
def rrf_by_publication(spark: SparkSession, sf: str) -> DataFrame:
    """Two paths (twice as many hits of each), fused for every publication and period."""
    p = pages(spark, sf).withColumn("part", F.col("year") % 3)
    lexical = s.bm25(p.select("doc_id", F.concat_ws("/", "slug", "part").alias("ns"), "slug", "part", "text"), "ns", "doc_id", _TERMS).withColumn("score", F.round("score", 5))
    dense = _dense(spark, sf).join(p.select(F.col("doc_id").alias("vec_id"), "slug", "part"), "vec_id")
    lists = [s.ranked(dense, ["slug", "part"], "vec_id", 10).withColumnRenamed("vec_id", "id"), s.ranked(lexical, ["slug", "part"], "doc_id", 10).withColumnRenamed("doc_id", "id")]
    return fused(lists, ["slug", "part"], "id", 5).withColumn("score", F.round("score", 9))


_BOOSTED = {"the": 1.0, "thering": 2.5, "que": 0.5}


@query(f"""WITH {PAGES_SQL}, {_bm25_sql('pages_v', 'year', _BOOSTED)}, {_CLAUSES_SQL}
SELECT ns, doc_id, round(score, 5) AS score, rank FROM (SELECT bm.*, CAST(row_number() OVER (PARTITION BY ns ORDER BY round(score, 5) DESC, bm.doc_id) AS INTEGER) AS rank FROM bm JOIN t ON bm.doc_id = t.doc_id
  WHERE list_contains(tokens, 'the') AND (contains(' ' || array_to_string(tokens, ' '), ' of th') OR len(list_filter(tokens, lambda x: levenshtein(x, 'tions') <= 1)) > 0) AND NOT list_contains(tokens, 'hash')) WHERE rank <= 10""")
def boolean_scored(spark: SparkSession, sf: str) -> DataFrame:
    """A scored combination: what must and should occur, with boosts; the begun phrase, the near word; what must not."""
    p = pages(spark, sf).select("doc_id", F.col("year").alias("ns"), "text", terms(F.col("text")).alias("t"))
    t = F.col("t")
    either = s.boolean(should=[s.match_phrase_prefix(t, ["of", "th"]), s.match_fuzzy(t, "tions")])
    fits = s.boolean(must=[F.array_contains(t, "the"), either], must_not=[F.array_contains(t, "hash")])
    scored = s.bm25(p.select("doc_id", "ns", "text", fits.alias("fits")), "ns", "doc_id", _BOOSTED).filter("fits").withColumn("score", F.round("score", 5))
    return s.ranked(scored, ["ns"], "doc_id", 10).select("ns", "doc_id", "score", "rank")


#: Saved queries: stems with boosts, and the publications that they are asked of.
_SAVED = {"alpha": ({"hash": 1.0, "thering": 2.0}, ["src0", "src1"]), "beta": ({"and": 1.0, "que": 3.0}, ["src2", "src3"])}


def _saved_sql(name: str) -> str:
    stems, slugs = _SAVED[name]
    return f"(WITH {PAGES_SQL}, {_bm25_sql('pages_v', 'year', stems)} SELECT '{name}' AS story, slug, doc_id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY slug ORDER BY round(score, 5) DESC, doc_id) AS INTEGER) AS rank FROM bm WHERE slug IN ({', '.join(repr(x) for x in slugs)})) WHERE rank <= 4)"


@query(" UNION ALL ".join(map(_saved_sql, _SAVED)))
def saved_queries(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for name, (stems, slugs) in _SAVED.items():
        scored = _bm25(spark, sf, "year", stems).filter(F.col("slug").isin(slugs)).withColumn("score", F.round("score", 5))
        parts.append(s.ranked(scored, ["slug"], "doc_id", 4).select(F.lit(name).alias("story"), "slug", "doc_id", "rank"))
    return parts[0].unionByName(parts[1])
