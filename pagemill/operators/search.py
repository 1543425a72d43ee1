"""Retrieval over a chunk table: BM25, term filters, cosine ranking, and combinations, for each namespace at once.

Only the terms of the query are counted, in one scan and without exploding texts; corpus figures are small sums per
namespace, and the k best of each namespace are limited in each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import stem, stem_of, terms, variants
from pagemill.operators.ranking import top_per_group
from pagemill.scratch import written

K1, B = 1.2, 0.75


def stems(text: Column) -> Column:
    return F.transform(terms(text), stem)


def term_counts(text: Column, query: Sequence[str]) -> dict[str, Column]:
    """The number of terms of a text, and of those with each stem of the query, without splitting it."""
    low = F.lower(F.coalesce(text, F.lit("")))
    whole = lambda forms: f"(?<![a-z0-9])(?:{'|'.join(forms)})(?![a-z0-9])"
    counts = {f"_tf{i}": F.regexp_count(low, F.lit(whole(variants(w)))) for i, w in enumerate(query)}
    return {"_n": F.regexp_count(low, F.lit("[a-z0-9]+")), **counts}


def bm25(docs: DataFrame, namespace: str, key: str, query: Mapping[str, float]) -> DataFrame:
    """``docs``: namespace, key, text. Adds ``score``; ``query``: word or stem, and boost (words of one stem add up).
    Texts without any term of it go.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)), with N, df and the mean length of the namespace.  Each text is read once:
    its counts are written, and both the namespace's figures and the scores come from them.
    """
    stemmed: dict[str, float] = {}
    for word, boost in query.items():
        stemmed[stem_of(word)] = stemmed.get(stem_of(word), 0.0) + boost
    query, names = stemmed, list(stemmed)
    counted = written(docs.withColumns(term_counts(F.col("text"), names)).drop("text"), "term-counts")
    figures = counted.groupBy(F.col(namespace).alias("_ns")).agg(F.count(F.lit(1)).alias("_docs"), F.avg("_n").alias("_mean"), *(F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(names))))
    joined = counted.join(figures, counted[namespace] == figures["_ns"])

    def part(i: int) -> Column:
        tf, df = F.col(f"_tf{i}"), F.col(f"_df{i}")
        idf = F.log(1 + (F.col("_docs") - df + 0.5) / (df + 0.5))
        return query[names[i]] * idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_n") / F.col("_mean")))

    any_ = reduce(add, (F.col(f"_tf{i}") for i in range(len(names)))) > 0
    scored = joined.filter(any_).withColumn("score", reduce(add, map(part, range(len(names)))))
    return scored.drop("_ns", "_n", "_docs", "_mean", *(f"_{x}{i}" for x in ("tf", "df") for i in range(len(names))))


def match_all(tokens: Column, wanted: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.array_contains(tokens, w) for w in wanted))


def match_any(tokens: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(tokens, F.array(*map(F.lit, wanted)))


def match_phrase(tokens: Column, wanted: Sequence[str], slop: int = 0) -> Column:
    """The words next to each other in order; with ``slop`` up to so many other words between the first and the last."""
    if not slop:
        return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" ")).contains(" " + " ".join(wanted) + " ")
    # From a first word on, as many words as the phrase and the slop have: the gaps share the slop.
    inside = "^" + r"(?:\S+ )*?".join(rf"\Q{w}\E " for w in wanted)
    found = F.filter(tokens, lambda t, i: (t == wanted[0]) & F.concat(F.array_join(F.slice(tokens, i + 1, F.lit(len(wanted) + slop)), " "), F.lit(" ")).rlike(inside))
    return F.size(found) > 0


def match_phrase_prefix(tokens: Column, wanted: Sequence[str]) -> Column:
    """The words next to each other in order, the last of them only begun."""
    return F.concat(F.lit(" "), F.array_join(tokens, " ")).contains(" " + " ".join(wanted))


def match_prefix(tokens: Column, prefix: str) -> Column:
    return F.exists(tokens, lambda t: t.startswith(prefix))


def match_fuzzy(tokens: Column, term: str, most: int = 1) -> Column:
    return F.exists(tokens, lambda t: F.levenshtein(t, F.lit(term), most) >= 0)


def match_regex(tokens: Column, pattern: str) -> Column:
    return F.exists(tokens, lambda t: t.rlike(f"^(?:{pattern})$"))


def boolean(must: Sequence[Column] = (), should: Sequence[Column] = (), must_not: Sequence[Column] = ()) -> Column:
    """All of ``must`` and none of ``must_not``; without ``must``, at least one of ``should``."""
    test = reduce(lambda a, b: a & b, must) if must else reduce(lambda a, b: a | b, should) if should else F.lit(True)
    return reduce(lambda a, b: a & ~b, must_not, test)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, in doubles."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def dense(vectors: DataFrame, query: DataFrame) -> DataFrame:
    """``vectors`` with ``score`` against the single vector in ``query`` (column ``q``)."""
    return vectors.crossJoin(F.broadcast(query.select("q").limit(1))).withColumn("score", cosine(F.col("embedding"), F.col("q"))).drop("q")


def ranked(df: DataFrame, namespace: Sequence[str], key: str, k: int) -> DataFrame:
    return top_per_group(df, namespace, [F.col("score").desc(), F.col(key)], k)


def zero_filled(hits: DataFrame, dims: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hits of every combination in ``dims``, 0 where there is none."""
    counts = hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("hits"))
    return dims.join(counts, list(keys), "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
