"""Quality rules with an isolation forest on rule statistics.

Every text gets its rule statistics in one pass.  An isolation forest, fitted on a bounded sample of rows labelled
good, tells how few random splits set a row's statistics apart; short paths mean an anomalous text.  The threshold
comes from the scores of all labelled rows: the one that rejects most rows labelled bad among those that reject at
most FALSE_REJECTS of the rows labelled good.

Defined cases: a null text has no words and fails the base rules; equal texts get equal verdicts; without labels of
both kinds the forest rejects nothing; repeated or null doc_ids are rows of their own (a label applies to all rows of
its id); very long texts are counted whole; an empty table gives no rows; other columns stay out of the way, whatever
their names (``filter_quality`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import small, whole_row, written
from pagemill.llm.hashing import repeated, windows, word_hashes

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Rows of each label that the forest is fitted on or takes its ranges from, at most; trees; rows of a tree.
SAMPLE, TREES, TREE_ROWS = 8192, 128, 1024
#: Share of rows labelled good that the threshold may reject.
FALSE_REJECTS = 0.002
#: Width of the score histogram by which the threshold is found.
BINS = 2000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = (*BASE, "n_lines", "n_upper", "n_letters", "n_marks", "n_digits", "n_stutter")


def text_stats(data: bytes, words: np.ndarray) -> tuple[int, ...]:
    """STATS of one text; ``words``: the hashes of its words."""
    n = len(words)
    if not n:
        return (0,) * len(STATS)
    by = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    chars = len(data) - int(by[128:192].sum()) - int(by[9:14].sum()) - int(by[32])
    lines = [x for x in data.split(b"\n") if x.strip()]
    covered = 0
    twice = repeated(windows(words, WINDOW))
    if twice is not None:
        starts = np.nonzero(twice)[0]
        step = np.zeros(n + 1, dtype=np.int32)
        step[starts] += 1
        step[starts + WINDOW] -= 1
        covered = int((np.cumsum(step) > 0).sum())
    upper, lower = int(by[65:91].sum()), int(by[97:123].sum())
    letters = upper + lower + int(by[192:].sum())
    return n, chars, int(by[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), covered, len(lines), upper, letters, int(by[33] + by[63]), int(by[48:58].sum()), int((words[1:] == words[:-1]).sum())


def _stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t or b"" for t in batch]
        rows = np.array([text_stats(t, h) for t, h in zip(texts, word_hashes(texts), strict=True)], dtype=np.int64).reshape(-1, len(STATS))
        yield pd.DataFrame(rows, columns=list(STATS))


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and STATS (which replace columns of their names)."""
    stats = F.pandas_udf(_stats, ", ".join(f"{s} long" for s in STATS))(F.col("text").cast("binary"))
    return docs.select(*[c for c in keep if c not in STATS], stats.alias("_stats")).select(*[c for c in keep if c not in STATS], "_stats.*")


def features(s: pd.DataFrame) -> np.ndarray:
    """Ratios, on a scale that tells small ones apart."""
    n, chars, lines, letters = (np.maximum(s[c].to_numpy(dtype=np.float64), 1) for c in ("n_words", "word_chars", "n_lines", "n_letters"))
    part = lambda c, of: np.sqrt(s[c].to_numpy(dtype=np.float64) / of)
    other = np.maximum(chars - s["n_letters"].to_numpy() - s["n_digits"].to_numpy(), 0)
    return np.stack([np.log(chars / n), part("n_symbols", n), part("n_dup_lines", lines), part("n_repeat_words", n), part("n_stutter", n), part("n_upper", letters), part("n_marks", n), np.sqrt(other / chars)], axis=1)


class Forest:
    """Trees as heaps: the children of node i are 2 i + 1 and 2 i + 2; a leaf has feature -1 and its path length.

    Splits are drawn from the node's own cell: what earlier splits on the way to it have left of the range that the
    features have in ``span``.  So a statistic that all fitted rows share still sets apart the rows that differ in it.
    """

    def __init__(self, x: np.ndarray, span: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rows = min(rows, len(x))
        self.depth = max(1, int(np.ceil(np.log2(max(self.rows, 2)))))
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.full((trees, size), -1, dtype=np.int16)
        self.split = np.zeros((trees, size))
        self.path = np.zeros((trees, size))
        for t in range(trees):
            self._grow(t, 0, 0, x[rng.choice(len(x), self.rows, replace=False)], span.min(axis=0), span.max(axis=0), rng)

    @staticmethod
    def extra(n: int) -> float:
        """Mean path length of an unsuccessful search among n."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, t: int, node: int, depth: int, x: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator) -> None:
        open_ = np.nonzero(high > low)[0]
        if depth == self.depth or len(x) < 2 or not len(open_):
            self.path[t, node] = depth + self.extra(len(x))
            return
        f = int(rng.choice(open_))
        at = float(rng.uniform(low[f], high[f]))
        self.feature[t, node], self.split[t, node] = f, at
        left, edge = x[:, f] < at, np.arange(len(low)) == f
        for child, part, lo, hi in ((2 * node + 1, x[left], low, np.where(edge, at, high)), (2 * node + 2, x[~left], np.where(edge, at, low), high)):
            if len(part):
                self._grow(t, child, depth + 1, part, lo, hi, rng)
            else:
                self.path[t, child] = depth + 1

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (- mean path / normal path): near 1 for rows that few splits set apart."""
        total, every = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[t, node]
                inner = f >= 0
                node = np.where(inner, 2 * node + 1 + (x[every, f] >= self.split[t, node]), node)
            total += self.path[t, node]
        return 2.0 ** (-total / len(self.feature) / max(self.extra(self.rows), 1e-9))


def fit(stats: DataFrame, labels: DataFrame) -> tuple[Forest, float] | None:
    """``stats``: doc_id and STATS; ``labels``: doc_id, quality. None if there aren't labels of both kinds."""
    marked = written(labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")), "quality-marks")
    rows = stats.filter(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words").join(small(marked), "doc_id")
    rows = written(rows.select("doc_id", "quality", *STATS), "quality-labelled")
    many = {r.good: r.n for r in rows.groupBy((F.col("quality") > 0).alias("good")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def sample(good: bool) -> np.ndarray:
        # About twice SAMPLE rows pass the threshold, in all tasks together, before the smallest hashes are taken.
        share = min(1.0, 2 * SAMPLE / max(many.get(good, 0), 1))
        below = rows.filter((F.col("quality") > 0) == good).filter(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) <= int(share * (1 << 53)))
        return features(below.orderBy(F.xxhash64("doc_id"), "doc_id", *STATS).limit(SAMPLE).select(*STATS).toPandas())

    good = sample(True)
    if len(good) < 2:
        return None
    forest = Forest(good, np.concatenate((good, sample(False))))
    counts = rows.groupBy((F.col("quality") > 0).alias("good"), F.floor(scorer(forest) * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = np.zeros((2, BINS + 1))
    for r in counts:
        n[int(r.good), min(r.bin, BINS)] += r.n
    if not n[0].sum() or not n[1].sum():
        return None
    bad, good = (np.cumsum(k[::-1])[::-1] for k in n)  # rejected if the score is in this bin or above
    allowed = np.nonzero(good <= FALSE_REJECTS * good[0])[0]
    if not len(allowed):
        return None
    best = allowed[bad[allowed] == bad[allowed].max()][-1]
    return forest, best / BINS


def scorer(forest: Forest):
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(forest.score(features(pd.DataFrame(dict(zip(STATS, columns, strict=True))))), index=columns[0].index)

    return score(*STATS)


def judged(rows: DataFrame, labels: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """``rows`` (with STATS) and base_failed, score, kept; the forest is fitted on ``stats`` or else on the rows."""
    model = fit((stats if stats is not None else rows).select("doc_id", *STATS), labels)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.drop("base_failed", "score", "kept").withColumn("base_failed", failed)
    rows = rows.withColumn("score", scorer(model[0]) if model else F.lit(0.0))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(model[1] if model else 1.0)))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, STATS, base_failed, score, kept for each row of ``docs``."""
    return judged(written(with_stats(docs, ["doc_id"]), "quality-stats"), labels)


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Statistics are worked out once and kept with the rows."""
    row = docs.select(whole_row(docs).alias("_row"), "doc_id", "text")
    rows = written(with_stats(row, ["_row", "doc_id"]), "quality-rows")
    return judged(rows, labels).filter("kept").select("_row.*")
