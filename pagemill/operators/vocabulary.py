"""Terms of an index by likeness: near spellings, prefixes and patterns, without going over all terms.

Near spellings: a term is parted in two halves.  Of two edits at most one falls to one of them, and two stretches of
edit distance 1 have a form in common when up to one letter is taken out of the first HEAD letters of each.  So every
term is filed under its length and all forms of its halves, about two more than it has letters; a query's forms, at all
lengths within reach, fetch its candidates, and the edit distance decides.  For one edit a half must stand as it is.

Prefixes and patterns: every term, with marks at its begin and end, is filed under its three-letter grams.  A pattern's
literal stretches give grams that its terms must hold; the rarest of them fetches candidates, and the pattern decides.

Both tables lie in folders by a hash of their first column, sorted by it: a query reads the folders of its forms or
grams.  Each batch of new terms is a part of its own; parts are merged by ``merge``.

Defined cases: null and empty terms are not filed; a term filed twice is one term; a pattern without three literal
letters in a row reads the terms themselves; an empty table finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.versions import Versions
from pagemill.scratch import written

HEAD, DISTANCE, GRAM = 10, 2, 3
FOLDERS = 8
#: Rows that one task sorts and writes, about.
TASK_ROWS = 1_000_000
BEGIN, END = "^", "$"


def shorter(word: Column) -> Column:
    """All that is left of ``word`` with one letter taken out."""
    n = F.length(word)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))).otherwise(F.array().cast("array<string>"))


def forms(word: Column, distance: int = DISTANCE) -> Column:
    """The head of ``word`` with up to ``distance`` letters taken out."""
    out = last = F.array(F.left(word, F.lit(HEAD)))
    for _ in range(distance):
        last = F.array_distinct(F.flatten(F.transform(last, shorter)))
        out = F.concat(out, last)
    return F.array_distinct(out)


def _sided(n: Column, side: str, found: Column) -> Column:
    return F.transform(found, lambda f: F.concat(n.cast("string"), F.lit(side), f))


def filed_forms(term: Column) -> Column:
    """What ``term`` is filed under: its length, the half, and the half's forms with up to one letter out."""
    n = F.length(term)
    half = F.floor(n / 2).cast("int")
    return F.concat(_sided(n, BEGIN, forms(F.left(term, half), 1)), _sided(n, END, forms(F.right(term, n - half), 1)))


def asked_forms(q: Column, most: Column) -> Column:
    """All that a term within ``most`` (1 or 2) edits of ``q`` may be filed under."""
    size, shift = F.length(q), most - 1

    def halves(side: str, part, n: Column, own: Column) -> Column:
        parts = F.transform(F.filter(F.sequence(own - shift, own + shift), lambda k: (k >= 0) & (k <= size)), lambda k: part(q, k))
        return F.flatten(F.transform(parts, lambda p: _sided(n, side, F.when(most < 2, F.array(F.left(p, F.lit(HEAD)))).otherwise(forms(p, 1)))))

    def of_length(n: Column) -> Column:
        half = F.floor(n / 2).cast("int")
        return F.concat(halves(BEGIN, F.left, n, half), halves(END, F.right, n, n - half))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(F.lit(1), size - most), size + most), of_length)))


def grams(word: Column) -> Column:
    marked = F.concat(F.lit(BEGIN), word, F.lit(END))
    n = F.length(marked) - (GRAM - 1)
    return F.array_distinct(F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(marked, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>")))


def literal_grams(pattern: str) -> list[str]:
    """Grams that every term must hold which ``pattern`` matches as a whole.

    Read are letters and digits that stand for themselves, and dots, classes and groups as gaps; what may be missing or
    repeated (before ?, * or {) is a gap too, and a pattern with alternatives on its top level has no grams.
    """
    parts = re.findall(r"\\.|\[[^\]]*\]|\((?:[^()]|\([^()]*\))*\)|\{[^}]*\}|.", pattern)
    if "|" in parts:
        return []
    runs, run = [], BEGIN
    for i, part in enumerate(parts):
        after = parts[i + 1] if i + 1 < len(parts) else ""
        if re.fullmatch("[A-Za-z0-9]", part) and not after.startswith(("?", "*", "{")):
            run += part
            if after == "+":
                runs, run = [*runs, run], ""
        elif part not in "+?*" and not part.startswith("{"):
            runs, run = [*runs, run], ""
        elif part != "+":
            runs, run = [*runs, run], ""
    runs.append(run + END)
    return list(dict.fromkeys(r[i : i + GRAM] for r in runs for i in range(len(r) - GRAM + 1)))


class Vocabulary:
    """Terms under ``root``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, root: str, folders: int = FOLDERS):
        self.spark, self.root, self.folders = spark, root.rstrip("/"), folders
        self.versions = Versions(spark, root, "part string")

    def _path(self, what: str):
        return lambda part: f"{self.root}/{what}/{part}"

    def _parts(self) -> list[str]:
        return [r.part for r in self.versions.parts()]

    def _folder(self, c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.folders)).cast("int")

    def _filed(self, rows: DataFrame, key: str, path: str, n: int) -> None:
        """Write about ``n`` rows in folders by their key, a folder by so many tasks as its rows need."""
        pieces = max(4, -(-n // (self.folders * TASK_ROWS)))
        dealt = rows.withColumn("folder", self._folder(F.col(key))).repartition("folder", F.pmod(F.xxhash64(key, "term"), F.lit(pieces)))
        dealt.sortWithinPartitions("folder", key, "term").write.partitionBy("folder").parquet(path)

    def add(self, terms: DataFrame, instead: bool = False) -> None:
        """File the terms of ``terms`` (term) that are not filed yet; ``instead``: in the place of all."""
        new = terms.select("term").filter("term <> ''").distinct()
        if not instead:
            new = new.join(self.terms(), "term", "left_anti")
        part = self.versions.fresh()
        new = written(new, "terms")
        n = new.count()
        if not n:
            return
        self._filed(new, "term", self._path("terms")(part), n)
        self._filed(new.select("term", F.explode(filed_forms(F.col("term"))).alias("form")), "form", self._path("forms")(part), 10 * n)
        self._filed(new.select("term", F.explode(grams(F.col("term"))).alias("gram")), "gram", self._path("grams")(part), 8 * n)
        self.versions.publish([(p,) for p in ([] if instead else self._parts())] + [(part,)])

    def merge(self) -> None:
        if len(self._parts()) > 1:
            self.add(self.terms(), instead=True)

    def terms(self) -> DataFrame:
        return self.versions.read(self._parts(), self._path("terms"), "term string, folder int").select("term")

    def _table(self, what: str, key: str) -> DataFrame:
        return self.versions.read(self._parts(), self._path(what), f"term string, {key} string, folder int")

    def near(self, queries: DataFrame) -> DataFrame:
        """q, term, distance: for each q (q, most: 1 or 2) the terms within that edit distance."""
        wanted = queries.select("q", F.least("most", F.lit(DISTANCE)).alias("most")).filter("q <> ''").distinct()
        asked = wanted.select("q", "most", F.explode(asked_forms(F.col("q"), F.col("most"))).alias("form")).withColumn("folder", self._folder(F.col("form")))
        pairs = self._table("forms", "form").join(asked, ["folder", "form"]).select("q", "most", "term").distinct()
        return pairs.select("q", "term", "most", F.levenshtein("q", "term", DISTANCE).alias("distance")).filter("distance >= 0 AND distance <= most").drop("most")

    def _holding(self, wanted: Sequence[str]) -> DataFrame:
        """Terms that hold the rarest of the grams (all terms if there is none)."""
        if not wanted:
            return self.terms()
        folders = self.spark.range(1).select(F.array_distinct(F.transform(F.array(*map(F.lit, wanted)), self._folder))).head()[0]
        filed = self._table("grams", "gram").filter(F.col("folder").isin(folders) & F.col("gram").isin(list(wanted)))
        counts = {r.gram: r["count"] for r in filed.groupBy("gram").count().collect()}  # at most a row for each gram of the pattern
        rarest = min(wanted, key=lambda g: (counts.get(g, 0), g))
        return filed.filter(F.col("gram") == rarest).select("term")

    def matching(self, pattern: str) -> DataFrame:
        """The terms that a regular expression matches as a whole."""
        return self._holding(literal_grams(pattern)).filter(F.col("term").rlike(f"^(?:{pattern})$"))

    def beginning(self, prefix: str) -> DataFrame:
        marked = BEGIN + prefix
        return self._holding([marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1)]).filter(F.col("term").startswith(prefix))
