"""Splitting page texts into chunks of bounded token counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that a chunk should hold, and characters below which it isn't split off.
TARGET, LEAST_CHARS = 500, 24


def word_chunks(pages: DataFrame, size: int = TARGET) -> DataFrame:
    """``pages`` (with ``text``) as runs of ``size`` whitespace words, in the JVM; adds chunk_index, chunk_count, token_count."""
    words = F.filter(F.split("text", r"[ \t\n\r]+"), lambda w: w != "")
    df = pages.withColumn("_w", words).withColumn("chunk_count", F.ceil(F.size("_w") / size).cast("int")).filter("chunk_count > 0")
    df = df.withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("chunk_count") - 1)))
    part = F.slice("_w", F.col("chunk_index") * size + 1, size)
    return df.withColumn("text", F.array_join(part, " ")).withColumn("token_count", F.size(part)).drop("_w")


def split_text(text: str, count: Callable[[str], int], target: int = TARGET, least: int = LEAST_CHARS, marks: tuple[str, ...] = ("\n\n", "\n", ". ", " ")) -> list[str]:
    """Pieces of at most ``target`` tokens, parted at the coarsest mark that serves; they add up to the text."""
    if count(text) <= target:
        return [text]
    if not marks:
        middle = len(text) // 2
        return split_text(text[:middle], count, target, least, ()) + split_text(text[middle:], count, target, least, ()) if middle else [text]
    mark, out = marks[0], [""]
    parts = text.split(mark)
    for part in [p + mark for p in parts[:-1]] + [parts[-1]]:
        if out[-1] and (count(out[-1] + part) > target and len(out[-1]) >= least):
            out.append("")
        out[-1] += part
    return [piece for x in out if x for piece in split_text(x, count, target, least, marks[1:])]


def whitespace_tokens(text: str) -> int:
    return len(text.split())


def recursive_chunks(pages: DataFrame, counter: Callable[[], Callable[[str], int]] = lambda: whitespace_tokens, target: int = TARGET, least: int = LEAST_CHARS) -> DataFrame:
    """Like ``word_chunks``, but parted at paragraphs, lines, sentences, then words.

    ``counter`` makes a token counter in each task, for instance from a tokenizer's vocabulary file.
    Blank chunks are dropped, but keep their place in the numbering.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter()
        for texts in batches:
            yield texts.map(lambda t: [{"text": p.strip(), "token_count": count(p)} for p in split_text(t or "", count, target, least)])

    split = F.pandas_udf(run, "array<struct<text string, token_count int>>")
    df = pages.withColumn("_c", split("text")).withColumn("chunk_count", F.size("_c"))
    df = df.select(*[c for c in df.columns if c not in ("text", "_c")], F.posexplode("_c").alias("chunk_index", "_p"))
    return df.filter("_p.text != ''").withColumns({"text": F.col("_p.text"), "token_count": F.col("_p.token_count")}).drop("_p")
