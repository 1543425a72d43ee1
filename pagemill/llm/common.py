"""Definitions that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import scratch

#: A word: a longest run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Tables of at most so many rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """Columns as one struct, so that none of their names can meet one of an operator's own."""
    return F.struct(*[F.col(quoted(c)) for c in (df.columns if names is None else names)])


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark for broadcast if ``df`` (cheap to evaluate, narrow rows) is checked to be small; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_lock = Lock()
#: For each setting in use: how many hold it, and its value before the first did.
_held: dict[tuple[int, str], tuple[int, str]] = {}


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as underscores after ``spark.sql.``) for the jobs that run meanwhile.

    Several threads may hold the same setting of a session, at one value; it goes back when the last one is done.
    """
    named = {f"spark.sql.{k.replace('_', '.')}": v for k, v in values.items()}
    with _lock:
        for k, v in named.items():
            n, before = _held.get((id(spark), k), (0, spark.conf.get(k)))
            _held[id(spark), k] = n + 1, before
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _lock:
            for k in named:
                n, before = _held.pop((id(spark), k))
                if n > 1:
                    _held[id(spark), k] = n - 1, before
                else:
                    spark.conf.set(k, before)


#: Rows that go to Python at a time: texts are large, and a task holds a batch in several forms.
BATCH_ROWS = "1000"


def written(df: DataFrame, name: str) -> DataFrame:
    """``scratch.written`` with batches for Python that suit whole texts."""
    with settings(df.sparkSession, execution_arrow_maxRecordsPerBatch=BATCH_ROWS):
        return scratch.written(df, name)
