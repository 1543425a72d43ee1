"""Documents for an external index: one JSON-ready row per page, and checks of what an index would refuse."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column types that an index accepts as metadata.
SCALARS = (T.StringType, T.BooleanType, T.NumericType)


def export_documents(df: DataFrame, key: Column, text: Column, metadata: Mapping[str, Column]) -> DataFrame:
    """``_id``, ``text``, the metadata, and counts of characters and words where there is text; nulls are left to the JSON writer to drop."""
    trimmed = F.trim(text, F.lit(" \t\n\r"))
    counted = lambda n: F.when(F.length(trimmed) > 0, n)
    n_words = F.size(F.split(trimmed, r"[ \t\n\r]+"))
    return df.select(key.alias("_id"), F.coalesce(text, F.lit("")).alias("text"), *(c.alias(n) for n, c in metadata.items()), counted(F.length(text)).alias("char_count"), counted(n_words).alias("word_count"))


def acceptable(df: DataFrame) -> DataFrame:
    """Only the columns that may be metadata: no reserved first character; scalars and lists of strings."""

    def ok(f: T.StructField) -> bool:
        listed = isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)
        return f.name == "_id" or (not f.name.startswith(("_", "$")) and (listed or isinstance(f.dataType, SCALARS)))

    return df.select(*(f.name for f in df.schema if ok(f)))


def violations(df: DataFrame) -> DataFrame:
    """_id and rule of each breach: blank_id, no_text, duplicate_id (once for each id). Column rules are ``acceptable``'s."""
    blank = F.coalesce(F.trim("_id"), F.lit("")) == ""
    rows = df.select("_id", F.explode(F.filter(F.array(F.when(blank, "blank_id"), F.when(F.col("text").isNull(), "no_text")), lambda x: x.isNotNull())).alias("rule"))
    twice = df.filter(~blank).groupBy("_id").count().filter("count > 1").select("_id", F.lit("duplicate_id").alias("rule"))
    return rows.unionByName(twice)


def write_jsonl(df: DataFrame, path: str, rows_per_file: int | None = None, by: str | None = None, mode: str = "errorifexists") -> None:
    """JSON lines, in files of at most so many rows, in a folder for each value of ``by``; ``mode``: append or overwrite."""
    w = df.write.mode(mode).option("ignoreNullFields", "true")
    w = w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w
    (w.partitionBy(by) if by else w).json(path)


def index_schema(df: DataFrame) -> str:
    """The types of an index's fields, as JSON: what ``acceptable`` leaves, the text as full text."""
    kind = lambda t: "string_list" if isinstance(t, T.ArrayType) else "boolean" if isinstance(t, T.BooleanType) else "number" if isinstance(t, T.NumericType) else "string"
    return json.dumps({"fields": {f.name: {"type": kind(f.dataType), **({"full_text_search": True} if f.name == "text" else {})} for f in acceptable(df).schema if f.name != "_id"}})
