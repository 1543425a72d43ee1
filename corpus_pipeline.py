"""The corpus pipeline: quality rules, near-dedup, secret redaction, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm.common import table
from pagemill.llm.mixing import mix
from pagemill.llm.neardup import keep_one
from pagemill.llm.packing import pack
from pagemill.llm.quality import filter_quality
from pagemill.llm.secrets import redact
from pagemill.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("secrets", secret_scans), ("mix", mixing), ("pack", packing)]
#: A trained forest and sketches are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"stage-{name}")
    return docs
