"""Corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

Quality rules drop the documents they reject; line dedup removes repeated
lines (and documents of nothing else); the n-gram Jaccard join keeps one
document of each group of near copies (five-word shingles, similarity 0.8);
benchmark decontamination drops contaminated documents; mixing emits each
document once per copy that its source's target asks for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontam, line_dedup, mixing, parity_join, quality
from tallyforge.llm.util import read, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.keep_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return parity_join.keep_first(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.emit(mixing.mix(docs))
    return mixed.select(*docs.columns, "copy")


STAGES = [("quality rules", quality_rules), ("line dedup", line_deduplication), ("n-gram Jaccard join", jaccard_join),
          ("benchmark decontamination", decontamination), ("mixing sources", mix_sources)]
# near duplicates and union-find have no SQL form; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; stages are written under the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    out = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{out}/{i}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
