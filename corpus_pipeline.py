"""The training-corpus pipeline: stages over `documents`, each written and reread.

Every stage works on all that the one before it kept.  The first four return
the columns of `documents`; the last adds `copies`, how often a document is
to be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm import decontam, jaccard_join, langid, mixing, suffix_dedup
from auric.llm.textbatch import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told: only empty texts and those without
    a letter are rejected, so no short text is lost to a low score; `lang` stays as it was given."""
    found = langid.identify(docs, langid.fit(docs))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of the n-gram Jaccard join."""
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what repeats 50 bytes of a document with a smaller id."""
    return suffix_dedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold too much of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the mix takes, with the number of copies of each document."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: The language model and the byte-wise cuts have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each to what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs

