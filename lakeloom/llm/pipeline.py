"""Stages of the training-corpus pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Rows with a null id pass through the
stages that work by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from lakeloom.llm._io import held_out, read, staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go: texts that are null or
    have no letter, and predictions below its calibrated confidence."""
    return langid.accepted(docs, langid.fit(docs, ~held_out("doc_id", 4, 2)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in one document only; ``n_chars`` follows."""
    out = line_dedup.dedup_lines(docs)
    return out.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (sets of 5-word shingles with a similarity
    of 0.8 or more) the smallest id stays."""
    return ngram_join.drop_near_duplicates(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``mix_rate``; documents that are never drawn go."""
    return mixing.weighted(docs, read(spark, sf_dir, "labels"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

#: classifiers, sketches and fits: no SQL gives these rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage-{k}")
    return docs
