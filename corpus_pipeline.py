"""Corpus pipeline: language, near duplicates, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.  A stage's result is written as Parquet
and read again as the next stage's docs.

Defined cases, for every stage: a null doc_id is kept as null; extra columns of
any name pass through all stages but the last; an empty table gives no rows.
What a stage does with null and empty texts, very long ones, ties and repeated
rows is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirelens.llm import bpe, decontaminate, jaccard, language, pii
from wirelens.llm.common import Scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (so null and empty texts), or whose n-grams are near no language's profile.

    Whole texts count, of any length; of languages at one distance the first in
    alphabetical order counts; repeated rows go or stay together.
    """
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of documents alike in 80 percent of their five-word shingles: one with the smallest id.

    Null ids come last; rows that are equal leave one; a text of under five
    words links with equal ones only.
    """
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item (or a whole shorter item); repeated rows go or stay together."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in texts by the kind in brackets; a null text stays null; of overlapping spans the better-scored one counts, then the left one."""
    return pii.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every row, repeated ones too; a null or empty text has no tokens."""
    return bpe.encode(docs, bpe.read_spec())


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("BPE encoding and decoding", tokenize),
]

#: Profiles, boosted trees and the tokenizer cannot be put in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result but the last is written in the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, f"stage{k + 1}")
    return docs
