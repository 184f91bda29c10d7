"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, tokens.

Each stage gets the documents that its predecessor kept, written as Parquet and read again, and returns documents with
the same columns; the last adds tokens. What each stage decides takes effect: documents in none of the learned languages go,
and those without a lang get theirs; of each group with links of 80 % (the usual threshold; only op3's contract says 85 %) the
smallest doc_id stays; documents with a benchmark passage go; personal data, secrets and disclosing words are replaced.

Edge cases: null and empty texts, and those without a letter, go with the first stage; repeated rows stay or go together; rows
without an id stay, as nothing smaller stands for them; long texts are read whole by each stage; an empty table gives an empty
result with the columns of any other; all columns stay, whatever their names; the token columns get an underscore in front where
their names are taken; ties are settled as each operator's docstring says.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from maskframe.llm.bpe import tokenizer_json, with_tokens
from maskframe.llm.common import Scratch, bounded_batches, table
from maskframe.llm.decontam import decontaminated
from maskframe.llm.langid import in_a_language
from maskframe.llm.neardup import deduplicated
from maskframe.llm.pii import sanitised


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly in one of the learned languages."""
    bounded_batches(spark)
    return in_a_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group."""
    bounded_batches(spark)
    return deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    bounded_batches(spark)
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it replaced."""
    bounded_batches(spark)
    return sanitised(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their tokens, their number, and a digest of the decoded text."""
    bounded_batches(spark)
    return with_tokens(docs, tokenizer_json())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("bpe_tokens", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, with a written table between each two."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    return functools.reduce(lambda d, stage: scratch.save(stage[1](spark, d, sf_dir)), STAGES, docs)


#: No stage can be told in SQL; tests hold each against a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
