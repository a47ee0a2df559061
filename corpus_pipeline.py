"""From raw documents to token files: quality rules, near duplicates, decontamination, mix, token ids.

Every stage takes (spark, docs, sf_dir) and gets its predecessor's rows from Parquet. All but
the last return the columns of ``docs``; the last returns one row per encoded document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, ngram_join, rule_ledger, token_files
from tidemark.llm.common import read
from tidemark.operators.scale import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the standard policy of the rule ledger accepts."""
    return rule_ledger.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in windows of benchmark items."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target shares."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens and ids_crc32 per document taken."""
    folder = token_files.new_folder(spark)
    token_files.write_tokens(docs, folder)
    return token_files.checksums(token_files.read_tokens(spark, folder))


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_files", tokens),
]

#: SQL has no such tokenizer; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return out
        path = f"{folder}/{number}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
