"""Thin queries over whole tables: one per operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, context_tree, conversation_trie, decontaminate, html_blocks, mixing, ngram_join, randomness, rule_ledger, skip_chain, token_files, url_rules, vector_codes
from .common import read, shared_table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.fit(pages))


def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rule_ledger.open_ledger(rule_ledger.ledger(read(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        *rule_ledger.MEASURES,
        "fail_bits",
        (~rule_ledger.passes(rule_ledger.BASE)).alias("base_failed"),
        rule_ledger.passes(rule_ledger.STANDARD).alias("kept"),
    )


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels belong to the document whose id is the number in the path of its page."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    number = F.regexp_extract(url_rules.path_of(F.col("url")), r"/([0-9]{1,18})[^/]*/?$", 1)
    known = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id")).join(labels, "doc_id")
    labelled = known.select("url", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    rules = url_rules.mine(labelled)
    return url_rules.judge(pages, url_rules.inverted_index(rules, labelled))


def op6_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return skip_chain.report(skip_chain.find(docs, skip_chain.fit(docs)))


def op7_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shared_table(randomness.find(read(spark, sf_dir, "documents")), "secret-candidates")
    return randomness.report(found, randomness.accepted_places(found))


def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read(spark, sf_dir, "documents"), depth=context_tree.DEPTH)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    token_files.write_tokens(read(spark, sf_dir, "documents"), folder)
    return token_files.checksums(token_files.read_tokens(spark, folder))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.drop("hit_spans")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(byte_bpe.encode(read(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read(spark, sf_dir, "conversations"), family=20)


REGISTRY = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_mixing,
        op3_html_blocks,
        op4_rule_ledger,
        op5_url_rules,
        op6_skip_chain,
        op7_randomness,
        op8_context_tree,
        op9_token_files,
        op10_decontamination,
        op11_byte_bpe,
        op12_vector_codes,
        op13_conversation_trie,
    )
}
