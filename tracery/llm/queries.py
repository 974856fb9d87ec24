"""Registered queries of the text operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracery.llm import (chat_format, decontaminate, near_dup, ppm, prefix_trie, secrets, spelling, substring_dedup, toxicity,
                         warc, winnow)
from tracery.llm.common import read


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_corpus(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(read(spark, sf_dir, "documents"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.successor_report(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.summary(warc.derivatives(warc.responses(read(spark, sf_dir, "pages"))))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


def op8_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracery.llm.pair_bpe import digest_documents

    return digest_documents(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"), words=4)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracery.llm.token_files import read_token_files, write_token_files

    folder = write_token_files(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, folder)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_control_turns(read(spark, sf_dir, "conversations"))
    return chat_format.read_back(spark, chat_format.write_formatted(rows))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate,
    op2_ppm_scores,
    op3_substring_dedup,
    op4_winnowing,
    op5_toxicity,
    op6_warc_derivatives,
    op7_secret_scan,
    op8_pair_bpe,
    op9_near_duplicates,
    op10_token_files,
    op11_spelling_variants,
    op12_prefix_trie,
    op13_chat_format,
)}
ORACLES: dict[str, str] = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op6_warc_derivatives": warc.oracle(),
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_chat_format": chat_format.ORACLE,
}
