"""The queries opN_<name>: each operator over its whole table, in the form that its contract states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import elias_fano, language_id, mpeg_audio, packing, quality_rules, sentencepiece_viterbi, simhash, toxicity, url_rules, warc
from .common import table


def tokenizer_path(name: str) -> str:
    """Where the installed package of public tokenizers has a file; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_audio.audio_round_trip(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = elias_fano.write_blocks(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return elias_fano.read_documents(blocks).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).drop("hits", "n_candidates")


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_model(docs, table(spark, sf_dir, "labels")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_components(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit_model(docs))


QUERIES = {
    "op1_mpeg_audio": op1_mpeg_audio,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_elias_fano": op3_elias_fano,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_rules": op5_url_rules,
    "op6_best_fit": op6_best_fit,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
}
