"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.llm import (bpe, extraction, interactions, language, mixing, privacy, quality, sharding, simhash, spans, spelling, urlfilter,
                           winnowing)
from linkgraph.llm.common import read

MIX_WEIGHTS = (5, 2, 1)


def vocabulary() -> str:
    """Path of the byte-level BPE vocabulary of 50,257 tokens, as installed on every machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness."""
    return winnowing.edited_comparison(read(spark, sf_dir, "documents"))


def op2_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentence spans that an earlier one has."""
    return spans.dedup(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def language_model(docs: DataFrame) -> dict:
    """The language model learned from the documents that are not held out."""
    kept = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4, F.lit(2)) != 2)
    return language.load(language.train(kept))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; ids with crc32 mod 4 = 2 are held out from learning."""
    docs = read(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents whose sources weigh 5, 2, 1, repeating."""
    return mixing.mix(read(spark, sf_dir, "documents"), MIX_WEIGHTS).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extraction.extract_pages(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity verdict of every document."""
    return quality.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded text, as digests."""
    return bpe.encode_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page capture against the list entries that were active when it was fetched."""
    pages = read(spark, sf_dir, "pages")
    return urlfilter.filter_captures(urlfilter.demo_captures(pages), urlfilter.demo_entries(pages))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with format-preserving pseudonyms for personal data."""
    return privacy.pseudonymize(read(spark, sf_dir, "documents"))


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; equal texts share a shard, and shards have nearly equal bytes."""
    return sharding.slots(read(spark, sf_dir, "documents"))


def op12_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at every step of every order, per language."""
    return interactions.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents, some of whose runs lose a code point."""
    return spelling.variants(spelling.word_counts(read(spark, sf_dir, "documents"), spoil=spelling.SPOIL)).select(
        "word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnow": op1_winnow,
    "op2_spans": op2_spans,
    "op3_simhash": op3_simhash,
    "op4_language": op4_language,
    "op5_mix_sources": op5_mix_sources,
    "op6_extract": op6_extract,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_url_filter": op9_url_filter,
    "op10_pseudonyms": op10_pseudonyms,
    "op11_shards": op11_shards,
    "op12_interactions": op12_interactions,
    "op13_spellings": op13_spellings,
}

ORACLE: dict[str, str] = {
    "op9_url_filter": urlfilter.ORACLE,
    "op12_interactions": interactions.ORACLE,
}
