"""The corpus pipeline: each stage calls one training-data operator on all that the stage before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's documents.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.llm import bpe, language, mixing, privacy, simhash
from linkgraph.llm.common import read, stash
from linkgraph.llm.queries import MIX_WEIGHTS, language_model, vocabulary

#: A prediction below this probability is a rejection, like ``und``.
MIN_LANGUAGE_SCORE = 0.35


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language that can be told go."""
    found = language.identify(docs, language_model(docs))
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: validated personal data give way to pseudonyms."""
    return privacy.pseudonymize(docs, count=None)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: rows as often as the mix takes them."""
    return mixing.mixed(docs, MIX_WEIGHTS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: every row's tokens, as count and digests, beside its id and source."""
    return bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), vocabulary()).drop("text")


STAGES = [
    ("language ID", language_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("PII", privacy_stage),
    ("mix sources", mix_stage),
    ("BPE", token_stage),
]

#: The stages cannot be told in SQL; a test compares them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
