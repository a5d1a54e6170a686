"""The training-data pipeline: five stages over ``documents``, each written as
Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglark.llm import decontamination, language_id, mixing, simhash_vptree, token_output
from loglark.llm.common import prepare, saved, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted."""
    prepare(spark)
    return language_id.accepted_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (4-word shingles, at most 4 bits)."""
    prepare(spark)
    return simhash_vptree.keep_one_each(docs, width=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mix of their sources; one that is taken twice comes twice."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of what is left, and per document its place in them."""
    import public_tokenizers
    prepare(spark)
    return token_output.encode_corpus(docs, public_tokenizers.path("word_bpe_49k.json"), 1)


STAGES = [("language", identify_language), ("near_duplicates", drop_near_duplicates), ("decontamination", decontaminate),
          ("mixing", mix_sources), ("tokens", write_tokens)]

#: Fingerprints, latent search and a library's token ids are not SQL: tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
