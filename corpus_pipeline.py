"""Corpus pipeline: documents -> training data, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is
written as Parquet into the shared folder and read again as the next stage's
``docs``. All stages but the last return the columns of ``documents``.

Every decision is taken by row. NULL, empty and very short texts go in the
first stage; rows without an id, and rows that share one, are judged like any
other and have their own row in the result; of equal texts one row stays; an
empty table gives no rows; more columns, of any name, travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, mixing, quality, simhash, tokenids
from strata.llm.common import materialize, prepare, stored_order
from strata.llm.queries import MIX_BLOCK, MIX_OTHER, MIX_SHARES, token_digest, tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    prepare(spark)
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    prepare(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.drop_contaminated(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the written files follow one
    another by slot."""
    prepare(spark)
    return mixing.mixed(docs, MIX_SHARES, MIX_OTHER, MIX_BLOCK)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in the stored order of ``docs`` (that of the mix), read back
    through the key index: doc_id, start, n_tokens, ids_crc32."""
    prepare(spark)
    ordered, order = stored_order(docs)
    return token_digest(tokenids.write(ordered, tokenizer_file("word_bpe_49k.json"), order_by=order), docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

# SQL has neither XXH64 nor a tokenizer: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
