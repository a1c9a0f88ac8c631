"""Training text from ``documents`` in stages, each one operator of ``cloudtally.llm``.

Documents that a quality rule rejects go; of each group of near duplicates one stays; documents that hold benchmark
passages go; the rest is put in the order of a mix of sources, and leaves as token files in that order. Stages before
the last return the columns of ``documents`` as they came. A stage's docs are a written table: rows are told apart by
their place in it, so ids may repeat or be null.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.llm import fm_decontam, pfair_mix, rule_ledger, simhash_links, token_files
from cloudtally.llm.common import shared_folder, written
from cloudtally.llm.queries import QUALITY_POLICY, TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the policy."""
    return rule_ledger.ledger(docs).filter(~rule_ledger.failed(rule_ledger.POLICIES[QUALITY_POLICY])).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links connect: that of the smallest id."""
    return simhash_links.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return fm_decontam.judged(docs, benchmark).filter("not contaminated").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted by the mix: the files written from it hold it in the order of their names."""
    return pfair_mix.in_mixed_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the docs' files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` read back."""
    docs = docs if docs.inputFiles() else written(docs)
    placed = docs.select(
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"), "doc_id", "text"
    )
    folder = shared_folder(spark)
    order = ["_file", "_row"]
    token_files.write_tokens(placed, folder, public_tokenizers.path(TOKENIZER), order, keep=["doc_id"])
    return token_files.token_digests(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("source_mix", mixed),
    ("token_files", tokens),
]
#: Neither fingerprints nor token ids can be said in SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        folder = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
