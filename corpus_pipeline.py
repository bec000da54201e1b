"""A training corpus from raw documents, in stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grainledger.llm import byte_bpe, decontam, quality, simhash, substrings
from grainledger.llm.queries import TOKENIZERS
from grainledger.llm.storage import TEXTS, batches, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; its labels are those of the rows at hand.

    Null and empty texts are judged by the classifier's bias; repeated rows and null ids are judged each; an empty
    table stays empty; texts are read whole, however long; all columns are kept as they are.
    """
    with batches(spark, TEXTS):
        return settle(quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "good")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document has.

    Null texts stay null; rows that share a doc_id, or have none, are documents of their own behind the others; an
    empty table stays empty; n_chars follows the text, other columns are kept as they are.
    """
    return settle(substrings.drop_repeats(docs), "cut", batch=TEXTS)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, as do null ids and repeated rows of clean texts; items that are null are
    not looked for; an empty table stays empty; texts are searched whole; all columns are kept as they are.
    """
    return settle(decontam.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "clean", batch=TEXTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document.

    A null text is an empty one; repeated rows and null ids get their rows; an empty table gives no rows.
    """
    ranks = byte_bpe.load_ranks(os.path.join(TOKENIZERS, "byte_bpe_multi_50k.tiktoken"))
    # rows become lists of words here, several times as wide as their texts
    return settle(byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN), "byte_bpe", batch=TEXTS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("repeated_passages", cut_repeats),
    ("benchmark_leaks", keep_clean),
    ("byte_bpe", tokens),
]

#: SQL can express neither the fitted classifier nor the reachability of the second stage; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
