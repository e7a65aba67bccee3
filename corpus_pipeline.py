"""The corpus pipeline: five stages from raw documents to encoded training data.

Each stage gets (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, jaccard, mixing, quality
from tidemark.session import remove, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule passes."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.drop_duplicates(docs, keep="max")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar shingle sets join: the one with the smallest id."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; what it does not take is left out."""
    return mixing.training_order(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a digest of the text that they decode to."""
    coder = bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.encode_documents(docs, coder)
    return encoded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mix),
    ("BPE", encoding),
]

#: The stages rest on regular expressions, a graph search and a tokenizer; tests hold run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = []
    for k, (_, stage) in enumerate(STAGES):
        done.append(scratch_path(spark, f"corpus-{k}"))
        stage(spark, docs, sf_dir).write.parquet(done[-1])
        docs = spark.read.parquet(done[-1])
        remove(spark, done[:-1][-1:])  # the stage before is not read again
    return docs
