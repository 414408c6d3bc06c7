"""Corpus pipeline: from raw documents to packed training sequences.

Stages, each written as Parquet and read again as the next one's documents:

1. toxicity: documents that the severity model rejects go;
2. exact duplicates: of equal texts the one with the largest id stays;
3. near duplicates: of each group of documents linked by five-word shingles the least id stays;
4. mixing: documents are left out or repeated so that sources meet their target weights;
5. packing: token sequences of at most 2,048 tokens.

All stages but the last return the columns of their input, with any further ones whatever their names:
operators see them under neutral names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from riskmart.llm.common import hide, ship, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels)
    base, (id_at, text_at), restored = hide(docs, "doc_id", "text")
    return toxicity.score(base, model, id_at, text_at).filter("not rejected").select(*restored)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    base, (id_at, text_at), restored = hide(docs, "doc_id", "text")
    return exact_dedup.exact_dedup(base, id_at, text_at).filter("kept").select(*restored)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.first_of_groups(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    base, (id_at, source_at, text_at), restored = hide(docs, "doc_id", "source", "text")
    return mixing.emit(mixing.mix(base, id_at, source_at, text_at)).select(*restored)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model decides the first stage, which SQL cannot express; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs
