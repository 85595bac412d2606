"""Corpus pipeline: toxic documents go, one of each group of near-duplicates
stays, personal data is masked, sources are mixed to their weights, and what is
left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet to the shared checkpoint folder and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.

Defined cases: the operators' own (see their modules).  A row with a null id is
judged by its text alone and is never a near-duplicate.  A masked text has its
``n_chars`` set anew.  A document that the mix repeats is a row for each copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.llm import mixing, sanitise, sentencepiece_codec, simhash_dedup, toxicity
from roadsight.llm.tables import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sanitise.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = sentencepiece_codec.encode(docs, keep=("doc_id", "lang", "source", "n_chars"))
    return ids.withColumn("n_ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: A trained model, fingerprints by XXH64 and a tokenizer are beyond SQL; the
#: stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
