"""Corpus pipeline: stages over documents, each written as Parquet and read again.

Ordinary documents stay, one of each near-duplicate group stays, personal data is replaced in the texts, sources are mixed
to their targets (a document taken twice becomes two rows), and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.llm import bpe, mixing, pii, simhash, toxicity
from tilelake.llm.common import documents
from tilelake.runtime import new_table_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(docs, labels).filter(F.col("predicted") == 0).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of smallest id and, of several texts under it, of smallest digest.

    Fingerprints are compared on narrow rows; texts are shuffled once, by id and digest. A component without any id keeps
    one of its texts, and of repeated rows one stays.
    """
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))  # null for a null text
    docs = docs.select(*COLUMNS, digest.alias("_digest"))
    found = simhash.near_duplicates(docs.select("doc_id", "text", "_digest"), keep_text=False, group_col="_group")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("keeper"), F.col("_digest").alias("of")))
    chosen = found.groupBy("_group").agg(first.alias("x")).select("x.keeper", "x.of")
    same = docs["doc_id"].eqNullSafe(chosen["keeper"]) & docs["_digest"].eqNullSafe(chosen["of"])
    return docs.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced in its text."""
    return pii.find(docs.select(*COLUMNS), redact=True).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row; each text decodes from them."""
    return bpe.encode(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]
#: Models, fingerprints and the automaton are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = new_table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
