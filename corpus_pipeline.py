"""A training corpus from raw documents, stage by stage.

Toxic documents go, one document of each group of near-duplicates stays, documents that hold a copy of a benchmark
item go, personal data are masked, and the rest becomes token ids. Each stage works on what its predecessor kept.

All stages take nulls in any column, empty and very long texts, repeated rows and empty tables, and all but the last carry
every column they are given, whatever its name. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import bpe, decontaminate, pii, simhash, toxicity
from mercato.llm.common import ship_package, table
from mercato.llm.queries import BYTE_RANKS, TOXIC_CHAIN
from mercato.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic. Null and wordless texts stay, copies of a row alike."""
    ship_package(spark)
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), TOXIC_CHAIN)
    return toxicity.score(docs, chain).filter(~F.col("toxic")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked; texts without words share fingerprint zero, so one stays."""
    ship_package(spark)
    return simhash.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item. Null and wordless texts stay; copies of a row stay or go together."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with placeholders for personal data; n_chars is that of the new text, null for a null text."""
    ship_package(spark)
    masked = pii.mask_pii(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and the hashes of the ids and of what they decode to; a null text has none."""
    ship_package(spark)
    ranks = public_tokenizers.path(BYTE_RANKS)
    coded = bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("bpe", encode),
]

ORACLE_SQL = None  # classifiers, fingerprints and alignments are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; what each stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
