"""A training-data pipeline of five stages over the documents table.

Each stage is written as Parquet in the shared folder and read back as the next
one's input. Stages: documents that the quality classifier rejects go; documents
that fail a quality rule go; one document of each group of near-duplicates stays;
sources are mixed to their target weights, each document as often as the mix takes
it; what is left is packed into sequences. All but the last return the columns of
``documents``.

``ORACLE_SQL`` is None: a trained model, seeded blocks and packing have no SQL; the
stages are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chosen_path, mixing, packing, quality_crf, rules
from tidemark.llm.common import prepared, stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores as good."""
    labels = table(prepared(spark), sf_dir, "labels")
    return quality_crf.good(docs, quality_crf.fit(quality_crf.split_off(docs), labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule."""
    prepared(spark)
    return rules.kept(docs)


def remove_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id; of rows with equal ids one."""
    prepared(spark)
    return chosen_path.distinct(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepared(spark)
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    prepared(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", remove_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
