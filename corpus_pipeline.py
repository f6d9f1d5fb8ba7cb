"""From raw documents to packed sequences: five stages, each one of the corpus operators.

A stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolyard.llm.common import stored, table
from schoolyard.llm.language import accepted, learn
from schoolyard.llm.linetree import drop_recurring_lines
from schoolyard.llm.mixing import mix
from schoolyard.llm.packing import pack
from schoolyard.llm.queries import vocabulary
from schoolyard.llm.simhash import one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without letters go."""
    return accepted(docs, learn(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template recurs; n_chars follows the text."""
    cleaned, _ = drop_recurring_lines(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return one_of_each(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1,024 tokens."""
    return pack(docs, vocabulary(), capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]

#: SQL cannot express the models, fingerprints and draws of these stages; tests hold each of
#: them against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
