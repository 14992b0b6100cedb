"""Clean, mix and pack a corpus: five stages over ``documents``.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next one's documents. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import mixing, packing, quality, secrets, simhash
from tidewatch.llm.common import table
from tidewatch.plans import stage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of three-word shingles differ in at
    most three bits."""
    return simhash.one_of_each(docs, radius=simhash.RADIUS, shingle=simhash.SHINGLE)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets blanked."""
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("secret scan", clean),
    ("mixing", mix),
    ("packing", pack),
]
# Trees, tokens and the cube method have no SQL form; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
