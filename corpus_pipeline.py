"""The corpus pipeline: quality rules, near-duplicates, decontamination, PII, mixing.

Part of the training-data subpackage.  Each stage takes the documents that
the one before it kept, whole, and its decisions take effect; what a stage
returns is written as Parquet in the shared checkpoint folder and read again.

Defined results: rows with a null or empty text fail the quality rules' base;
null ids, languages and sources are values like any other; repeated rows are
one SimHash component, of which the smallest doc_id stays; texts are never
cut; columns that documents carry besides stay as they are up to the last
stage; without documents every stage gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from captally.llm import decontamination, mixing, pii, quality_rules, simhash_dedup
from captally.operators.materialize import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash_dedup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, benchmark)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str | None = None) -> DataFrame:
    """What the mix takes of every document that is left; the mixed texts stay in folder ``out`` if it is given."""
    return mixing.mix_report(docs, out=out)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact_pii),
    ("mixing", mix),
]

#: SimHash components, spaced seeds, EM and permutations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    """All stages over ``documents``; with ``out`` the mixed corpus itself is kept in that folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return mix(spark, docs, sf_dir, out)
