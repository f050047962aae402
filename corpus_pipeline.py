"""A corpus pipeline: quality rules, near duplicates, secrets, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's result as
Parquet in the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import bpe, mixing, neardup, quality, secrets
from promolens.llm.common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality holds, and which no base rule rejects.

    Null and empty texts have no words and go; null ids and repeated rows are judged by their texts,
    so equal texts share their fate; an empty table gives none.
    """
    return quality.keep_good(docs, COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near copies (five words, 0.8).

    Rows are compared under keys of their own, so null and repeated ids make no difference; null
    ids count as larger than all others.
    """
    rows = materialise(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_key")), "pipeline-rows")
    found = neardup.near_duplicates(rows.select(F.col("row_key").alias("doc_id"), "text"), width=5, percent=80)
    found = found.select(F.col("doc_id").alias("row_key"), "component_id").join(rows.select("row_key", "doc_id"), "row_key")
    firsts = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row_key")).alias("first"))
    return rows.join(firsts.select("first.row_key"), "row_key", "left_semi").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by its kind."""
    return secrets.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is a source of its own, null and empty texts have size 0; equal rows share their
    fate, ties in the hash are taken together; an empty table gives none.
    """
    return mixing.take_mix(docs, COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, their number, and digests of them and of what they decode to.

    Null and empty texts have no ids; null ids and repeated rows give a row each; an empty table
    gives none.
    """
    return bpe.code_documents(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scans", secret_scans), ("source_mix", source_mix), ("token_ids", token_ids)]

#: Label models, sketches, entropy and tokenisers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
