"""Corpus pipeline over the documents table: language, quality, near duplicates, packing.

Every stage is a function of (session, documents, table folder).  All but the
last return rows of their input with its columns.  A stage decides by row
(language, quality) or by id and text (near duplicates), stores the rows that go
as narrow keys, and takes them out of its input: rows that are surely not among the keys by
a broadcast table of bits stay where they are, the others are joined (``common.without``).

Rows with null id pass the first two stages by their own merits, stay in a group
of near duplicates only if none of it has an id, and are packed.  Empty tables
pass as empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import language, packing, partenum, quality
from tripmart.llm.common import among, materialise, read, without

ROW = "pipeline_row_key"


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """With a key of what a decision depends on, so equal rows get equal decisions; nulls count, and where they are."""
    if ROW in docs.columns:
        raise ValueError(f"a column of documents is named {ROW}")
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return docs.withColumn(ROW, F.xxhash64(*values, *(F.col(c).isNull() for c in columns)))


def _without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return without(docs, materialise(gone.select(key).distinct(), "gone"), key)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told."""
    rows = keyed(docs, "doc_id", "text", "source")
    judged = language.of_documents(rows, language.learn(docs), id_col=ROW)
    return _without(rows, judged.where("rejected"), ROW).select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier holds for label 0."""
    net = quality.learned(docs, read(spark, sf_dir, "labels"))
    rows = keyed(docs, "doc_id", "text", "source")
    return _without(rows, quality.scored(rows, net, id_col=ROW).where("score < 0.5").withColumnRenamed("doc_id", ROW), ROW).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group, with the smallest id there is; near are 0.8 of the shingles of five words.

    Id and text together are a document, so rows of one id with different texts
    are judged apart, and rows with null id by their texts.
    """
    rows = keyed(docs, "doc_id", "text")
    groups = materialise(
        partenum.similar_groups(rows, n=5, similarity=80, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id"), "groups"
    )
    leaders = groups.join(rows.select(ROW, "doc_id").distinct(), ROW).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW)).alias("first")
    ).select(f"first.{ROW}")
    gone = materialise(groups.join(leaders, ROW, "left_anti").select(ROW).distinct(), "gone")
    often = materialise(
        rows.groupBy(ROW).count().where("count > 1").select(ROW).join(gone, ROW, "left_anti"), "repeated"
    )
    once = without(rows, gone.unionByName(often), ROW)
    first = among(rows, often, ROW).groupBy(ROW).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return once.select(docs.columns).unionByName(first.select(docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


STAGES = [
    ("language_id", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]
# Learned tables, a network and a tokenizer are not SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
