"""The corpus pipeline: raw documents to mixed token records.

STAGES are applied in order; each is written as Parquet and read again as the next one's
documents. ``run`` does so in the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import new_folder, table, text_of, unused
from riskframe.llm.decontamination import contaminated
from riskframe.llm.mixing import mixed_documents
from riskframe.llm.near_duplicates import rooted_documents
from riskframe.llm.quality_rules import quality_rules
from riskframe.llm.queries import tokenizer_path
from riskframe.llm.records import token_records


def _only(docs: DataFrame, texts: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose text is, or is not, among ``texts`` (node: hash of a text)."""
    (node,) = unused(docs, "node")
    nodes = texts.select("node").distinct().withColumnRenamed("node", node)
    return docs.join(nodes, F.xxhash64(text_of()) == F.col(node), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a verdict depends on text and language.

    NULL and empty texts have too few words and go; very long ones are judged whole.
    Repeated rows have one verdict; an empty table stays empty; further columns are kept.
    """
    node, lang = unused(docs, "node", "lang")
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    good = judged.where("kept").select(F.col("node").alias(node), F.col("stratum").alias(lang)).distinct()
    same = F.col("lang").cast("string").eqNullSafe(F.col(lang))
    return docs.join(good, (F.xxhash64(text_of()) == F.col(node)) & same, "left_semi")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: that of the least doc_id (NULL last), then of the least text hash.

    Rows with NULL doc_id, and different texts under one doc_id, count each for its own
    class; NULL and empty texts are one class. Of rows with the same doc_id and text the
    least by all columns is kept. An empty table stays empty; further columns are kept.
    """
    d, n = unused(docs, "d", "n")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")
    classes = rooted_documents(docs).groupBy("root").agg(first)
    classes = classes.select(F.col("first.doc_id").alias(d), F.col("first.node").alias(n))
    doc_id, node = F.col("doc_id").cast("long"), F.xxhash64(text_of())
    kept = docs.join(classes, doc_id.eqNullSafe(F.col(d)) & (node == F.col(n)), "left_semi")
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    return kept.groupBy(doc_id.alias(d), node.alias(n)).agg(row).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    NULL and empty texts hold none; of very long texts every part is searched; repeated
    rows and ties in the alignment share a verdict; empty tables on either side keep all
    that there is; further columns are kept.
    """
    return _only(docs, contaminated(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, the last of a source in part.

    NULL and empty texts are taken once; very long ones are cut at a word; repeated rows
    share what they take; a NULL source is a source; an empty table stays empty; further
    columns are kept.
    """
    return mixed_documents(docs)


def records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of all rows, from the files read back.

    NULL and empty texts are the end id alone; very long texts are one record; repeated
    rows and NULL ids are records of their own; an empty table gives no rows.
    """
    return token_records(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_records", records),
]

#: Signatures, alignments and token ids are beyond SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{new_folder(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
