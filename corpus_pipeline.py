"""Corpus pipeline: toxicity, quality, near duplicates, packing, each on what the stage before kept.

Every stage but the last returns the columns of ``documents``; its result is
written as Parquet below the shared checkpoint folder and read again. Columns
that a document table has besides, under whatever name, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import small_if, staged, text_column
from riskweave.llm.kneser_ney import judge
from riskweave.llm.ngram_join import near_duplicates
from riskweave.llm.queries import packed
from riskweave.llm.toxicity import fit, score
from riskweave.session import read_table


def _whole(docs: DataFrame):
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    model = fit(docs.select("doc_id", "text"), read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    found = score(docs.select(_whole(docs), "text"), model)
    return found.filter("predicted = 0").select("kept.whole.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within the limits of their language."""
    found = judge(docs.select(_whole(docs), "doc_id", "lang", "text"),
                  read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return found.filter("keep").select("kept.whole.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id (of equal ids the first row)."""
    # Rows are numbered in a written copy, so that no two share a name and a repeated task gives the same ones.
    rows = staged(docs.select(_whole(docs), F.monotonically_increasing_id().alias("row")), "pipeline-rows")
    texts = rows.select("row", text_column("whole.text").alias("text"))
    found = near_duplicates(texts, id_col="row").filter("n_links > 0").select("row", "class_id")
    members = staged(found.join(rows.select("row", F.col("whole.doc_id").alias("doc_id")), "row"), "pipeline-members")
    heads = members.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), "row"))["row"].alias("row"))
    others = staged(members.join(heads.select("row"), "row", "left_anti").select("row"), "pipeline-others")
    return rows.join(small_if(others), "row", "left_anti").select("whole.*")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents and their places in sequences of 4096 tokens."""
    return packed(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("packing", pack_documents),
]

#: No SQL expresses the models; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
