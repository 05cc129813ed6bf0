"""A corpus pipeline: reject bad documents, drop near duplicates, cut repeats, drop leaks, mix sources.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, jaccard_join, mixing, quality, storage, suffix_dedup, textbatch
from tessera.session import visible


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the training rows of ``labels``, does not reject.

    Null and empty texts are scored like any other text; rows without an id are scored too; repeated rows stay or go together; an empty
    table stays empty. Other columns are kept, whatever their names.
    """
    labels = _table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    p = textbatch.fresh(docs, "p_good")
    return quality.score(docs, quality.fit(docs, labels), p).where(F.col(p) >= quality.THRESHOLD).drop(p)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates (five-word shingles, Jaccard 0.8 or more), the document with the least id.

    Documents without words (null, empty, blank) are no duplicates of others. Only linked or equal texts compete: other texts stay, also
    without an id (which comes first) or under one that repeats. Of rows of a component that repeat the least id, the one with the least row hash is
    kept; of rows that repeat id and text, one. An empty table stays empty. Other columns are kept, whatever their names.
    """
    classes = jaccard_join.jaccard_classes(docs, k=5, percent=80)
    key = textbatch.fresh(docs, "k_rid")
    first = classes.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct("doc_id", "rid")).alias("kept"))
    kept = first.select(F.col("kept.rid").alias(key)).unionByName(classes.where("n_shingles = 0").select(F.col("rid").alias(key)).distinct())
    # rows that repeat meet before they are dealt by row, so that many of them are one in each task already
    rows = docs.withColumn(key, textbatch.row_id("doc_id", "text")).dropDuplicates([key])
    return rows.join(kept.hint("merge"), key, "left_semi").drop(key)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur elsewhere too; those of which nothing is left go, those empty before stay.

    Null texts stay null. Rows that repeat id and text are copies of each other and are cut like any others. An empty
    table stays empty. Other columns are kept, whatever their names; ``n_chars`` follows the text.
    """
    empty = textbatch.fresh(docs, "k_empty")
    out = suffix_dedup.dedup_documents(docs.withColumn(empty, F.coalesce(F.length("text") == 0, F.lit(True))))
    return out.where((F.length("text") > 0) | F.col(empty)).drop(empty)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark is found.

    Null, empty and blank texts hold none and stay, as do all rows of an empty benchmark; repeated rows stay or go together.
    Other columns are kept, whatever their names.
    """
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document, and words of it, the mix takes.

    Null and empty texts have no words; a null source is a source of its own, the last; repeated rows are documents of their own; an
    empty table gives no rows. Other columns are dropped.
    """
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_near),
    ("repeats", cut_repeats),
    ("leaks", drop_leaks),
    ("mix", mix_sources),
]

#: SQL can express neither the classifier nor the edit-distance search; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage stores and shuffles for itself is deleted once its result is written."""
    visible(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        at = storage.place(spark, f"pipeline-{name}")
        with storage.released(spark), storage.unshuffled(spark):
            stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
