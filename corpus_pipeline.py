"""A corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import bpe, mixing, ngram_join, quality_rules, weak_labels
from dimweave.llm.common import small, table, work_folder, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither of low quality nor toxic."""
    labels = table(spark, sf_dir, "labels")
    model = weak_labels.fit_model(docs.select("doc_id", "text"), labels, work_folder(spark, "classifier"))
    names = [f"_{i}" for i in range(len(docs.columns))]
    scored = weak_labels.score(docs.toDF(*names), model, text=names[docs.columns.index("text")])
    return scored.where("kept").select(*names).toDF(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many documents of their source share."""
    return quality_rules.clean(docs, work_folder(spark, "rules"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest doc_id.

    Where doc_id is null or repeated, rows are numbered and the first of a group stays.
    """
    folder = work_folder(spark, "near")
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    names = [f"_{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    rows, key = docs.toDF(*names), at["doc_id"]
    if facts["n"] != facts["ids"]:
        key = "_row"
        rows = written(rows.withColumn(key, F.monotonically_increasing_id()), f"{folder}/rows")
    found = ngram_join.near_duplicates(rows.select(F.col(key).alias("doc_id"), F.col(at["text"]).alias("text")), folder)
    others = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias(key)), f"{folder}/others")
    return rows.join(small(others), key, "left_anti").select(*names).toDF(*docs.columns)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat(docs, work_folder(spark, "mix"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what was kept.

    Workers stay for later stages with what they hold, so there are no more of them than tasks at once, and each
    remembers a quarter of the usual pre-tokens.
    """
    return bpe.encoded_documents(docs, bpe.MEMO // 4, work_folder(spark, "encoded"))


def lean(stage: Stage) -> Stage:
    """A stage whose Arrow batches hold 4 MB: stages follow each other in the same executors, whose memory
    would else hold the largest batches of all of them."""

    def run_lean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
        return stage(spark, docs, sf_dir)

    return run_lean


STAGES = [
    ("quality_classifier", lean(quality_classifier)),
    ("quality_rules", lean(rules)),
    ("ngram_jaccard_join", lean(near_duplicates)),
    ("mixing_to_weights", lean(mixing_to_weights)),
    ("byte_level_bpe", lean(byte_level_bpe)),
]

#: SQL expresses neither the classifier nor the encoder; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents, each written and read again."""
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
