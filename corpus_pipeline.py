"""A corpus from raw documents to packed sequences, in stages that are each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import factor_machine, lsh_forest, pattern_packing, source_schedule, suffix_dedup
from casebook.llm.common import table
from casebook.sources.work import Work

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit; the model is fitted on labelled documents of this stage's input."""
    model = factor_machine.fit_on(docs, table(spark, sf_dir, "labels"))
    return factor_machine.with_scores(docs, model, COLUMNS, score_col="_score").where(F.col("_score") < factor_machine.TOXIC).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares most five-word shingles, the one with the least id.

    Documents without words are no duplicates of each other and stay, as do rows with a null id. Of rows that repeat both
    id and text one is kept; of an id with several texts each is judged by itself.
    """
    found = lsh_forest.linked(docs, width=5, per_cent=80, text_hash=True)
    marks = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count("*").alias("_n"), F.bool_and("kept").alias("_kept"))
    marks = Work(spark).keep(marks.where("_id is not null and (_n > 1 or not _kept)"), "marks")
    rows = docs.select(*COLUMNS)
    own = (F.col("doc_id") == F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
    alone = rows.join(marks, own, "left_anti")
    again = rows.join(marks.where("_kept"), own, "left_semi")
    others = F.min(F.struct("lang", "source", "n_chars")).alias("_other")
    once = again.groupBy("doc_id", "text").agg(others).select("doc_id", "text", "_other.*")
    return alone.unionByName(once.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that an earlier document has too. A character that is cut apart goes wholly;
    documents of which nothing but white space is left go, empty ones stay."""
    left = suffix_dedup.without_repeats(docs, columns=COLUMNS)
    cut = F.expr("try_validate_utf8(cast(kept as string))")
    whole = F.coalesce(cut, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", ""))
    text = F.when(F.col("n_removed") > 0, whole).otherwise(F.col("text"))
    rows = left.withColumn("_text", text).where((F.col("n_removed") == 0) | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select("doc_id", F.col("_text").alias("text"), "lang", "source", F.char_length("_text").cast("long").alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last pass of a source cut where its share ends."""
    return source_schedule.Mix(docs, keep=COLUMNS).documents().select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 4096 tokens."""
    import public_tokenizers

    return pattern_packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("packing", packing),
]

#: Neither fitted scores nor the packing can be written as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Work(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
