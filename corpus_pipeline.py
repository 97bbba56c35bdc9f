"""A training corpus out of ``documents``: five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimweave.llm import decontaminate, jaccard, packing, privacy, quality
from claimweave.llm.texts import bounded_batches, fresh, table
from claimweave.session import store_table, tune


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the field finds good; labels of all folds but the held-out one are learnt from.

    Null and empty texts are one empty line and scored as such, of any length whole; repeated rows are scored alike,
    rows without an id too. Without labels every score is 0.5, and all rows stay. All columns pass as they are.
    """
    model = quality.learned_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = fresh("score", docs.columns)
    return quality.score_quality(docs, model, score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def _name(docs: DataFrame) -> Column:
    """Names a document: its id with its text."""
    return F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")), docs["text"].isNull())


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five words, likeness 0.8).

    Rows that repeat an id with the same text are one document, of which the row with the least hash of all its
    columns stays; with different texts they are documents of their own. Empty and null texts are in no group and stay,
    and so does a row without an id.
    """
    named = docs.where("doc_id is not null")
    names = named.select(_name(named).alias("key"), "doc_id")
    groups = jaccard.near_groups(named.select(_name(named).alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    of_groups = groups.distinct().join(names.distinct(), "key").groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("x"))
    times = names.groupBy("key").agg((F.count("*") > 1).alias("again"))
    first = store_table(of_groups.select("x.key").join(times, "key"), "first")
    # Texts are dealt once; only documents that stand in several rows are dealt again.
    alone, again = first.where("not again"), first.where("again")
    once = named.join(alone, _name(named) == alone["key"], "left_semi")
    several = named.join(again, _name(named) == again["key"], "left_semi")
    least = several.groupBy(_name(several)).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("kept_row")).select("kept_row.*")
    return once.unionByName(least).unionByName(docs.where("doc_id is null"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none; all rows of a text that holds one go, with or without an id. An empty benchmark
    lets all rows stay.
    """
    bounded_batches(spark)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("row"))
    held = decontaminate.find_passages(keyed, table(spark, sf_dir, "benchmark")).select("row").distinct()
    return docs.join(held, F.xxhash64(docs["text"]) == held["row"], "left_anti")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are masked.

    Every row stays, repeated ones and those without an id too; null stays null. ``n_chars`` follows the text.
    """
    return privacy.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048.

    Null and empty texts are one end token; each row is packed for itself, repeated or without an id.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: The stages' models and random walks cannot be said in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store_table(docs, name)
    return docs
