"""The corpus pipeline: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Stages
name a row by a 64-bit hash of id and text, so that rows without an id are judged like others and an id that stands for
several texts stays several documents. Empty texts are clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xoutcome.llm import bpe, decontaminate, minhash, suffixdedup, toxicity
from xoutcome.llm.common import table, without_ids
from xoutcome.session import stored

ROW = "_row"
PASSAGE_WORDS = 51
PASSAGE_BYTES = 2 * PASSAGE_WORDS - 1  # so many words of one byte each with a space between
BLOCK_BYTES = 2 << 20  # of text in a block of the last stage, whose workers are the largest


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of toxic passages, learned from the labels of folds 1 to 4, does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def _named(docs: DataFrame) -> DataFrame:
    """The rows with a key of id and text; only repeated rows share one."""
    return docs.withColumn(ROW, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: of the least id, null last; of a row that is there repeatedly, any.

    Texts without words are in no class: only rows that repeat an id go.
    """
    rows = _named(docs)
    classes = minhash.near_duplicates(rows, ROW).groupBy(F.col("doc_id").alias(ROW)).agg(
        F.min("component_id").alias("component"), F.max("n_shingles").alias("size"), F.count(F.lit(1)).alias("times"))
    ids = rows.select(ROW, "doc_id").groupBy(ROW).agg(F.min("doc_id").alias("id"))
    classes = stored(classes.join(ids, ROW), "classes")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col(ROW).alias("row")))
    stay = stored(classes.groupBy("component").agg(least.alias("least")).select(F.col("least.row").alias(ROW)), "stay")
    gone = classes.select(ROW).join(stay, ROW, "left_anti")
    again = stored(classes.where("times > 1 and (size > 0 or id is not null)").select(ROW).join(stay, ROW, "left_semi"), "repeated")
    kept = without_ids(rows, stored(gone.union(again), "duplicates"), ROW)
    if not again.isEmpty():
        kept = kept.union(rows.join(again, ROW, "left_semi").dropDuplicates([ROW]).select(kept.columns))
    return kept.drop(ROW)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents less the passages of more than 50 words that stand elsewhere too.

    No such passage has less than ``PASSAGE_BYTES`` bytes, and all strings of that length are compared.
    """
    return suffixdedup.rewritten(_named(docs), ROW, least_words=PASSAGE_WORDS, length=PASSAGE_BYTES, gram=PASSAGE_BYTES // 4).drop(ROW)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = _named(docs)
    gone = stored(decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), ROW).where("contaminated").select("doc_id"), "contaminated")
    return without_ids(rows, gone, ROW).drop(ROW)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids, and digests of ids and decoded text."""
    return bpe.digests(docs, block_bytes=BLOCK_BYTES)


STAGES = [("toxicity", reject_toxic), ("near_dedup", one_of_each_class), ("suffix_dedup", cut_repeats),
          ("decontaminate", without_benchmark), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
