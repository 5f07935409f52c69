"""A training corpus from the documents table: classify, remove near copies, cut shared passages, mix, pack.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the columns of
documents. Decisions are about rows: rows that differ in any column are told apart whether or not they have a doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import mixing, packing, quality_classifier, simhash, substring_dedup
from tallywright.llm.common import stored, table
from tallywright.llm.queries import domain

#: Passages of so many words that a document with a smaller doc_id has too are cut.
PASSAGE_WORDS = 50
#: Share of all tokens that the mixture takes; sources have equal weights, so the largest one gives up most of the rest.
BUDGET = 0.9
SEQUENCE = 2048
#: SQL states none of: a hashed n-gram classifier with its noise, SimHash groups, a BPE. The tests hold a brute-force version.
ORACLE_SQL = None


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column of 128 bits, whose name is returned too: equal for rows that are equal in all columns."""
    mark = fresh(docs, "row_mark")
    return docs.withColumn(mark, F.md5(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary"))), mark


def only(docs: DataFrame, mark: str, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose mark is one of ``kept``'s."""
    return docs.join(kept.select(mark).distinct(), mark, "left_semi")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    rows, mark = marked(docs)
    judged = quality_classifier.classify(rows, table(spark, sf_dir, "labels"), seed=8, carry=mark)
    return only(rows, mark, judged.where("kept")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group that SimHash links connect; one row of a group without doc_ids.

    Of several rows with that doc_id in a group one stays, the one of the least mark.
    """
    rows, mark = marked(docs)
    near = simhash.groups(rows, words=4, bits=4, carry=mark)
    kept = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "carried")).alias("first")).select(F.col("first.carried").alias(mark))
    return only(rows, mark, kept).dropDuplicates([mark]).select(docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document before them has too; n_chars follows the text."""
    cut_id, cut_text, cut_mark = fresh(docs, "cut_id"), fresh(docs, "cut_text"), fresh(docs, "cut_mark")
    cut = substring_dedup.dedup(docs, window=PASSAGE_WORDS, spacing=True).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias(cut_id), F.col("text").alias(cut_text), F.col("mark").alias(cut_mark)).dropDuplicates([cut_id, cut_mark])
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))  # rows of one doc_id may differ
    out = docs.join(cut, F.col("doc_id").eqNullSafe(F.col(cut_id)) & (mark == F.col(cut_mark)), "left")
    changed = F.col(cut_text).isNotNull()
    new = {
        "text": F.when(changed, F.col(cut_text)).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.char_length(cut_text).cast("long")).otherwise(F.col("n_chars")),
    }
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of one epoch's mixture; a leaf's last document stays whole. Rows equal in all columns stay or go together."""
    rows, mark = marked(docs)
    taken = mixing.mix(rows.withColumn("domain", domain(F.col("source"))), {}, budget=BUDGET, max_epochs=1, seed=2, carry=mark)
    return only(rows, mark, taken).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    return packing.pack(docs, capacity=SEQUENCE, added=packing.added_tokens())


STAGES = [("quality classifier", classify), ("near-duplicates", drop_near_copies), ("shared passages", cut_passages), ("mixture", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
