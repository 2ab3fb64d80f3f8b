"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``; ``n_chars`` follows the text.

1. language_id: learns from the rows whose doc_id isn't held out, drops documents
   whose prediction is rejected (no letter, or a score below the calibrated limit).
2. line_dedup: removes lines that repeat, exactly or nearly, over all documents;
   a document stays even if no line is left.
3. minhash: of each group of near-duplicate documents (five-word shingles, 0.8)
   the smallest doc_id stays; of rows that repeat doc_id and text one stays, rows
   that repeat a doc_id with another text are judged by their text.  Empty documents
   and those without a doc_id link with nothing and all stay.
4. pii: replaces personal data by its kind.
5. packing: packs all texts into sequences of at most 4096 tokens.

Null and empty texts, nulls in any column, repeated rows and empty tables pass as
the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinefold.llm import langid, line_dedup, minhash, packing, pii
from kinefold.llm.common import publish, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SIMILARITY = 80
SHINGLE_WORDS = 5


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = langid.fit(langid.learnable(docs))
    return langid.predict(docs, model).where("not rejected").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS), SIMILARITY, cut=line_dedup.every_shingle))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = minhash.grouped_documents(docs, words=SHINGLE_WORDS, percent=SIMILARITY)
    gone = publish(found.where("not leads").select(F.col("doc_id").alias("gone"), F.col("body").alias("gone_body")).distinct(), "pipeline-gone")
    again = publish(found.where("leads and doc_id is not null").groupBy(F.col("doc_id").alias("again"), F.col("body").alias("again_body")).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "pipeline-again")
    rows = docs.withColumn("body", F.xxhash64("text"))
    left = rows.join(_few(gone), (F.col("doc_id") == F.col("gone")) & (F.col("body") == F.col("gone_body")), "left_anti")
    # of rows that repeat doc_id and text one stays
    same = (F.col("doc_id") == F.col("again")) & (F.col("body") == F.col("again_body"))
    once = left.join(_few(again), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(_few(again), same, "left_anti").unionByName(once).select(*COLUMNS)


def _few(keys: DataFrame) -> DataFrame:
    """Pairs of numbers go to all tasks if they are few, else a shuffled join does the same."""
    return F.broadcast(keys) if keys.count() <= minhash.BROADCAST_ROWS else keys.hint("shuffle_hash")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return _documents(pii.redact(docs, pii.fit(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("minhash", minhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the trained stages nor best fit.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = publish(docs, f"pipeline-{name}")
    return docs
