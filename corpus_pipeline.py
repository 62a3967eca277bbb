"""The corpus pipeline: documents to token files in five stages.

``STAGES``: (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.

1. toxicity: documents with a score of 0.5 or more go (null ids and texts are scored like others).
2. near duplicates (five words, similarity 0.8): one row of each group stays, one with the smallest doc_id.
   Rows of one doc_id are told apart by their texts (a 64-bit hash). Rows without doc_id stay.
3. benchmark decontamination: documents with 10 successive words of a benchmark item go, or with a whole
   item of 8 or 9 words. Shorter items (answers such as 'yes') reject nothing here; op9 reports them.
4. mixing: documents are repeated or left out so that the sources meet their targets.
5. token files: returns doc_id, start, n_tokens and ids_crc32 of each document written.

The decisions rest on trained weights and random rounding, which SQL doesn't express; ``tests/llm`` checks
the operators against plain computations, and near_duplicates and decontamination on planted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctuality.llm.common import discard, lean_workers, materialize, share_package, table
from punctuality.llm.decontaminate import contamination
from punctuality.llm.minhash import near_duplicate_groups
from punctuality.llm.mixing import mixed_documents
from punctuality.llm.tokens import round_trip
from punctuality.llm.toxicity import train_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean_workers(spark)  # the stages share their executors; this holds for those that follow
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.column(F.col("text")) < 0.5)


#: Fewest words of a benchmark item that rejects documents, and what op9 takes as a word.
LEAST_ITEM_WORDS = 8
_ITEM_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def _row():
    """What tells rows apart: a doc_id may stand for several texts, or be null."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.where("doc_id is not null").withColumn("__row", _row())
    groups = near_duplicate_groups(rows.select(F.col("__row").alias("doc_id"), "text"), width=5, percent=80)
    groups = groups.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")).distinct()
    least = rows.select("doc_id", "__row").join(groups, "__row").groupBy("__group").agg(F.min(F.struct("doc_id", "__row")).alias("__least"))
    stay = rows.join(least.select("__least.__row"), "__row", "left_semi")
    others = [c for c in docs.columns if c != "doc_id"]
    first = F.row_number().over(Window.partitionBy("doc_id", "__row").orderBy(*others))
    stay = stay.withColumn("__n", first).where("__n = 1").select(*docs.columns)
    return stay.unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").where(F.regexp_count("text", F.lit(_ITEM_WORD)) >= LEAST_ITEM_WORDS)
    rows = docs.withColumn("__row", _row())
    found = contamination(rows.select(F.col("__row").alias("doc_id"), "text"), items, n=10)
    bad = found.where("contaminated").select(F.col("doc_id").alias("__row")).distinct()
    return rows.join(bad, "__row", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_files", write_token_files),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    share_package(spark)
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if n:
            discard(before)  # no later stage reads it
    return docs
