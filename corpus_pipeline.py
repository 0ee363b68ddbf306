"""A corpus pipeline of the operators in ``loanloom.llm``.

Each stage works on all that the one before it kept; its result is written and
read again as the next one's documents. All stages but the last return the
columns of ``documents``, with ``text`` as the stage left it and ``n_chars`` as
its length; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import decontaminate, minhash, packing, quality, suffix_dedup
from loanloom.llm.queries import BYTE_BPE, table
from loanloom.llm.scratch import Scratch
from loanloom.llm.ship import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
END_ID = 1
#: Smaller than by default: other stages leave less memory to a worker.
KEPT_PIECES = 150_000
#: A document with a larger share of benchmark words goes as a whole.
MOST_HIT = 0.5


def _with_text(rows: DataFrame, text: str) -> DataFrame:
    return rows.withColumns({"text": F.col(text), "n_chars": F.length(text).cast("long")}).select(COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. A null or empty text has no words and goes; a row
    without id is judged as any other; repeated rows stay or go together."""
    judged = quality.judge(docs, table(prepare(spark), sf_dir, "labels"), keep=COLUMNS[1:])
    return judged.where("kept").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, the one with the smallest id
    (rows without an id come last). Rows are numbered first, so that equal rows,
    texts under one id, and rows without an id are documents of their own. A text
    without words is linked with nothing and stays."""
    scratch = Scratch(prepare(spark), "numbered")
    numbered = scratch.store(docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = minhash.near_duplicates(numbered.select(F.col("row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    named = found.join(numbered.select("row", "doc_id"), "row")
    kept = named.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return numbered.join(kept, "row", "left_semi").select(COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; so do documents of which nothing is left. A null text
    is empty and stays so; rows of equal id and text are one document, whose
    passages do not repeat each other; rows without an id come last."""
    prepare(spark)
    cleaned = suffix_dedup.remove_repeats(docs, keep=["lang", "source", "n_chars"])
    cleaned = cleaned.where(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]") | (F.col("n_removed") == 0))
    return _with_text(cleaned, "kept_text")


def decontaminate_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go. A
    null or empty text has no words and stays; each row is judged by itself."""
    items = table(prepare(spark), sf_dir, "benchmark")
    found = decontaminate.find_test_items(docs, items, keep=["lang", "source", "n_chars"])
    found = found.where(F.col("n_hit") <= F.lit(MOST_HIT) * F.col("n_words"))
    return _with_text(found, "clean_text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences. A null or empty text is its end token;
    rows of equal id, or without one, are packed each."""
    prepare(spark)
    return packing.pack(docs, BYTE_BPE, END_ID, kept_pieces=KEPT_PIECES)


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("remove_repeats", remove_repeats),
    ("decontaminate", decontaminate_texts),
    ("pack", pack),
]

#: Models and hashes cannot be written in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.store(docs, name)
        if k:
            scratch.drop(*[n for n, _ in STAGES[: k - 1]])
    return docs
