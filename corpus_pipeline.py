"""From raw documents to packed sequences: quality rules, line dedup, near-duplicates, decontamination, packing.

Each stage takes what the one before it kept, written as Parquet and read again, and its decisions take effect on the
rows that it returns. All but the last return the columns of ``documents``, and any others that the table has, whatever their
names.

Null and empty texts, and texts under 50 words, go in the first stage; given to a later one, they stay as they are until the
packing, where each is its end id alone. Rows without a doc_id stay, and count each for itself; of rows that repeat a doc_id
the near-duplicate stage keeps one. Equal rows are judged alike. An empty table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import decontaminate, lines, minhash, packing, quality
from tripwright.llm.tokenizer_files import BYTE_LEVEL
from tripwright.session import materialize

END_ID = 1  # behind each document in the sequences


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose lines that too many documents of their host share. Copies are left to the
    stages behind, which keep one of them."""
    return _measured(quality.clean_documents(docs, spare_copies=True))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines the first stays; a document left without a word goes. Null and empty texts stay as they are."""
    return _measured(lines.remove_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least id; documents without words all stay."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; null and empty texts have none."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids; every row is in some sequence, a null text by its end id."""
    return packing.pack(docs, BYTE_LEVEL, END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL cannot express near-equal lines and packing; tests/llm/test_pipeline.py checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
