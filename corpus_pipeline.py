"""A corpus pipeline: each stage applies one operator to all that its predecessor kept.

Null ids or texts pass every stage but packing, which takes a null text as empty.  Of the
rows of one id the near-duplicate stage keeps the one of the least text, whatever their
texts.  All columns but text (and n_chars, which follows it) come back bit for bit, also
those named like what an operator returns.  An empty table gives none.  The tests hold
each stage against brute force over a whole small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedstore.llm.common import stored, table

#: SQL cannot express the stages.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored toxic."""
    from keyedstore.llm.toxicity import clean

    return clean(docs, table(spark, sf_dir, "labels"))


def one_row_each(docs: DataFrame) -> DataFrame:
    """One row of each repeated doc_id: that of the least text, null last.  Null ids all pass."""
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if not repeated.take(1):
        return docs
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = F.min(F.struct(F.col("text").isNull().alias("blank"), "text", *rest)).alias("x")
    one = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(least).select("doc_id", "x.*").select(*docs.columns)
    return stored(docs.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(one), "single")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the smallest id, in one row."""
    from keyedstore.llm.near_dedup import near_duplicates

    docs = one_row_each(docs)
    gone = near_duplicates(docs, width=5, percent=80).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    from keyedstore.llm.decontaminate import clean

    return clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    from keyedstore.llm.pii import redact

    out = redact(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text"))) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    import public_tokenizers

    from keyedstore.llm.packing import byte_bpe, pack

    path = public_tokenizers.path
    return pack(docs, byte_bpe(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), 0))


STAGES = [
    ("toxicity", toxicity),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
