"""The corpus pipeline: reject toxic documents, keep one of exact copies, one of
each group of near copies, drop documents with benchmark passages, pack the rest.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. The two dedup stages judge
rows, not ids: of equal or near equal rows one stays, also of those without a doc_id or
with the same one; an id's first row goes before rows without one and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from panelkit.llm.common import KEY, ROW, documents, row_keys, write_table
from panelkit.llm.queries import tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _keep(docs: DataFrame, judge) -> DataFrame:
    """The rows that ``judge`` does not find superfluous, each judged under a key of its own."""
    rows, _ = row_keys(docs)
    gone = judge(rows.select(KEY, F.col(f"{ROW}.text").alias("text")), id_col=KEY).filter("not kept").select(F.col("doc_id").alias(KEY))
    return rows.join(gone.hint("merge"), KEY, "left_anti").select(f"{ROW}.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _keep(docs, exact_dedup.exact_groups)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _keep(docs, near_dedup.near_duplicates)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_documents(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# iterative components, a trained model and a tokenizer have no SQL form: tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_table(docs, name)
    return docs
