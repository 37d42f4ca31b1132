"""Scans of the landed parquet tables.

Each reader names the columns it needs, so the parquet scan's ReadSchema is
pruned to them; filters applied afterwards reach the scan as PushedFilters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The landed table as a DataFrame, projected to ``cols``; the files are listed
    anew on every call, so those landed since are read."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
