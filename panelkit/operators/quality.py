"""Panel checks: all in one aggregate pass returning one row; a wrapper raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

PANEL_KEY = ["channel_id", "year", "month"]


def ranked_missing_metrics(panel: DataFrame) -> DataFrame:
    """Rows with a rank but none of the six metrics."""
    return panel.where(F.col("rank").isNotNull() & S.all_null(*S.METRIC_FIELDS))


def validate_panel(panel: DataFrame, expected_rows: Column | int | None = None) -> DataFrame:
    """rows vs expected (channels x months), duplicate keys, ranks <= 0 and
    ranked rows lacking every metric (with % of ranked rows).

    Duplicates come from a key aggregate folded into a scalar subquery, so the
    panel is never collected; the result is a single row.
    """
    dups = (panel.groupBy(*PANEL_KEY).agg(F.count(F.lit(1)).alias("_n"))
                 .select(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)))).scalar()
    exp = F.lit(expected_rows) if isinstance(expected_rows, int) else expected_rows
    ranked = F.count("rank")
    rmm = F.count_if(F.col("rank").isNotNull() & S.all_null(*S.METRIC_FIELDS))
    out = panel.agg(
        F.count(F.lit(1)).alias("rows"),
        ranked.alias("ranked_rows"),
        F.count_if(F.col("rank") <= 0).alias("bad_ranks"),
        rmm.alias("ranked_missing_metrics"),
        (rmm * 100.0 / F.greatest(F.lit(1), ranked)).alias("ranked_missing_pct"),
    ).withColumn("duplicate_keys", dups.cast("bigint"))
    if exp is not None:
        out = out.withColumn("expected_rows", exp.cast("bigint"))
    return out


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """``df`` itself; raises when it holds no row (reads at most one)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def assert_valid(report: DataFrame) -> dict:
    """Raise on the three hard failures; the fourth (ranked rows without
    metrics) is returned for logging only. Collects the single report row."""
    r = report.first().asDict()
    if r.get("expected_rows") is not None and r["rows"] != r["expected_rows"]:
        raise ValueError(f"panel holds {r['rows']} rows where channels x months give {r['expected_rows']}")
    if r["duplicate_keys"]:
        raise ValueError(f"{r['duplicate_keys']} panel keys occur more than once")
    if r["bad_ranks"]:
        raise ValueError(f"{r['bad_ranks']} rows carry a rank below 1")
    return r
