"""Month spine, channel dimension and the gap-free panel scaffold."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def month_columns(d: Column) -> list[Column]:
    """year, month name, month_key, month number of a date, from a literal
    name array (no per-row date formatting)."""
    name = S.month_name_from_number(F.month(d))
    return [
        F.year(d).cast("bigint").alias("year"),
        name.alias("month"),
        F.concat(F.year(d).cast("string"), name).alias("month_key"),
        F.month(d).cast("bigint").alias("month_order"),
    ]


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month-start dates from ``first`` to ``last`` (inclusive)."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))


def month_list(years: list[int], months: list[str]) -> list[_dt.date]:
    """Years x month names -> de-duplicated month-start dates, chronological.

    Unknown month names raise, as a scope argument must be valid.
    """
    out = set()
    for y in years:
        for m in months:
            name = str(m).strip().lower()
            if name not in S.MONTH_NAMES:
                raise KeyError(f"unknown month name: {m!r}")
            out.add(_dt.date(int(y), S.MONTH_NAMES.index(name) + 1, 1))
    return sorted(out)


def month_spine(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """One row per month between two month-start dates (scalar Columns)."""
    return (spark.range(1)
            .select(F.explode(month_sequence(first, last)).alias("month_start"))
            .select("month_start", *month_columns(F.col("month_start"))))


def month_spine_from_list(spark: SparkSession, months: list[_dt.date]) -> DataFrame:
    arr = F.array(*[F.lit(m) for m in months])
    return (spark.range(1).select(F.explode(arr).alias("month_start"))
            .select("month_start", *month_columns(F.col("month_start"))))


def first_per_channel(rows: DataFrame, order_cols: list, key: str = "channel_id") -> DataFrame:
    """First row per channel under an explicit total order (dimension dedupe).

    ``row_number() = 1`` is planned with a WindowGroupLimit, so each task keeps
    only its best row per key before the window's shuffle.
    """
    w = Window.partitionBy(key).orderBy(*order_cols)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def panel_scaffold(channels: DataFrame, months: Column | list[_dt.date],
                   partitions: int | None = None) -> DataFrame:
    """Every channel x every month, generated per channel row.

    ``months`` is either an array Column of month-start dates (e.g. from
    :func:`month_sequence` over scalar subqueries) or an explicit list. The
    month list is a bounded calendar span, so the scaffold is produced by a
    narrow ``explode`` on the channel side: no join, no shuffle, output linear
    in channels x months.

    The explode multiplies rows by the number of months, so with
    ``partitions`` the (much smaller) channel table is first spread by
    channel_id over that many tasks: each task then generates a bounded slice
    of the scaffold, whatever the input file layout.
    """
    if isinstance(months, list):
        months = F.array(*[F.lit(m) for m in months])
    if partitions:
        channels = channels.repartition(partitions, "channel_id")
    return (channels.select("*", F.explode(months).alias("month_start"))
            .select(*channels.columns, *month_columns(F.col("month_start"))))


def attach_months(channels: DataFrame, keyed: DataFrame, name: str) -> DataFrame:
    """``channels`` with their rows of ``keyed``, one per (channel_id, month_key), as a map ``name`` from month key to row:
    the join of a scaffold with ``keyed``, done before the scaffold is made. A row per channel meets a row per channel, so no
    row of the scaffold is shuffled or sorted; :func:`at_month` picks the month's row. A map has as many entries as the
    calendar has months at most. Where both sides lie by ``channel_id`` already, nothing is shuffled here."""
    row = F.struct(*[F.col(c) for c in keyed.columns if c not in ("channel_id", "month_key")])
    per = (keyed.where(F.col("channel_id").isNotNull() & F.col("month_key").isNotNull()).groupBy("channel_id")
           .agg(F.map_from_entries(F.collect_list(F.struct("month_key", row.alias("row")))).alias(name)))
    return channels.join(per.hint("merge"), "channel_id", "left")


def at_month(scaffold: DataFrame, name: str) -> DataFrame:
    """A scaffold whose map ``name`` (:func:`attach_months`) gives way to the row of its month, null without one."""
    return scaffold.withColumn(name, F.try_element_at(F.col(name), F.col("month_key")))


def scaffold_except(channels: DataFrame, months: Column | list[_dt.date], found: DataFrame) -> DataFrame:
    """(channel_id, month_key) of the scaffold without those in ``found``, each taken away once:
    ``scaffold EXCEPT ALL SELECT DISTINCT found``, a null channel being one like any other.

    Channels and found keys meet as one row per channel, with its number of rows and its found months (as many
    as the calendar has), and the scaffold is made from these rows: none of its rows is shuffled or kept."""
    rows = channels.select("channel_id", F.lit(1).alias("_rows"), F.lit(None).cast("string").alias("_month")).unionByName(
        found.select("channel_id", F.lit(0).alias("_rows"), F.col("month_key").alias("_month")))
    per = rows.groupBy("channel_id").agg(F.sum("_rows").alias("_rows"), F.collect_set("_month").alias("_found")).where("_rows > 0")
    scaffold = panel_scaffold(per, months)
    left = F.col("_rows") - F.array_contains("_found", F.col("month_key")).cast("int")
    once = scaffold.select("channel_id", "month_key", left.alias("_left")).where("_left > 0")
    many = F.sequence(F.lit(1), "_left")
    return once.select("channel_id", "month_key", F.explode(many).alias("_i")).drop("_i")


def channel_month_domain(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct channels and distinct months of a frame."""
    return (panel.select("channel_id").distinct(),
            panel.select("year", "month", "month_key", "month_order").distinct())
