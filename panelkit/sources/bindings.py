"""Bindings of panel concepts to the landed tables.

The library's operators take panel-shaped DataFrames; these functions derive
such frames from the landed TPC-H-like tables so that every query's work
grows with the data:

* channel dimension  <- ``customer``
* month              <- calendar month of ``o_orderdate``
* seed fact rows     <- ``orders`` with status F or P, one row per
                        (customer, month, status); F lands before P
* live leaderboard   <- ``orders`` with status O or P, one row per
                        (customer, month, status), ranked per (month, status)
* games              <- ``lineitem`` x ``orders`` x ``part``: brand = game
* users / created    <- first order date per customer
* scan pages, errors, cache writes <- ``events``

Every derived frame is one row per key after a partial (map-side combined)
aggregate, so hot customers are combined before any shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.ordering import written
from ..operators.ranks import bucketed_leaderboard
from .tables import table

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Binding parameters (fixed for the registered queries).
SEED_STATUSES = ("F", "P")
LIVE_STATUSES = ("O", "P")
NULL_PRIORITY = 5    # live rows whose orders all have this priority digit carry no metrics
URGENT_PRIORITY = 1  # seed "mature" flag: some order of this priority digit
PAGE_SIZE = 100               # leaderboard rows per landed page
GAMES_PAGE_SIZE = 10          # games rows per landed page
GAME_VALUES = ("hours", "peak_viewers", "avg_viewers", "view_minutes")
BOARD_STRIDE = 1 << 40        # page numbers of board P follow all that board O can have


def month_cols(d) -> list:
    """year, month, month_key, month_order of a month-start date column."""
    from ..operators.scaffold import month_columns
    return month_columns(d)


def _orders_by_month(spark: SparkSession, sf_dir: str, months=None) -> DataFrame:
    """Orders with their month start; with ``months`` (month-start dates) only
    those between the first and the last, as a range that reaches the scan."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice",
              "o_orderpriority", "o_orderdate")
    if months:
        after = (max(months).replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        day = o.schema["o_orderdate"].dataType
        o = o.where((F.col("o_orderdate") >= F.lit(min(months)).cast(day))
                    & (F.col("o_orderdate") < F.lit(after).cast(day)))
    return o.withColumn("ms", F.trunc(F.to_date("o_orderdate"), "month"))


def _status_month_agg(o: DataFrame) -> DataFrame:
    """One row per (customer, month, status): count, exact sum, max, ..."""
    o = o.withColumn("pri", F.substring("o_orderpriority", 1, 1).try_cast("int"))
    return o.groupBy("o_custkey", "ms", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        S.sum_2dp("o_totalprice").alias("s"),
        F.max("o_totalprice").alias("mx"),
        F.min("o_orderdate").alias("first_dt"),
        F.min("pri").alias("pri_min"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel dimension: one row per channel (customer keys are unique)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return c.select(
        F.col("c_custkey").alias("channel_id"),
        S.slug_norm("c_name").alias("channel_name"),
        F.coalesce(F.col("c_name"), F.lit("")).alias("display_name"),
    )


def status_rows(spark: SparkSession, sf_dir: str, months=None) -> DataFrame:
    """Orders reduced to one row per (customer, month, status) with the row's
    place on its (month, status) leaderboard. Seed (F, P) and live (O, P)
    rows are both projections of this one scan and aggregate."""
    a = _status_month_agg(_orders_by_month(spark, sf_dir, months))
    return bucketed_leaderboard(a, "s", ["ms", "o_orderstatus"], "o_custkey", "board_rank")


def month_bounds(spark: SparkSession, sf_dir: str) -> tuple:
    """(first, last) month-start dates as Columns of one scalar subquery (no join, no
    collect), a single scan of the order dates."""
    both = _orders_by_month(spark, sf_dir).select(F.struct(F.min("ms").alias("lo"), F.max("ms").alias("hi"))).scalar()
    return both["lo"], both["hi"]


def month_span(spark: SparkSession, sf_dir: str):
    """All month starts from the first to the last order month, as the array of one scalar subquery."""
    from ..operators.scaffold import month_sequence
    return _orders_by_month(spark, sf_dir).select(month_sequence(F.min("ms"), F.max("ms"))).scalar()


def _seed_fields() -> list:
    is_p = F.col("o_orderstatus") == "P"
    return [
        F.when(is_p, 1).otherwise(0).cast("bigint").alias("row_seq"),
        (F.col("board_rank") - F.when(is_p, 1).otherwise(0)).cast("bigint").alias("rank_position"),
        (F.col("s") / F.col("n")).alias("average_viewers"),
        F.col("s").alias("hours_watched"),
        F.lit(None).cast("double").alias("hours_streamed"),
        F.floor(S.cents("s") / 100000).cast("bigint").alias("followers"),
        F.col("n").cast("bigint").alias("followers_gained"),
        F.floor("mx").cast("bigint").alias("peak_viewers"),
        F.concat(F.lit("p"), F.col("pri_min").cast("string")).alias("language"),
        (F.col("pri_min") == URGENT_PRIORITY).alias("mature"),
        F.when(~is_p, F.date_format("first_dt", ISO_FMT)).alias("created"),
    ]


def _live_fields() -> list:
    has = F.col("pri_min") != NULL_PRIORITY
    board = F.when(F.col("o_orderstatus") == "O", 0).otherwise(BOARD_STRIDE)
    return [
        (board + F.floor((F.col("board_rank") - 1) / PAGE_SIZE)).cast("bigint").alias("page_seq"),
        F.col("board_rank").alias("row_pos"),
        F.col("board_rank").alias("rank"),
        F.when(has, F.col("s") / F.col("n")).alias("average_viewers"),
        F.when(has, F.col("s") / 60.0).alias("hours_watched"),
        F.when(has, F.col("n").cast("double") * 100.0).alias("hours_streamed"),
        F.lit(None).cast("bigint").alias("followers"),
        F.lit(None).cast("bigint").alias("followers_gained"),
        F.when(has, F.floor("mx").cast("bigint")).alias("peak_viewers"),
        F.when(has, F.concat(F.lit("p"), F.col("pri_min").cast("string"))).alias("language"),
        F.lit(None).cast("string").alias("display_name"),
        F.lit(None).cast("string").alias("channel_slug"),
    ]


def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed fact table as landed: possibly several rows per (channel, month).

    ``row_seq`` is the landing order of rows sharing a key (F before P).
    """
    a = status_rows(spark, sf_dir).where(F.col("o_orderstatus").isin(*SEED_STATUSES))
    return a.select(F.col("o_custkey").alias("channel_id"), *month_cols(F.col("ms")), *_seed_fields())


def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live leaderboard rows: (channel_id, month_key, page_seq, row_pos, rank, metrics...).

    Two leaderboards per month (status O, then P); pages of ``PAGE_SIZE``.
    Rows whose orders are all ``NULL_PRIORITY`` carry a rank but no metrics.
    """
    a = status_rows(spark, sf_dir).where(F.col("o_orderstatus").isin(*LIVE_STATUSES))
    return a.select(F.col("o_custkey").alias("channel_id"), *month_cols(F.col("ms")), *_live_fields())


def tagged_sources(spark: SparkSession, sf_dir: str, months=None, partitions: int | None = None) -> DataFrame:
    """Seed and live rows in one frame, tagged, for a single keyed aggregate:
    (channel_id, month_key, is_seed, is_live, seed_row, live_row).

    With ``partitions`` the rows lie by channel, over that many tasks: a channel has a row per month and status at
    most. They are dealt out as they are read, before the wider structs are made of them."""
    a = status_rows(spark, sf_dir, months)
    if partitions:
        a = a.repartition(partitions, "o_custkey")
    st = F.col("o_orderstatus")
    return a.select(
        F.col("o_custkey").alias("channel_id"), S.month_key_of_month_start(F.col("ms")).alias("month_key"),
        st.isin(*SEED_STATUSES).alias("is_seed"), st.isin(*LIVE_STATUSES).alias("is_live"),
        F.struct(*_seed_fields()).alias("seed_row"), F.struct(*_live_fields()).alias("live_row"),
    )


def games_order():
    """Source-table order of the games rows: by view minutes desc, then name."""
    return F.struct((-F.col("view_minutes")).alias("v"), F.col("game").alias("g"))


def games_rows(spark: SparkSession, sf_dir: str, with_pos: bool = True, partitions: int | None = None,
               values: tuple[str, ...] = GAME_VALUES) -> DataFrame:
    """Per (channel, month, game) rows with the position of the game in its table.

    hours = sum of quantities, avg_viewers = mean extended price,
    peak_viewers = floor(max price), view_minutes = sum of prices.
    With ``partitions`` the rows lie by channel, over that many tasks: a channel has a row per month and game at most. They
    are written first, so that the shuffles of the lines are gone from the disk before the panel is made; what is written
    cannot be pruned later, so ``values`` names those that are read (without a position).
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    # parts first: a line then goes on with its brand, and meets the wider order where it is reduced
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(o, li.l_orderkey == o.o_orderkey)
           .withColumn("ms", F.trunc(F.to_date("o_orderdate"), "month")))
    g = j.groupBy("o_custkey", "ms", "p_brand").agg(
        S.sum_2dp("l_quantity").alias("hours"),
        F.floor(F.max("l_extendedprice")).cast("bigint").alias("peak_viewers"),
        (S.sum_2dp("l_extendedprice") / F.count(F.lit(1))).alias("avg_viewers"),
        S.sum_2dp("l_extendedprice").alias("view_minutes"),
    )
    if partitions:
        g = written(g.select("o_custkey", "ms", "p_brand", *values), "games").repartition(partitions, "o_custkey")
    g = g.select(F.col("o_custkey").alias("channel_id"), *month_cols(F.col("ms")),
                 F.col("p_brand").alias("game"), *values)
    if not with_pos:
        return g
    # partitioned on the (channel_id, month_key) that consumers group by
    pos_w = Window.partitionBy("channel_id", "month_key").orderBy(F.col("view_minutes").desc(), "game")
    return g.select("channel_id", "year", "month", "month_key", "month_order",
                    F.row_number().over(pos_w).cast("bigint").alias("pos"),
                    "game", "hours", "peak_viewers", "avg_viewers", "view_minutes")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account lookup result: (login, created_at) with login lower-cased."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    first = (table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
             .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_dt")))
    return c.join(first, c.c_custkey == first.o_custkey).select(
        F.lower(F.col("c_name")).alias("login"),
        F.date_format("first_dt", ISO_FMT).alias("created_at"),
    )


def events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    e = table(spark, sf_dir, "events", *cols) if cols else table(spark, sf_dir, "events")
    if "ts" in e.columns:
        e = e.withColumn("ts", F.col("ts").cast("timestamp"))
    return e
