"""Nested per-channel-month game breakdowns: features, lists, pies, write-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

KEY = ["channel_id", "month_key"]
GAME_COLUMNS = [
    "all_games", "games_by_stream_time", "games_by_avg_viewers", "top_game",
    "top_game_hours", "top_game_pct", "game_count", "is_variety_streamer",
]


LISTS = ("all_games", "games_by_stream_time", "games_by_avg_viewers")
CARRIED = "_games"  # the columns of :func:`games_agg` on a panel that carries them


def games_agg(games: DataFrame, with_lists: bool = True, order=None, lists: tuple[str, ...] = LISTS) -> DataFrame:
    """One row per (channel, month): totals, count, top game and the lists.

    ``games`` has (channel_id, month_key, game, hours, peak_viewers,
    avg_viewers, view_minutes) and the source-table order of each game:
    ``order`` is an ascending sortable Column (default ``pos``), so callers
    whose source order is a sort key need no position window.
    The top game is the first in source order among the most hours (a stable
    descending sort): the head of the by-time list, or ``min_by`` on
    (-hours, order) when no lists are wanted.
    The lists are collected per channel-month (bounded by the games one
    channel streams in one month) and sorted within the row. Of LISTS only those in
    ``lists`` are collected; the others are empty, which still says that they are there.
    """
    o = F.col("pos") if order is None else order
    h0 = F.coalesce(F.col("hours"), F.lit(0.0))
    a0 = F.coalesce(F.col("avg_viewers"), F.lit(0.0))
    aggs = [
        F.sum(h0.cast("decimal(38,6)")).cast("double").alias("total_hours"),
        F.count(F.lit(1)).alias("game_count"),
        S.round_dp(F.max(h0), 2).alias("top_game_hours"),
    ]
    by_list = with_lists and "games_by_stream_time" in lists
    if not by_list:
        aggs.append(F.min_by(F.col("game"), F.struct((-h0).alias("h"), o.alias("o"))).alias("top_game"))
    if with_lists:
        item = F.struct(
            F.col("game"),
            S.round_dp(h0, 2).alias("hours"),
            F.coalesce(F.col("peak_viewers"), F.lit(0)).cast("bigint").alias("peak_viewers"),
            a0.alias("avg_viewers"),
            F.coalesce(F.col("view_minutes"), F.lit(0.0)).alias("view_minutes"),
        )
        by_time = F.struct(F.col("game"), S.round_dp(h0, 2).alias("hours"))
        by_avg = F.struct(F.col("game"), a0.alias("avg_viewers"))
        # each list is collected with its sort key in front, sorted with the
        # code-generated sort_array and unwrapped by field access (no lambdas)
        collected = {
            "all_games": F.struct(o.alias("k"), item.alias("v")),
            "games_by_stream_time": F.struct((-h0).alias("k"), o.alias("o"), by_time.alias("v")),
            "games_by_avg_viewers": F.struct((-a0).alias("k"), o.alias("o"), by_avg.alias("v")),
        }
        aggs += [F.collect_list(v if c in lists else F.when(F.lit(False), v)).alias(f"_{c}") for c, v in collected.items()]
    a = games.groupBy(*KEY).agg(*aggs)
    if with_lists:
        # the top game is the head of the by-time list (most hours, then source
        # order), so the aggregate holds only list buffers and runs hash-based
        by_time_sorted = F.sort_array("_games_by_stream_time")
        a = a.select(
            *[c for c in a.columns if not c.startswith("_")],
            *([by_time_sorted[0]["v"]["game"].alias("top_game")] if by_list else []),
            *[F.sort_array(f"_{c}")["v"].alias(c) for c in LISTS],
        )
    return a


def enrich_games(panel: DataFrame, agg: DataFrame | None, overwrite: bool = False) -> DataFrame:
    """Write game features onto the panel by (channel, month).

    Denominator for the top share: the row's hours_streamed when > 0, else
    the total game hours. Without ``overwrite`` only null/blank cells are
    filled; rows without a games result keep their values. The join is a sorted merge, as in
    :func:`merge.merge_sources`: a reader of the game lists alone makes it an inner join onto the scaffold.
    Without ``agg`` the panel's rows carry its columns already, as the struct CARRIED
    (:func:`scaffold.attach_months`), and nothing is joined.
    """
    if agg is not None:
        j = panel.join(agg.select(*KEY, *[F.col(c).alias(f"_n_{c}") for c in agg.columns if c not in KEY]).hint("merge"),
                       KEY, "left")
    else:
        j = panel.select(*KEY, *[c for c in panel.columns if c not in (*KEY, CARRIED)],
                         *[F.col(f"{CARRIED}.{c}").alias(f"_n_{c}") for c in panel.schema[CARRIED].dataType.fieldNames()])
    hs = F.col("hours_streamed")
    den = F.when(hs > 0, hs).otherwise(F.col("_n_total_hours"))
    pct = F.when(F.col("_n_game_count").isNotNull(), S.guarded_pct(F.col("_n_top_game_hours"), den))
    new = {
        "top_game": F.col("_n_top_game"),
        "top_game_hours": F.col("_n_top_game_hours"),
        "top_game_pct": pct,
        "game_count": F.col("_n_game_count").cast("bigint"),
        "is_variety_streamer": S.variety_flag(pct, F.col("_n_game_count")),
    }
    for c in ("all_games", "games_by_stream_time", "games_by_avg_viewers"):
        if f"_n_{c}" in j.columns:
            new[c] = F.col(f"_n_{c}")
    got = F.col("_n_game_count").isNotNull()
    cols = {}
    for c, v in new.items():
        if c not in j.columns:
            cols[c] = F.when(got, v)
            continue
        old = F.col(c)
        if overwrite:
            cols[c] = F.when(got, v).otherwise(old)
        else:
            empty = S.blank(old, is_text=j.schema[c].dataType.typeName() == "string")
            cols[c] = F.when(got & empty, v).otherwise(old)
    out = j.withColumns(cols)
    return out.drop(*[c for c in out.columns if c.startswith("_n_")])


def needs_games(panel: DataFrame, overwrite: bool = False) -> DataFrame:
    """Rows whose three games columns are all blank (or all rows when overwriting)."""
    if overwrite:
        return panel
    cond = None
    for c in ("all_games_json", "games_by_stream_time_json", "games_by_avg_viewers_json",
              "all_games", "games_by_stream_time", "games_by_avg_viewers"):
        if c in panel.columns:
            e = (F.col(c).isNull() | (F.size(F.col(c)) == 0)) if panel.schema[c].dataType.typeName() == "array" \
                else S.blank(F.col(c))
            cond = e if cond is None else (cond & e)
    return panel if cond is None else panel.where(cond)


def explode_list(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """List column -> one row per item with its 1-based position."""
    return df.select(*keep, F.posexplode(col).alias("pos0", "item")).select(
        *keep, (F.col("pos0") + 1).cast("bigint").alias("pos"), "item.*")


def pie_top5_other(pies: DataFrame, keys: list[str], top: int = 5, divisor: float = 4.0,
                   other: str = "Other") -> DataFrame:
    """Top ``top`` labels by value/divisor, the rest summed into ``other``.

    ``pies`` has one row per (keys, label, value, pos); ``pos`` breaks ties in
    source order. The remainder row is kept only when its sum is non-zero.
    Values are rounded to 2 decimals.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("value").desc(), F.col("pos"))
    r = pies.withColumn("_r", F.row_number().over(w)).withColumn("_v", F.col("value") / divisor)
    lab = F.when(F.col("_r") <= top, F.col("label")).otherwise(F.lit(other))
    slot = F.when(F.col("_r") <= top, F.col("_r")).otherwise(F.lit(top + 1))
    g = r.groupBy(*keys, lab.alias("label"), slot.cast("bigint").alias("slot")).agg(
        F.sum(F.col("_v").cast("decimal(38,6)")).cast("double").alias("_s"))
    return (g.where((F.col("slot") <= top) | (F.col("_s") != 0))
             .select(*keys, "slot", "label", S.round_dp(F.col("_s"), 2).alias("value")))


def pie_tops(pies: DataFrame, slices: str, out: str, top: int = 5, divisor: float = 4.0,
             other: str = "Other") -> DataFrame:
    """The rule of :func:`pie_top5_other` inside one row: ``slices``
    (array<struct<label, value>> in source order) -> column ``out`` of the same
    type, sorted; null slices give null."""
    keyed = F.transform(F.col(slices), lambda x, i: F.struct(
        (-x["value"]).alias("k"), i.alias("i"), x["label"].alias("label"), (x["value"] / divisor).alias("value")))
    p = S.pinned(pies, "_sorted", F.sort_array(keyed))
    head = F.transform(F.slice("_sorted", 1, top), lambda x: F.struct(
        x["label"].alias("label"), S.round_dp(x["value"], 2).alias("value")))
    # added as decimals: the same sum in any engine and order
    rest = F.aggregate(F.slice("_sorted", top + 1, 1 << 30), F.lit(0).cast("decimal(38,6)"),
                       lambda acc, x: (acc + F.coalesce(x["value"], F.lit(0.0)).cast("decimal(38,6)"))
                       .cast("decimal(38,6)")).cast("double")
    p = S.pinned(p, "_rest", rest)
    tail = F.when(F.col("_rest") != 0, F.array(F.struct(F.lit(other).alias("label"),
                                                        S.round_dp("_rest", 2).alias("value"))))
    none = F.array().cast("array<struct<label:string,value:double>>")
    return p.withColumn(out, F.concat(head, F.coalesce(tail, none))).drop("_sorted", "_rest")
