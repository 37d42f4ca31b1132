"""Descriptive report over a (possibly enriched) panel.

Every section is one aggregate over the panel: Spark runs each as a partial
(map-side) aggregate plus a final merge, which is the distributed form of
folding chunk-wise running counts into one state. :func:`report_cells` computes
what all of them add up in one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .ordering import written

# Columns whose missingness is reported, in report order (fixed list).
KEY_COLUMNS = [
    "channel_id", "channel_name", "display_name", "year", "month", "month_key", "status",
    "rank", "average_viewers", "hours_watched", "hours_streamed", "followers",
    "followers_gained", "peak_viewers", "created", "top_game", "top_game_hours",
    "top_game_pct", "game_count", "is_variety_streamer", "games_by_avg_viewers_json",
    "games_by_stream_time_json", "all_games_json",
]
# Panel columns that may hold the lists under their nested names.
NESTED_ALIASES = {
    "all_games_json": "all_games",
    "games_by_stream_time_json": "games_by_stream_time",
    "games_by_avg_viewers_json": "games_by_avg_viewers",
}


def _active(status_col="status"):
    """Active for totals: null status counts as inactive."""
    return F.coalesce(F.col(status_col).cast("string"), F.lit(S.STATUS_INACTIVE)) != S.STATUS_INACTIVE


def _metric_cols(df: DataFrame) -> list[str]:
    return [c for c in S.METRIC_FIELDS if c in df.columns]


def overview(panel: DataFrame) -> DataFrame:
    metrics = _metric_cols(panel)
    active = F.count_if(_active())
    return panel.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(S.safe_int("channel_id")).alias("unique_channels"),
        F.lit(len(panel.columns)).cast("bigint").alias("columns_seen"),
        F.count("rank").alias("rows_with_rank"),
        F.count_if(S.any_not_null(*metrics)).alias("rows_with_any_metric"),
        active.alias("active_rows"),
        (F.count(F.lit(1)) - active).alias("inactive_rows"),
        F.count_if(F.col("status") == S.STATUS_TOP).alias("top500_rows"),
    )


def status_distribution(panel: DataFrame, order: bool = True) -> DataFrame:
    st = S.py_strip(F.coalesce(F.col("status").cast("string"), F.lit("UNKNOWN")))
    out = panel.groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.col("count").desc(), "status") if order else out


def _missing(df: DataFrame, c: str):
    col = F.col(c)
    if df.schema[c].dataType.typeName() == "string":
        return col.isNull() | (col == "")
    if df.schema[c].dataType.typeName() in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def missingness(panel: DataFrame, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """Missing count and % per key column present, one row per column.

    One pass computes every count; a ``stack`` turns the single row into
    (column, missing, missing_pct) rows."""
    present = []
    for i, c in enumerate(columns):
        src = c if c in panel.columns else NESTED_ALIASES.get(c)
        if src and src in panel.columns:
            present.append((i, c, src))
    total = F.count(F.lit(1))
    aggs = [total.alias("_n")] + [F.count_if(_missing(panel, src)).alias(f"_m{i}") for i, _, src in present]
    one = panel.agg(*aggs)
    stack = "stack({}, {}) as (ord, column, missing)".format(
        len(present), ", ".join(f"{i}L, '{c}', _m{i}" for i, c, _ in present))
    return one.selectExpr("_n", stack).select(
        "ord", "column", F.col("missing").cast("bigint").alias("missing"),
        F.when(F.col("_n") > 0, F.col("missing") / F.col("_n") * 100.0).otherwise(F.lit(0.0)).alias("missing_pct"),
    )


def monthly_summary(panel: DataFrame, order: bool = True) -> DataFrame:
    """Per month_key, in its order: rows, rank and panel coverage, metric means
    (non-null rows)."""
    mk = F.coalesce(F.nullif(S.safe_str("month_key"), F.lit("")), F.lit("UNKNOWN"))
    rows = F.count(F.lit(1))
    out = panel.groupBy(mk.alias("month_key")).agg(
        rows.cast("bigint").alias("rows"),
        (F.count("rank") / rows).alias("rank_coverage"),
        (F.count_if(_active()) / rows).alias("panel_coverage"),
        S.exact_mean(F.col("average_viewers")).alias("avg_viewers_mean"),
        S.exact_mean(F.col("hours_watched")).alias("hours_watched_mean"),
    )
    return out.orderBy("month_key") if order else out


def channel_stats(panel: DataFrame) -> DataFrame:
    """Per channel: rows, best rank, mean viewers, total hours watched, mean
    followers, max peak (0 when none), active rows (null status counts as
    active here, unlike the totals), top rows."""
    st = S.safe_str("status")
    return (panel.where(S.safe_int("channel_id").isNotNull())
            .groupBy(S.safe_int("channel_id").alias("channel_id")).agg(
                F.count(F.lit(1)).alias("rows"),
                F.min(F.col("rank").cast("double")).alias("rank_min"),
                S.exact_mean(F.col("average_viewers")).alias("avg_viewers"),
                F.coalesce(S.exact_sum(F.col("hours_watched")), F.lit(0.0)).alias("hours_watched"),
                S.exact_mean(F.col("followers").cast("double")).alias("followers_avg"),
                F.greatest(F.lit(0.0), F.coalesce(F.max(F.col("peak_viewers").cast("double")), F.lit(0.0)))
                 .alias("peak_viewers_max"),
                F.count_if(st != S.STATUS_INACTIVE).alias("active_rows"),
                F.count_if(st == S.STATUS_TOP).alias("top500_rows"),
            ))


def top_channels(panel: DataFrame, top_n: int = 20, metric: str = "avg_viewers") -> DataFrame:
    """Top-N channels by a score (null scores last, ties by channel id).

    ``orderBy(...).limit(n)`` plans a TakeOrderedAndProject: each task keeps
    its own top N, so no full sort or shuffle of the channel stats happens."""
    return _top(channel_stats(panel), {"followers": "followers_avg"}.get(metric, metric), top_n)


def _top(stats: DataFrame, score: str, top_n: int) -> DataFrame:
    return (stats.withColumn("score", F.col(score))
            .orderBy(F.col("score").desc_nulls_last(), F.col("channel_id")).limit(top_n))


def game_rows(panel: DataFrame, col: str = "all_games") -> DataFrame:
    """Exploded game items with a non-blank name: (game, hours, avg_viewers)."""
    items = panel.select(F.explode(col).alias("g")).select(
        S.safe_str(F.col("g.game")).alias("game"), F.col("g.hours").alias("hours"),
        F.col("g.avg_viewers").alias("avg_viewers"))
    return items.where(F.col("game") != "")


def game_stats(panel: DataFrame, col: str = "all_games") -> DataFrame:
    return game_rows(panel, col).groupBy("game").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.coalesce(S.exact_sum(F.col("hours")), F.lit(0.0)).alias("total_hours"),
        S.exact_mean(F.col("avg_viewers")).alias("avg_viewers_mean"),
    )


def top_games(panel: DataFrame, top_n: int = 20, mode: str = "hours") -> DataFrame:
    g = game_stats(panel)
    key = F.col("total_hours") if mode == "hours" else F.col("mentions")
    return g.orderBy(key.desc(), F.col("game")).limit(top_n)


def created_cohorts(panel: DataFrame, order: bool = True) -> DataFrame:
    y = S.created_year("created")
    out = (panel.select(y.alias("created_year")).where(F.col("created_year").isNotNull())
           .groupBy("created_year").agg(F.count(F.lit(1)).alias("count")))
    return out.orderBy(F.col("count").desc(), "created_year") if order else out


def coverage_pcts(panel: DataFrame) -> DataFrame:
    def pct(cond):
        return F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100.0
    return panel.agg(
        pct(F.col("rank").isNotNull()).alias("rank_found_pct"),
        pct(F.col("status") != S.STATUS_INACTIVE).alias("panel_coverage_pct"),
        pct(F.col("status") == S.STATUS_INACTIVE).alias("inactive_pct"),
        pct(F.col("average_viewers").isNotNull()).alias("metrics_available_pct"),
    )


def rank_histogram(panel: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of channels' best rank over equal-width bins between the
    smallest and largest best rank (last bin closed; one bin when equal);
    all bins are listed, empty ones with 0.

    Channels are first reduced to one count per best rank, and these are written: bounds and
    bins are taken from them, and the panel is computed once."""
    best = written(panel.groupBy(S.safe_int("channel_id").alias("c")).agg(F.min(F.col("rank").cast("double")).alias("rank_min"))
                   .where(F.col("c").isNotNull() & F.col("rank_min").isNotNull())
                   .groupBy("rank_min").agg(F.count(F.lit(1)).alias("_n")), "best-ranks")
    lo = best.select(F.min("rank_min")).scalar()
    hi = best.select(F.max("rank_min")).scalar()
    width = hi - lo
    b = F.when(width > 0, F.least(F.floor((F.col("rank_min") - lo) / width * bins), F.lit(bins - 1))) \
         .otherwise(F.lit(0)).cast("bigint")
    counts = best.groupBy(b.alias("bin")).agg(F.sum("_n").alias("channels"))
    # every bin is reported (empty ones with 0) once any channel has a rank;
    # the bin spine is a fixed 50-row range, the counts are at most 50 rows
    spine = best.sparkSession.range(bins).select(F.col("id").alias("bin")).where(lo.isNotNull())
    return spine.join(counts, "bin", "left").select(
        "bin", F.coalesce(F.col("channels"), F.lit(0)).cast("bigint").alias("channels"))


def scan_coverage(panel: DataFrame) -> DataFrame:
    """Per month: targets, channels with a rank, coverage (0 when no targets)."""
    return panel.groupBy("month_key").agg(
        F.count(F.lit(1)).alias("targets"),
        F.count("rank").alias("found"),
    ).withColumn("coverage", F.coalesce(F.try_divide(F.col("found"), F.col("targets")), F.lit(0.0)))


def viewer_trend(panel: DataFrame) -> DataFrame:
    """First vs last month mean of average viewers and the % change."""
    m = panel.groupBy("year", "month_order").agg(S.exact_mean(F.col("average_viewers")).alias("mean"))
    order = F.struct("year", "month_order")
    r = m.agg(F.min_by("mean", order).alias("first_mean"), F.max_by("mean", order).alias("last_mean"))
    return r.withColumn("pct_change", F.try_divide(F.col("last_mean") - F.col("first_mean"),
                                                   F.col("first_mean")) * 100.0)


def history_completeness(panel: DataFrame) -> DataFrame:
    """How many channels have data in exactly N months (two-level aggregate)."""
    per = panel.groupBy("channel_id").agg(F.count_if(_active()).alias("active_months"))
    total = per.select(F.count(F.lit(1))).scalar()
    return (per.groupBy("active_months").agg(F.count(F.lit(1)).alias("channels"))
               .withColumn("share", F.col("channels") / total))


def low_coverage_months(panel: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Months whose panel coverage is below ``ratio`` x the mean monthly coverage.
    The months are reduced once and written, one row each."""
    mk = F.coalesce(F.nullif(S.safe_str("month_key"), F.lit("")), F.lit("UNKNOWN"))
    n = F.count(F.lit(1))
    ms = written(panel.groupBy(mk.alias("month_key")).agg(n.alias("rows"), (F.count_if(_active()) / n).alias("panel_coverage")), "months")
    mean_cov = ms.select(F.avg("panel_coverage")).scalar()
    return ms.where(F.col("panel_coverage") < mean_cov * ratio).select("month_key", "rows", "panel_coverage")


def _long(df: DataFrame, section: str, key: str, *values: str) -> DataFrame:
    """One (section, key, item, value) row per value column."""
    items = ", ".join(f"'{v}', cast({v} as double)" for v in values)
    return df.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), *values).selectExpr(
        "section", "key", f"stack({len(values)}, {items}) as (item, value)")


# --- all sections from one pass -----------------------------------------------------

def _measured(panel: DataFrame) -> DataFrame:
    """Every panel row as the cells it counts in: its month and status, its channel, its year of creation, and
    each of its games; (section, key, sub, v1..v3) beside the row's own columns."""
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    item = "struct<section:string,key:string,sub:string,v1:double,v2:double,v3:double>"

    def cell(section, key, sub=text, v1=none, v2=none, v3=none):
        return F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"), sub.alias("sub"), v1.cast("double").alias("v1"),
                        v2.cast("double").alias("v2"), v3.cast("double").alias("v3"))
    viewers, hours = F.col("average_viewers"), F.col("hours_watched")
    month = F.coalesce(F.nullif(S.safe_str("month_key"), F.lit("")), F.lit("UNKNOWN"))
    status = S.py_strip(F.coalesce(F.col("status").cast("string"), F.lit("UNKNOWN")))
    cells = F.filter(F.array(
        cell("month", month, status, viewers, hours),
        cell("channel", S.safe_int("channel_id"), text, viewers, hours, F.col("followers")),
        *([cell("created", S.created_year("created"))] if "created" in panel.columns else [])), lambda c: c["key"].isNotNull())
    if "all_games" in panel.columns:
        games = F.filter(F.transform("all_games", lambda g: cell("game", S.safe_str(g["game"]), text, g["avg_viewers"], g["hours"])),
                         lambda c: c["key"] != "")
        cells = F.concat(cells, F.coalesce(games, F.array().cast(f"array<{item}>")))
    return panel.select("*", F.explode(cells).alias("_c"))


def report_cells(panel: DataFrame) -> DataFrame:
    """One scan of a panel, one hash aggregate: a row per (month, status), channel, year of creation and game, with all
    that the report's sections add up. As many rows as channels and games, so the sections read it written."""
    present = [(c, src) for c in KEY_COLUMNS for src in [c if c in panel.columns else NESTED_ALIASES.get(c)] if src in panel.columns]
    measured, of_month = _measured(panel), F.col("_c.section") == "month"
    st = S.safe_str("status")
    sums = [F.sum(F.col(f"_c.{v}").cast("decimal(38,6)")).alias(f"{v}_sum") for v in ("v1", "v2", "v3")]
    counts = [F.count(f"_c.{v}").alias(f"{v}_n") for v in ("v1", "v2", "v3")]
    return measured.groupBy(*[F.col(f"_c.{k}").alias(k) for k in ("section", "key", "sub")]).agg(
        F.count(F.lit(1)).alias("n"), *sums, *counts, F.count("rank").alias("ranked"), F.min(F.col("rank").cast("double")).alias("rank_min"),
        F.max(F.col("peak_viewers").cast("double")).alias("peak"), F.count_if(_active()).alias("active"),
        F.count_if(st != S.STATUS_INACTIVE).alias("not_inactive"), F.count_if(st == S.STATUS_TOP).alias("top"),
        F.count_if(F.col("status") == S.STATUS_TOP).alias("top_exact"), F.count_if(of_month & S.any_not_null(*_metric_cols(panel))).alias("any_metric"),
        *[F.count_if(of_month & _missing(panel, src)).alias(f"miss_{c}") for c, src in present])


def _cell_mean(v: str):
    return F.try_divide(F.sum(f"{v}_sum").cast("double"), F.sum(f"{v}_n"))


def sections(cells: DataFrame, columns_seen: int, top_n: int = 20) -> dict[str, DataFrame]:
    """The report's sections from its (written) cells, under the names and columns of the functions above."""
    months, channels, games = (cells.where(F.col("section") == s) for s in ("month", "channel", "game"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    added = months.agg(total.alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cells.columns if c.startswith("miss_")])
    missing = [c for c in cells.columns if c.startswith("miss_")]
    order = {c: i for i, c in enumerate(KEY_COLUMNS)}
    stack = "stack({}, {}) as (ord, column, missing)".format(
        len(missing), ", ".join(f"{order[c[5:]]}L, '{c[5:]}', {c}" for c in missing))
    unique = channels.select(F.count(F.lit(1))).scalar()
    over = months.agg(total.alias("total_rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (
        ("ranked", "rows_with_rank"), ("any_metric", "rows_with_any_metric"), ("active", "active_rows"), ("top_exact", "top500_rows"))])
    stats = channels.select(
        F.col("key").cast("bigint").alias("channel_id"), F.col("n").alias("rows"), "rank_min",
        F.try_divide(F.col("v1_sum").cast("double"), F.col("v1_n")).alias("avg_viewers"),
        F.coalesce(F.col("v2_sum").cast("double"), F.lit(0.0)).alias("hours_watched"),
        F.try_divide(F.col("v3_sum").cast("double"), F.col("v3_n")).alias("followers_avg"),
        F.greatest(F.lit(0.0), F.coalesce("peak", F.lit(0.0))).alias("peak_viewers_max"),
        F.col("not_inactive").alias("active_rows"), F.col("top").alias("top500_rows"))
    played = games.select(F.col("key").alias("game"), F.col("n").alias("mentions"), F.coalesce(F.col("v2_sum").cast("double"), F.lit(0.0)).alias("total_hours"),
                          F.try_divide(F.col("v1_sum").cast("double"), F.col("v1_n")).alias("avg_viewers_mean"))
    rows = F.sum("n")
    return {
        "overview": over.select("total_rows", unique.alias("unique_channels"), F.lit(columns_seen).cast("bigint").alias("columns_seen"), "rows_with_rank",
                                "rows_with_any_metric", "active_rows", (F.col("total_rows") - F.col("active_rows")).alias("inactive_rows"), "top500_rows"),
        "status_distribution": months.groupBy(F.col("sub").alias("status")).agg(rows.alias("count")),
        "missingness": added.selectExpr("n", stack).select("ord", "column", "missing", F.when(F.col("n") > 0, F.col("missing") / F.col("n") * 100.0)
                                                          .otherwise(F.lit(0.0)).alias("missing_pct")),
        "monthly_summary": months.groupBy(F.col("key").alias("month_key")).agg(
            rows.alias("rows"), (F.sum("ranked") / rows).alias("rank_coverage"), (F.sum("active") / rows).alias("panel_coverage"),
            _cell_mean("v1").alias("avg_viewers_mean"), _cell_mean("v2").alias("hours_watched_mean")),
        "created_cohorts": cells.where("section = 'created'").select(F.col("key").cast("bigint").alias("created_year"), F.col("n").alias("count")),
        "channel_stats": stats,
        "top_channels_by_avg_viewers": _top(stats, "avg_viewers", top_n),
        "top_channels_by_hours_watched": _top(stats, "hours_watched", top_n),
        "top_channels_by_followers": _top(stats, "followers_avg", top_n),
        "game_stats": played,
        "top_games_by_hours": played.orderBy(F.desc("total_hours"), "game").limit(top_n),
        "top_games_by_mentions": played.orderBy(F.desc("mentions"), "game").limit(top_n),
    }


def report_long(panel: DataFrame, top_n: int = 20, columns_seen: int | None = None) -> DataFrame:
    """All report sections in one long (section, key, item, value) table:
    overview, status, missing, monthly, created_year, the two channel tops and,
    where the panel holds game lists, the games top.

    The panel is scanned once, into :func:`report_cells`, which are written; the sections read
    those. ``columns_seen`` overrides the number of columns reported."""
    found = sections(written(report_cells(panel), "report-cells"), len(panel.columns) if columns_seen is None else columns_seen, top_n)
    parts = [
        _long(found["overview"].withColumn("k", F.lit("panel")), "overview", "k", "total_rows", "unique_channels", "columns_seen",
              "rows_with_rank", "rows_with_any_metric", "active_rows", "inactive_rows", "top500_rows"),
        _long(found["status_distribution"], "status", "status", "count"),
        _long(found["missingness"], "missing", "column", "missing", "missing_pct"),
        _long(found["monthly_summary"], "monthly", "month_key", "rows", "rank_coverage", "panel_coverage", "avg_viewers_mean",
              "hours_watched_mean"),
        _long(found["created_cohorts"], "created_year", "created_year", "count"),
        _long(found["top_channels_by_avg_viewers"], "top_channels_by_avg_viewers", "channel_id", "avg_viewers"),
        _long(found["top_channels_by_hours_watched"], "top_channels_by_hours_watched", "channel_id", "hours_watched"),
    ]
    if "all_games" in panel.columns:
        parts.append(_long(found["top_games_by_hours"], "top_games_by_hours", "game", "mentions", "total_hours", "avg_viewers_mean"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
