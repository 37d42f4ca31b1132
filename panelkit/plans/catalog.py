"""Registered queries: a Spark builder and (where SQL can say it) a DuckDB oracle.

Every query reads the landed tables (or frames Spark derives from them), over
the whole tables; output columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import lookups as E
from ..operators import games as G
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import report as RP
from ..operators import scaffold as SC
from ..sources import bindings as B
from . import oracle as O
from . import panel as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco





# --- scaffold / merge -------------------------------------------------------

@register("month_spine", O.sql("SELECT " + O.MONTH_COLS + " FROM months", "months"))
def q_month_spine(spark, d):
    first, last = B.month_bounds(spark, d)
    return SC.month_spine(spark, first, last).drop("month_start")


@register("panel_scaffold", O.sql("SELECT * FROM scaffold", "scaffold"))
def q_panel_scaffold(spark, d):
    return SC.panel_scaffold(B.channels(spark, d), B.month_span(spark, d)).drop("month_start")


@register("panel_full", O.sql("SELECT * FROM panel", "panel"))
def q_panel_full(spark, d):
    return P.landed_panel(spark, d)


@register("last_per_key", O.sql("""
SELECT channel_id, month_key, seed_rank, seed_rows, seed.average_viewers AS average_viewers,
       seed.followers AS followers, seed.created AS created FROM seed_k""", "seed_k"))
def q_last_per_key(spark, d):
    k = M.last_per_key(B.seed_rows(spark, d))
    return k.select("channel_id", "month_key", "seed_rank", "seed_rows",
                    F.col("seed.average_viewers").alias("average_viewers"),
                    F.col("seed.followers").alias("followers"), F.col("seed.created").alias("created"))


@register("live_first_last", O.sql("""
SELECT channel_id, month_key, live_rank, coalesce(live_has, false) AS live_has,
       live.average_viewers AS average_viewers, live.hours_streamed AS hours_streamed,
       live.language AS language FROM live_k""", "live_k"))
def q_live_first_last(spark, d):
    k = M.live_first_last(B.live_rows(spark, d))
    return k.select("channel_id", "month_key", "live_rank", F.coalesce("live_has", F.lit(False)).alias("live_has"),
                    F.col("live.average_viewers").alias("average_viewers"),
                    F.col("live.hours_streamed").alias("hours_streamed"),
                    F.col("live.language").alias("language"))


@register("panel_rank", O.sql("""
SELECT s.channel_id, s.month_key, CAST(coalesce(k.seed_rank, l.live_rank) AS BIGINT) AS rank,
       CASE WHEN k.seed_rank IS NOT NULL THEN 'seed' WHEN l.live_rank IS NOT NULL THEN 'live' END AS rank_source
FROM scaffold s
LEFT JOIN seed_k k ON s.channel_id = k.channel_id AND s.month_key = k.month_key
LEFT JOIN live_k l ON s.channel_id = l.channel_id AND s.month_key = l.month_key""", "scaffold", "seed_k", "live_k"))
def q_panel_rank(spark, d):
    sc = SC.panel_scaffold(B.channels(spark, d), B.month_span(spark, d))
    j = (sc.join(M.last_per_key(B.seed_rows(spark, d)), M.KEY, "left")
           .join(M.live_first_last(B.live_rows(spark, d)), M.KEY, "left"))
    return j.select("channel_id", "month_key",
                    F.coalesce("seed_rank", "live_rank").cast("bigint").alias("rank"),
                    F.when(F.col("seed_rank").isNotNull(), "seed")
                     .when(F.col("live_rank").isNotNull(), "live").alias("rank_source"))


@register("merge_sources", O.sql("""
SELECT channel_id, month_key, source, has_metrics, average_viewers, hours_watched, hours_streamed,
       followers, peak_viewers, language FROM merged""", "merged"))
def q_merge_sources(spark, d):
    p = P.landed_panel(spark, d)
    return p.select("channel_id", "month_key", "source",
                    (F.col("status") != S.STATUS_INACTIVE).alias("has_metrics"),
                    "average_viewers", "hours_watched", "hours_streamed", "followers", "peak_viewers", "language")


@register("panel_status", O.sql(f"""
SELECT channel_id, month_key, status,
       CASE WHEN NOT (average_viewers IS NOT NULL OR hours_watched IS NOT NULL OR hours_streamed IS NOT NULL
                      OR followers IS NOT NULL OR followers_gained IS NOT NULL OR peak_viewers IS NOT NULL)
            THEN 'inactive' WHEN rank <= 500 THEN 'active_top500' WHEN rank IS NOT NULL THEN 'active_not_top500'
            ELSE 'active_unranked' END AS status_any_metric
FROM panel""", "panel"))
def q_panel_status(spark, d):
    p = P.landed_panel(spark, d)
    by_metric = S.panel_status(S.any_not_null(*S.METRIC_FIELDS), F.col("rank"))
    return p.select("channel_id", "month_key", "status", by_metric.alias("status_any_metric"))


@register("panel_status_top50", O.sql(f"""
SELECT channel_id, month_key, {O.status_case(50)} AS status FROM merged""", "merged"))
def q_panel_status_top50(spark, d):
    """A narrower top cut than the default 500."""
    return P.landed_panel(spark, d, top_k=50).select("channel_id", "month_key", "status")


@register("first_per_channel", O.sql("""
SELECT channel_id, month_key, rank_position, average_viewers FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY year, month_order, row_seq) AS rn FROM seed)
WHERE rn = 1""", "seed"))
def q_first_per_channel(spark, d):
    s = B.seed_rows(spark, d)
    return SC.first_per_channel(s, ["year", "month_order", "row_seq"]).select(
        "channel_id", "month_key", "rank_position", "average_viewers")


# --- enrichment ---------------------------------------------------------------

ENRICHED_SCALARS = [c for c in M.PANEL_COLUMNS]


@register("enrich_games", O.sql("SELECT * FROM enriched", "enriched"))
def q_enrich_games(spark, d):
    return P.enriched_panel(spark, d, with_lists=False).select(*ENRICHED_SCALARS)


@register("games_features", O.sql("""
SELECT channel_id, month_key, top_game, top_game_hours, top_game_pct, game_count, is_variety_streamer
FROM enriched WHERE game_count IS NOT NULL""", "enriched"))
def q_games_features(spark, d):
    return (P.enriched_panel(spark, d, with_lists=False).where(F.col("game_count").isNotNull())
            .select("channel_id", "month_key", "top_game", "top_game_hours", "top_game_pct", "game_count",
                    "is_variety_streamer"))


@register("games_lists", O.sql("""
SELECT channel_id, month_key, 'all' AS list, pos, game, round(coalesce(hours, 0.0), 2) AS value FROM games
UNION ALL
SELECT channel_id, month_key, 'by_time', CAST(row_number() OVER (PARTITION BY channel_id, month_key
       ORDER BY coalesce(hours, 0.0) DESC, pos) AS BIGINT), game, round(coalesce(hours, 0.0), 2) FROM games
UNION ALL
SELECT channel_id, month_key, 'by_avg', CAST(row_number() OVER (PARTITION BY channel_id, month_key
       ORDER BY coalesce(avg_viewers, 0.0) DESC, pos) AS BIGINT), game, coalesce(avg_viewers, 0.0) FROM games""",
                                      "games"))
def q_games_lists(spark, d):
    a = G.games_agg(B.games_rows(spark, d), with_lists=True)
    keep = ["channel_id", "month_key"]
    lists = {"all": ("all_games", "hours"), "by_time": ("games_by_stream_time", "hours"),
             "by_avg": ("games_by_avg_viewers", "avg_viewers")}
    # one array of all items: the lists are built and exploded in one pass
    def tagged(name, col, value):
        return F.transform(col, lambda x, i: F.struct(
            F.lit(name).alias("list"), (i + 1).cast("bigint").alias("pos"), x["game"], x[value].alias("value")))
    items = F.concat(*[tagged(name, col, value) for name, (col, value) in lists.items()])
    return a.select(*keep, F.explode(items).alias("g")).select(*keep, "g.*")


@register("enrich_created", O.sql("SELECT channel_id, month_key, created FROM enriched", "enriched"))
def q_enrich_created(spark, d):
    return E.enrich_created(P.landed_panel(spark, d), B.users(spark, d)).select("channel_id", "month_key", "created")


@register("cohort_ranks", O.sql("""
SELECT channel_id, month_key,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY average_viewers DESC NULLS LAST) AS BIGINT) AS avg_viewer_rank,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY peak_viewers DESC NULLS LAST) AS BIGINT) AS peak_viewer_rank,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY followers DESC NULLS LAST) AS BIGINT) AS follower_rank,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY followers_gained DESC NULLS LAST) AS BIGINT) AS follower_gain_rank
FROM enriched""", "enriched"))
def q_cohort_ranks(spark, d):
    from ..operators import ranks as R
    panel = P.landed_panel(spark, d).select("channel_id", "month_key", "year", "month", *R.COHORT_RANKS)
    return R.cohort_ranks(panel).select("channel_id", "month_key", *R.COHORT_RANKS.values())


@register("cohort_ranks_range", SQL["cohort_ranks"])
def q_cohort_ranks_range(spark, d):
    """The same ranks taken after the enrichment, which changes no ranked metric."""
    from ..operators import ranks as R
    return R.cohort_ranks(P.enriched_panel(spark, d, with_lists=False)).select(
        "channel_id", "month_key", *R.COHORT_RANKS.values())


# --- report -----------------------------------------------------------------
# Sections over rank, status and the six metrics read the panel before its
# enrichment, which changes none of these.

_ACTIVE = "coalesce(status, 'inactive') <> 'inactive'"
_ANY_METRIC = ("(average_viewers IS NOT NULL OR hours_watched IS NOT NULL OR hours_streamed IS NOT NULL "
               "OR followers IS NOT NULL OR followers_gained IS NOT NULL OR peak_viewers IS NOT NULL)")


def _mean(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / nullif(count({c}), 0)"


@register("monthly_summary", O.sql(f"""
SELECT coalesce(nullif(trim(month_key), ''), 'UNKNOWN') AS month_key, count(*) AS rows,
       count(rank) / count(*) AS rank_coverage,
       count(*) FILTER (WHERE {_ACTIVE}) / count(*) AS panel_coverage,
       {_mean('average_viewers')} AS avg_viewers_mean,
       {_mean('hours_watched')} AS hours_watched_mean
FROM enriched GROUP BY 1""", "enriched"))
def q_monthly_summary(spark, d):
    return RP.monthly_summary(P.landed_panel(spark, d))


@register("status_distribution", O.sql("""
SELECT trim(coalesce(status, 'UNKNOWN')) AS status, count(*) AS count FROM enriched GROUP BY 1""", "enriched"))
def q_status_distribution(spark, d):
    return RP.status_distribution(P.landed_panel(spark, d))


@register("overview", O.sql(f"""
SELECT count(*) AS total_rows, count(DISTINCT channel_id) AS unique_channels, CAST(31 AS BIGINT) AS columns_seen,
       count(rank) AS rows_with_rank, count(*) FILTER (WHERE {_ANY_METRIC}) AS rows_with_any_metric,
       count(*) FILTER (WHERE {_ACTIVE}) AS active_rows,
       count(*) - count(*) FILTER (WHERE {_ACTIVE}) AS inactive_rows,
       count(*) FILTER (WHERE status = 'active_top500') AS top500_rows
FROM enriched""", "enriched"))
def q_overview(spark, d):
    return RP.overview(P.enriched_panel(spark, d, lists=()))


_MISS_COLS = [
    ("channel_id", "channel_id IS NULL"), ("channel_name", "coalesce(channel_name, '') = ''"),
    ("display_name", "coalesce(display_name, '') = ''"), ("year", "year IS NULL"),
    ("month", "coalesce(month, '') = ''"), ("month_key", "coalesce(month_key, '') = ''"),
    ("status", "coalesce(status, '') = ''"), ("rank", "rank IS NULL"),
    ("average_viewers", "average_viewers IS NULL"), ("hours_watched", "hours_watched IS NULL"),
    ("hours_streamed", "hours_streamed IS NULL"), ("followers", "followers IS NULL"),
    ("followers_gained", "followers_gained IS NULL"), ("peak_viewers", "peak_viewers IS NULL"),
    ("created", "coalesce(created, '') = ''"), ("top_game", "coalesce(top_game, '') = ''"),
    ("top_game_hours", "top_game_hours IS NULL"), ("top_game_pct", "top_game_pct IS NULL"),
    ("game_count", "game_count IS NULL"), ("is_variety_streamer", "is_variety_streamer IS NULL"),
    ("games_by_avg_viewers_json", "game_count IS NULL"), ("games_by_stream_time_json", "game_count IS NULL"),
    ("all_games_json", "game_count IS NULL"),
]
_MISS_SQL = "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS ord, '{c}' AS column, count(*) FILTER (WHERE {cond}) AS missing, "
    f"count(*) FILTER (WHERE {cond}) / count(*) * 100.0 AS missing_pct FROM enriched"
    for i, (c, cond) in enumerate(_MISS_COLS))


@register("missingness", O.sql(_MISS_SQL, "enriched"))
def q_missingness(spark, d):
    return RP.missingness(P.enriched_panel(spark, d, lists=()))


_CHANNEL_STATS = f"""
SELECT channel_id, count(*) AS rows, min(CAST(rank AS DOUBLE)) AS rank_min,
       {_mean('average_viewers')} AS avg_viewers,
       coalesce(CAST(sum(CAST(hours_watched AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS hours_watched,
       {_mean('CAST(followers AS DOUBLE)')} AS followers_avg,
       greatest(0.0, coalesce(max(CAST(peak_viewers AS DOUBLE)), 0.0)) AS peak_viewers_max,
       count(*) FILTER (WHERE trim(coalesce(status, '')) <> 'inactive') AS active_rows,
       count(*) FILTER (WHERE trim(coalesce(status, '')) = 'active_top500') AS top500_rows
FROM enriched WHERE channel_id IS NOT NULL GROUP BY channel_id"""
O.CTES["channel_stats"] = _CHANNEL_STATS


@register("channel_stats", O.sql("SELECT * FROM channel_stats", "channel_stats"))
def q_channel_stats(spark, d):
    return RP.channel_stats(P.landed_panel(spark, d))


for _metric, _score in (("avg_viewers", "avg_viewers"), ("hours_watched", "hours_watched"),
                        ("followers", "followers_avg")):
    def _mk(metric):
        def fn(spark, d):
            return RP.top_channels(P.landed_panel(spark, d), 20, metric)
        return fn
    register(f"top_channels_by_{_metric}", O.sql(
        f"SELECT *, {_score} AS score FROM channel_stats ORDER BY score DESC NULLS LAST, channel_id LIMIT 20",
        "channel_stats"))(_mk(_metric))

O.CTES["game_stats"] = f"""
SELECT game, count(*) AS mentions,
       coalesce(CAST(sum(CAST(hours AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS total_hours,
       {_mean('avg_viewers')} AS avg_viewers_mean
FROM (SELECT trim(g_game) AS game, g_hours AS hours, g_avg AS avg_viewers FROM enriched_games
      WHERE g_game IS NOT NULL AND trim(g_game) <> '')
GROUP BY game"""


@register("game_stats", O.sql("SELECT * FROM game_stats", "game_stats"))
def q_game_stats(spark, d):
    return RP.game_stats(P.enriched_panel(spark, d, lists=("all_games",)))


@register("top_games_by_hours", O.sql(
    "SELECT * FROM game_stats ORDER BY total_hours DESC, game LIMIT 20", "game_stats"))
def q_top_games_by_hours(spark, d):
    return RP.top_games(P.enriched_panel(spark, d, lists=("all_games",)), 20, "hours")


@register("top_games_by_mentions", O.sql(
    "SELECT * FROM game_stats ORDER BY mentions DESC, game LIMIT 20", "game_stats"))
def q_top_games_by_mentions(spark, d):
    return RP.top_games(P.enriched_panel(spark, d, lists=("all_games",)), 20, "mentions")


@register("created_cohorts", O.sql("""
SELECT CAST(year(try_cast(replace(created, 'Z', '') AS TIMESTAMP)) AS BIGINT) AS created_year, count(*) AS count
FROM enriched WHERE try_cast(replace(created, 'Z', '') AS TIMESTAMP) IS NOT NULL GROUP BY 1""", "enriched"))
def q_created_cohorts(spark, d):
    return RP.created_cohorts(P.enriched_panel(spark, d, with_lists=False))


@register("coverage_pcts", O.sql("""
SELECT avg(CASE WHEN rank IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS rank_found_pct,
       avg(CASE WHEN status <> 'inactive' THEN 1.0 ELSE 0.0 END) * 100.0 AS panel_coverage_pct,
       avg(CASE WHEN status = 'inactive' THEN 1.0 ELSE 0.0 END) * 100.0 AS inactive_pct,
       avg(CASE WHEN average_viewers IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS metrics_available_pct
FROM panel""", "panel"))
def q_coverage_pcts(spark, d):
    return RP.coverage_pcts(P.landed_panel(spark, d))


@register("rank_histogram", O.sql("""
SELECT s.bin, coalesce(c.channels, 0) AS channels
FROM (SELECT range AS bin FROM range(50) WHERE (SELECT count(rank_min) FROM channel_stats) > 0) s
LEFT JOIN (
  SELECT CAST(CASE WHEN hi - lo > 0 THEN least(floor((rank_min - lo) / (hi - lo) * 50), 49) ELSE 0 END AS BIGINT)
           AS bin, count(*) AS channels
  FROM (SELECT rank_min FROM channel_stats WHERE rank_min IS NOT NULL) b,
       (SELECT min(rank_min) AS lo, max(rank_min) AS hi FROM channel_stats) m
  GROUP BY 1) c ON s.bin = c.bin""", "channel_stats"))
def q_rank_histogram(spark, d):
    return RP.rank_histogram(P.landed_panel(spark, d))


@register("scan_coverage", O.sql("""
SELECT month_key, count(*) AS targets, count(rank) AS found,
       coalesce(count(rank) / nullif(count(*), 0), 0.0) AS coverage FROM panel GROUP BY month_key""", "panel"))
def q_scan_coverage(spark, d):
    return RP.scan_coverage(P.landed_panel(spark, d))


@register("viewer_trend", O.sql(f"""
SELECT first_mean, last_mean, (last_mean - first_mean) / nullif(first_mean, 0) * 100.0 AS pct_change FROM (
  SELECT arg_min(mean, year * 100 + month_order) AS first_mean, arg_max(mean, year * 100 + month_order) AS last_mean
  FROM (SELECT year, month_order, {_mean('average_viewers')} AS mean FROM enriched GROUP BY year, month_order))""",
    "enriched"))
def q_viewer_trend(spark, d):
    return RP.viewer_trend(P.enriched_panel(spark, d, with_lists=False))


@register("history_completeness", O.sql(f"""
SELECT active_months, count(*) AS channels, count(*) / (SELECT count(DISTINCT channel_id) FROM enriched) AS share
FROM (SELECT channel_id, count(*) FILTER (WHERE {_ACTIVE}) AS active_months FROM enriched GROUP BY channel_id)
GROUP BY active_months""", "enriched"))
def q_history_completeness(spark, d):
    return RP.history_completeness(P.landed_panel(spark, d))


O.CTES["month_cov"] = f"""
SELECT month_key, count(*) AS rows, count(*) FILTER (WHERE {_ACTIVE}) / count(*) AS panel_coverage
FROM enriched GROUP BY month_key"""


@register("low_coverage_months", O.sql("""
SELECT month_key, rows, panel_coverage FROM month_cov
WHERE panel_coverage < (SELECT avg(panel_coverage) FROM month_cov) * 0.8""", "month_cov"))
def q_low_coverage_months(spark, d):
    return RP.low_coverage_months(P.landed_panel(spark, d))


# --- quality ----------------------------------------------------------------

@register("validate_panel", O.sql("""
SELECT count(*) AS rows,
       (SELECT count(*) FROM channels) * (SELECT count(*) FROM months) AS expected_rows,
       count(*) - count(DISTINCT (channel_id, year, month)) AS duplicate_keys,
       count(*) FILTER (WHERE rank <= 0) AS bad_ranks,
       count(*) FILTER (WHERE rank IS NOT NULL AND average_viewers IS NULL AND hours_watched IS NULL
                        AND hours_streamed IS NULL AND followers IS NULL AND followers_gained IS NULL
                        AND peak_viewers IS NULL) AS ranked_missing_metrics,
       count(rank) AS ranked_rows,
       count(*) FILTER (WHERE rank IS NOT NULL AND average_viewers IS NULL AND hours_watched IS NULL
                        AND hours_streamed IS NULL AND followers IS NULL AND followers_gained IS NULL
                        AND peak_viewers IS NULL) * 100.0 / greatest(1, count(rank)) AS ranked_missing_pct
FROM panel""", "panel", "channels", "months"))
def q_validate_panel(spark, d):
    first, last = B.month_bounds(spark, d)
    months = SC.month_spine(spark, first, last)
    expected = B.channels(spark, d).select(F.count(F.lit(1))).scalar() * months.select(F.count(F.lit(1))).scalar()
    return Q.validate_panel(P.landed_panel(spark, d), expected).select(
        "rows", "expected_rows", "duplicate_keys", "bad_ranks", "ranked_missing_metrics", "ranked_rows",
        "ranked_missing_pct")


@register("ranked_missing_metrics", O.sql(f"""
SELECT channel_id, month_key, rank, status FROM panel
WHERE rank IS NOT NULL AND NOT {_ANY_METRIC}""", "panel"))
def q_ranked_missing_metrics(spark, d):
    return Q.ranked_missing_metrics(P.landed_panel(spark, d)).select("channel_id", "month_key", "rank", "status")
