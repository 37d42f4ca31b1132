"""Reference SQL (DuckDB dialect) for the registered queries.

The same bindings and operators as the Spark code, written as plain SQL CTEs
over the landed tables, so DuckDB can recompute every result independently.
``sql(final, *ctes)`` prepends the named CTEs and everything they depend on.
"""

from __future__ import annotations

import re

MONTH_COLS = ("CAST(year(ms) AS BIGINT) AS year, lower(strftime(ms, '%B')) AS month, "
              "strftime(ms, '%Y') || lower(strftime(ms, '%B')) AS month_key, "
              "CAST(month(ms) AS BIGINT) AS month_order")
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
SEED_STRUCT = ", ".join(f"'{c}': {c}" for c in (
    "average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained",
    "peak_viewers", "language", "created", "mature"))
LIVE_FIELDS = ("average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained",
               "peak_viewers", "language", "display_name", "channel_slug")
LIVE_STRUCT = ", ".join(f"'{c}': {c}" for c in LIVE_FIELDS)
LIVE_ANY = " OR ".join(f"{c} IS NOT NULL" for c in LIVE_FIELDS)


def status_case(top_k: int = 500) -> str:
    return (f"CASE WHEN NOT has_metrics THEN 'inactive' WHEN rank <= {top_k} THEN 'active_top500' "
            "WHEN rank IS NOT NULL THEN 'active_not_top500' ELSE 'active_unranked' END")


CTES: dict[str, str] = {}
CTES["om"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS ms
FROM orders"""
CTES["channels"] = """
SELECT c_custkey AS channel_id,
       lower(regexp_replace(coalesce(c_name, ''), '^\\s+|\\s+$', '', 'g')) AS channel_name,
       coalesce(c_name, '') AS display_name
FROM customer"""
CTES["months"] = """
SELECT CAST(m AS DATE) AS ms
FROM (SELECT min(ms) AS lo, max(ms) AS hi FROM om) b,
     unnest(generate_series(b.lo, b.hi, INTERVAL 1 MONTH)) AS t(m)"""
CTES["scaffold"] = f"""
SELECT c.channel_id, c.channel_name, c.display_name, {MONTH_COLS}
FROM channels c CROSS JOIN months"""
_STATUS_AGG = """
SELECT o_custkey, ms, o_orderstatus, count(*) AS n,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s, max(o_totalprice) AS mx,
       min(o_orderdate) AS first_dt, min(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS pri_min
FROM om WHERE o_orderstatus IN {statuses}
GROUP BY o_custkey, ms, o_orderstatus"""
CTES["sagg"] = _STATUS_AGG.format(statuses="('F', 'P')")
CTES["lagg"] = _STATUS_AGG.format(statuses="('O', 'P')")
CTES["seed"] = f"""
SELECT o_custkey AS channel_id, {MONTH_COLS},
       CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) AS row_seq,
       CAST(row_number() OVER (PARTITION BY ms, o_orderstatus ORDER BY s DESC, o_custkey)
            - CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) AS rank_position,
       CAST(s AS DOUBLE) / n AS average_viewers,
       CAST(s AS DOUBLE) AS hours_watched,
       CAST(NULL AS DOUBLE) AS hours_streamed,
       CAST(CAST(s * 100 AS BIGINT) // 100000 AS BIGINT) AS followers,
       CAST(n AS BIGINT) AS followers_gained,
       CAST(floor(mx) AS BIGINT) AS peak_viewers,
       'p' || pri_min AS language, pri_min = 1 AS mature,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(first_dt, {ISO}) END AS created
FROM sagg"""
CTES["seed_k"] = f"""
SELECT channel_id, month_key,
       arg_max({{{SEED_STRUCT}}}, row_seq) AS seed,
       arg_max(rank_position, row_seq) FILTER (WHERE rank_position > 0) AS seed_rank,
       count(*) AS seed_rows
FROM seed GROUP BY channel_id, month_key"""
CTES["live"] = f"""
SELECT o_custkey AS channel_id, {MONTH_COLS},
       CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1099511627776 END + (rnk - 1) // 100 AS BIGINT) AS page_seq,
       rnk AS row_pos, rnk AS rank,
       CASE WHEN has THEN CAST(s AS DOUBLE) / n END AS average_viewers,
       CASE WHEN has THEN CAST(s AS DOUBLE) / 60.0 END AS hours_watched,
       CASE WHEN has THEN CAST(n AS DOUBLE) * 100.0 END AS hours_streamed,
       CAST(NULL AS BIGINT) AS followers, CAST(NULL AS BIGINT) AS followers_gained,
       CASE WHEN has THEN CAST(floor(mx) AS BIGINT) END AS peak_viewers,
       CASE WHEN has THEN 'p' || pri_min END AS language,
       CAST(NULL AS VARCHAR) AS display_name, CAST(NULL AS VARCHAR) AS channel_slug
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ms, o_orderstatus ORDER BY s DESC, o_custkey) AS BIGINT) AS rnk,
             pri_min <> 5 AS has FROM lagg)"""
CTES["live_k"] = f"""
SELECT channel_id, month_key,
       arg_min(rank, page_seq::HUGEINT * 1000000000 + row_pos) AS live_rank,
       arg_max({{{LIVE_STRUCT}}}, page_seq::HUGEINT * 1000000000 + row_pos) FILTER (WHERE {LIVE_ANY}) AS live,
       bool_or({LIVE_ANY}) AS live_has
FROM live GROUP BY channel_id, month_key"""
CTES["merged"] = """
SELECT s.channel_id, s.channel_name, s.display_name, s.year, s.month, s.month_key, s.month_order,
       CAST(coalesce(k.seed_rank, l.live_rank) AS BIGINT) AS rank,
       coalesce(l.live.average_viewers, k.seed.average_viewers) AS average_viewers,
       coalesce(l.live.hours_watched, k.seed.hours_watched) AS hours_watched,
       coalesce(l.live.hours_streamed, k.seed.hours_streamed) AS hours_streamed,
       coalesce(l.live.followers, k.seed.followers) AS followers,
       coalesce(l.live.followers_gained, k.seed.followers_gained) AS followers_gained,
       coalesce(l.live.peak_viewers, k.seed.peak_viewers) AS peak_viewers,
       CAST(NULL AS VARCHAR) AS top_game, CAST(NULL AS DOUBLE) AS top_game_hours,
       CAST(NULL AS DOUBLE) AS top_game_pct, CAST(NULL AS BIGINT) AS game_count,
       CAST(NULL AS BOOLEAN) AS is_variety_streamer,
       coalesce(l.live.language, k.seed.language) AS language,
       k.seed.created AS created, k.seed.mature AS mature,
       CAST(NULL AS BIGINT) AS peak_viewer_rank, CAST(NULL AS BIGINT) AS avg_viewer_rank,
       CAST(NULL AS BIGINT) AS follower_rank, CAST(NULL AS BIGINT) AS follower_gain_rank,
       (k.seed_rows IS NOT NULL OR coalesce(l.live_has, false)) AS has_metrics,
       CASE WHEN coalesce(l.live_has, false) THEN 'leaderboard' WHEN k.seed_rows IS NOT NULL THEN 'csv' END AS source
FROM scaffold s
LEFT JOIN seed_k k ON s.channel_id = k.channel_id AND s.month_key = k.month_key
LEFT JOIN live_k l ON s.channel_id = l.channel_id AND s.month_key = l.month_key"""
PANEL_COLS = ("channel_id, channel_name, display_name, year, month, month_key, month_order, rank, "
              "average_viewers, hours_watched, hours_streamed, followers, followers_gained, peak_viewers, "
              "top_game, top_game_hours, top_game_pct, game_count, is_variety_streamer, language, created, "
              "mature, peak_viewer_rank, avg_viewer_rank, follower_rank, follower_gain_rank")
CTES["panel"] = f"SELECT {PANEL_COLS}, {status_case()} AS status, source FROM merged"
CTES["gagg"] = """
SELECT o.o_custkey, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS ms, p.p_brand,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS hours,
       CAST(floor(max(l.l_extendedprice)) AS BIGINT) AS peak_viewers,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_viewers,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS view_minutes
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2, 3"""
CTES["games"] = f"""
SELECT o_custkey AS channel_id, {MONTH_COLS},
       CAST(row_number() OVER (PARTITION BY o_custkey, ms ORDER BY view_minutes DESC, p_brand) AS BIGINT) AS pos,
       p_brand AS game, hours, peak_viewers, avg_viewers, view_minutes
FROM gagg"""
CTES["games_k"] = """
SELECT channel_id, month_key,
       CAST(sum(CAST(coalesce(hours, 0.0) AS DECIMAL(38,6))) AS DOUBLE) AS total_hours,
       count(*) AS game_count,
       first(game ORDER BY coalesce(hours, 0.0) DESC, pos) AS top_game,
       round(max(coalesce(hours, 0.0)), 2) AS top_game_hours
FROM games GROUP BY channel_id, month_key"""
CTES["users"] = f"""
SELECT lower(c.c_name) AS login, strftime(f.first_dt, {ISO}) AS created_at
FROM customer c JOIN (SELECT o_custkey, min(o_orderdate) AS first_dt FROM orders GROUP BY o_custkey) f
  ON c.c_custkey = f.o_custkey"""
CTES["users_k"] = """
SELECT lower(login) AS login, max(created_at) AS created_at FROM users
WHERE login IS NOT NULL AND login <> '' AND coalesce(trim(created_at), '') <> ''
GROUP BY lower(login)"""
_GAME_FILL = """
       CASE WHEN g.game_count IS NOT NULL AND {blank} THEN {new} ELSE p.{col} END AS {col}"""
CTES["enriched"] = """
SELECT p.channel_id, p.channel_name, p.display_name, p.year, p.month, p.month_key, p.month_order, p.rank,
       p.average_viewers, p.hours_watched, p.hours_streamed, p.followers, p.followers_gained, p.peak_viewers,
       CASE WHEN g.game_count IS NOT NULL AND coalesce(trim(p.top_game), '') = '' THEN g.top_game ELSE p.top_game END AS top_game,
       CASE WHEN g.game_count IS NOT NULL AND p.top_game_hours IS NULL THEN g.top_game_hours ELSE p.top_game_hours END AS top_game_hours,
       CASE WHEN g.game_count IS NOT NULL AND p.top_game_pct IS NULL THEN g.pct ELSE p.top_game_pct END AS top_game_pct,
       CASE WHEN g.game_count IS NOT NULL AND p.game_count IS NULL THEN g.game_count ELSE p.game_count END AS game_count,
       CASE WHEN g.game_count IS NOT NULL AND p.is_variety_streamer IS NULL
            THEN g.pct < 75 AND g.game_count > 2 ELSE p.is_variety_streamer END AS is_variety_streamer,
       p.language,
       CASE WHEN coalesce(trim(p.created), '') = '' THEN coalesce(u.created_at, p.created) ELSE p.created END AS created,
       p.mature, p.peak_viewer_rank, p.avg_viewer_rank, p.follower_rank, p.follower_gain_rank, p.status, p.source
FROM panel p
LEFT JOIN (SELECT k.*, CASE WHEN den > 0 THEN round(top_game_hours / den * 100.0, 2) ELSE 0.0 END AS pct
           FROM (SELECT gk.*, CASE WHEN pp.hours_streamed > 0 THEN pp.hours_streamed ELSE gk.total_hours END AS den
                 FROM games_k gk JOIN panel pp ON gk.channel_id = pp.channel_id AND gk.month_key = pp.month_key) k) g
  ON p.channel_id = g.channel_id AND p.month_key = g.month_key
LEFT JOIN users_k u ON p.channel_name = u.login"""
CTES["enriched_games"] = """
SELECT e.*, gi.game AS g_game, gi.hours AS g_hours, gi.avg_viewers AS g_avg
FROM enriched e LEFT JOIN (
  SELECT channel_id, month_key, game, round(coalesce(hours, 0.0), 2) AS hours,
         coalesce(avg_viewers, 0.0) AS avg_viewers FROM games) gi
  ON e.channel_id = gi.channel_id AND e.month_key = gi.month_key"""

_NAME_RE = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [w for w in dict.fromkeys(_NAME_RE.findall(body)) if w in CTES and w != name]


def sql(final: str, *names: str) -> str:
    """``WITH`` + the named CTEs (and their dependencies, in order) + ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order) + "\n" + final.strip()
