"""Registered queries, part two: shaping, filters, sets, payloads, scan
bookkeeping, time rules, sinks and streaming runs."""

from __future__ import annotations


from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import lookups as E
from ..operators import games as G
from ..operators import incremental as I
from ..operators import merge as M
from ..operators import ranks as R
from ..operators import report as RP
from ..operators import scaffold as SC
from ..operators import schema as SH
from ..sources import bindings as B
from ..sources import payloads as PL
from ..sources import sinks as SK
from ..sources.tables import table
from ..streaming import streams as ST
from . import oracle as O
from . import panel as P
from .catalog import _ACTIVE, _ANY_METRIC, _MISS_SQL, SQL, register

O.CTES["final"] = """
SELECT * REPLACE (
  CAST(rank() OVER (PARTITION BY year, month ORDER BY average_viewers DESC NULLS LAST) AS BIGINT) AS avg_viewer_rank,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY peak_viewers DESC NULLS LAST) AS BIGINT) AS peak_viewer_rank,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY followers DESC NULLS LAST) AS BIGINT) AS follower_rank,
  CAST(rank() OVER (PARTITION BY year, month ORDER BY followers_gained DESC NULLS LAST) AS BIGINT) AS follower_gain_rank)
FROM enriched"""

# --- projections ---------------------------------------------------------------------


@register("month_key", O.sql("""
SELECT channel_id, row_seq, CAST(year AS VARCHAR) || lower(trim(' ' || upper(month) || ' ')) AS month_key,
       month_order AS month_number, CAST(substr(month_key, 1, 4) AS BIGINT) AS key_year,
       substr(month_key, 5) AS key_month
FROM seed""", "seed"))
def q_month_key(spark, d):
    s = B.seed_rows(spark, d).withColumn("raw", F.concat(F.lit(" "), F.upper("month"), F.lit(" ")))
    mk = S.month_key(F.col("year"), F.col("raw"))
    ky, km = S.split_month_key(mk)
    return s.select("channel_id", "row_seq", mk.alias("month_key"), S.month_number("raw").alias("month_number"),
                    ky.alias("key_year"), km.alias("key_month"))


_FINAL_SCALARS = ["year", "month", "channel_id", "display_name", "followers", "followers_gained", "average_viewers",
                  "peak_viewers", "hours_streamed", "hours_watched", "status", "mature", "language", "created",
                  "peak_viewer_rank", "avg_viewer_rank", "follower_rank", "follower_gain_rank"]


@register("final_projection", O.sql("SELECT " + ", ".join(_FINAL_SCALARS) + " FROM final", "final"))
def q_final_projection(spark, d):
    return SH.final_projection(P.final_panel(spark, d))


_AFTER_DROP = [c for c in M.PANEL_COLUMNS if c not in SH.DROP_COLUMNS]


@register("drop_columns", O.sql("SELECT " + ", ".join(_AFTER_DROP) + " FROM final", "final"))
def q_drop_columns(spark, d):
    f = P.final_panel(spark, d).drop("all_games", "games_by_stream_time", "games_by_avg_viewers")
    return SH.drop_columns(f)


@register("ensure_columns", O.sql("""
SELECT channel_id, month_key, CAST(0 AS BIGINT) AS streams, '' AS all_games_json, top_game FROM panel""", "panel"))
def q_ensure_columns(spark, d):
    p = SH.ensure_columns(P.landed_panel(spark, d), {"streams": (0, "bigint"), "all_games_json": ("", "string"),
                                                    "top_game": (None, "string")})
    return p.select("channel_id", "month_key", "streams", "all_games_json", "top_game")


@register("slug_fallback_column", O.sql(r"""
SELECT channel_id, month_key, lower(regexp_replace(coalesce(display_name, ''), '^\s+|\s+$', '', 'g')) AS slug
FROM panel""", "panel"))
def q_slug_fallback_column(spark, d):
    p = P.landed_panel(spark, d).drop("channel_name")
    return p.select("channel_id", "month_key", E.slug_column(p).alias("slug"))


def _comma_text(c):
    """Integer -> text with a thousands comma when >= 1000 (e.g. 12,345)."""
    return F.when(c >= 1000, F.concat(F.floor(c / 1000).cast("bigint").cast("string"), F.lit(","),
                                      F.lpad((c % 1000).cast("string"), 3, "0"))).otherwise(c.cast("string"))


@register("coerce_types", O.sql("""
SELECT channel_id, month_key, rank_position, average_viewers, peak_viewers,
       CASE WHEN peak_viewers >= 1000 THEN NULL ELSE peak_viewers END AS peak_viewers_strict, followers
FROM seed""", "seed"))
def q_coerce_types(spark, d):
    s = B.seed_rows(spark, d)
    text = s.select("month_key", *[F.col(c).cast("string").alias(c) for c in
                                   ("channel_id", "rank_position", "average_viewers", "followers")],
                    _comma_text(F.col("peak_viewers")).alias("peak_viewers"))
    typed = SH.coerce_types(text.withColumn("peak_text", F.col("peak_viewers")), strip_commas=True)
    return typed.select("channel_id", "month_key", "rank_position", "average_viewers", "peak_viewers",
                        S.safe_int("peak_text", strip_commas=False).alias("peak_viewers_strict"), "followers")


@register("fill_defaults", O.sql("""
SELECT channel_id, month_key, coalesce(created, '') AS created, coalesce(display_name, '') AS display_name,
       coalesce(status, 'UNKNOWN') AS status FROM panel""", "panel"))
def q_fill_defaults(spark, d):
    return SH.fill_defaults(P.landed_panel(spark, d)).select("channel_id", "month_key", "created", "display_name",
                                                           "status")


@register("phase1_record", O.sql("""
SELECT l.channel_id, l.year, l.month, c.channel_name AS channel_slug, c.display_name, l.rank AS rank_position,
       l.average_viewers, l.peak_viewers,
       CASE WHEN l.hours_streamed * 60.0 > 0 THEN round(l.hours_streamed * 60.0 / 60.0, 2) END AS hours_streamed,
       CASE WHEN l.hours_watched * 60.0 > 0 THEN round(l.hours_watched * 60.0 / 60.0, 2) END AS hours_watched,
       l.language
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, month_key ORDER BY page_seq, row_pos) AS rn FROM live) l
JOIN channels c ON l.channel_id = c.channel_id WHERE l.rn = 1 AND l.channel_id > 0""", "live", "channels"))
def q_phase1_record(spark, d):
    """The facts of the landed leaderboard pages; of a channel listed twice in a month, the first row."""
    return P.build_fact(PL.land_leaderboard_pages(_named_live(spark, d))).select(
        "channel_id", "year", "month", "channel_slug", "display_name", "rank_position", "average_viewers", "peak_viewers",
        "hours_streamed", "hours_watched", "language")


def _named_live(spark, d):
    names = B.channels(spark, d).select("channel_id", "display_name", F.concat(
        F.lit("/"), F.col("channel_name"), F.lit("/")).alias("channel_slug"))
    return B.live_rows(spark, d).drop("display_name", "channel_slug").join(names, "channel_id")


# --- filters and sets ------------------------------------------------------------

_ACTIVE_SET = ["active_top500", "active_not_top500"]


@register("status_filter", O.sql("""
SELECT channel_id, month_key, status FROM enriched WHERE status IN ('active_top500', 'active_not_top500')""",
                                 "enriched"))
def q_status_filter(spark, d):
    return P.enriched_panel(spark, d, status_filter=_ACTIVE_SET, with_lists=False).select("channel_id", "month_key", "status")


_SCOPE_YEARS, _SCOPE_MONTHS = [1996, 1997, 2030], ["january", "June ", "december"]


@register("month_scope", O.sql("""
SELECT DISTINCT month_key FROM seed
WHERE month_key IN ('1996january', '1996june', '1996december', '1997january', '1997june', '1997december',
                    '2030january', '2030june', '2030december')""", "seed"))
def q_month_scope(spark, d):
    wanted = SC.month_spine_from_list(spark, SC.month_list(_SCOPE_YEARS, _SCOPE_MONTHS)).select("month_key")
    return wanted.intersect(B.seed_rows(spark, d).select("month_key"))


@register("created_missing", O.sql("""
SELECT channel_id, month_key FROM panel WHERE coalesce(trim(created), '') = ''""", "panel"))
def q_created_missing(spark, d):
    return E.created_missing(P.landed_panel(spark, d)).select("channel_id", "month_key")


@register("needs_games", O.sql("SELECT channel_id, month_key FROM enriched WHERE game_count IS NULL", "enriched"))
def q_needs_games(spark, d):
    return G.needs_games(P.enriched_panel(spark, d, lists=("all_games",))).select("channel_id", "month_key")


@register("distinct_jobs", O.sql(
    "SELECT DISTINCT channel_id, year, month FROM enriched WHERE game_count IS NULL", "enriched"))
def q_distinct_jobs(spark, d):
    return G.needs_games(P.enriched_panel(spark, d, lists=("all_games",))).select("channel_id", "year", "month").distinct()


@register("rows_with_any_metric", O.sql(f"SELECT channel_id, month_key FROM panel WHERE {_ANY_METRIC}", "panel"))
def q_rows_with_any_metric(spark, d):
    return P.landed_panel(spark, d).where(S.any_not_null(*S.METRIC_FIELDS)).select("channel_id", "month_key")


@register("distinct_logins", O.sql("""
SELECT DISTINCT channel_name AS login FROM panel
WHERE coalesce(trim(created), '') = '' AND channel_name <> ''""", "panel"))
def q_distinct_logins(spark, d):
    return E.distinct_logins(P.landed_panel(spark, d))


@register("target_semi", O.sql("""
SELECT channel_id, month_key, rank FROM live WHERE channel_id IN (SELECT channel_id FROM seed)""", "live", "seed"))
def q_target_semi(spark, d):
    targets = B.seed_rows(spark, d).select("channel_id")
    return B.live_rows(spark, d).join(targets, "channel_id", "left_semi").select("channel_id", "month_key", "rank")


@register("missing_pairs", O.sql("""
SELECT s.channel_id, s.month_key FROM scaffold s
WHERE NOT EXISTS (SELECT 1 FROM seed_k k WHERE k.channel_id = s.channel_id AND k.month_key = s.month_key)
  AND NOT EXISTS (SELECT 1 FROM live_k l WHERE l.live_has AND l.channel_id = s.channel_id
                  AND l.month_key = s.month_key)""", "scaffold", "seed_k", "live_k"))
def q_missing_pairs(spark, d):
    sc = SC.panel_scaffold(B.channels(spark, d), B.month_span(spark, d))
    live_vals = M.live_first_last(B.live_rows(spark, d)).where("live_has")
    return I.missing_pairs(sc, B.seed_rows(spark, d), live_vals).select("channel_id", "month_key")


O.CTES["months_done"] = """
SELECT strftime(ms, '%Y') || lower(strftime(ms, '%B')) AS month_key FROM om GROUP BY 1
HAVING count(*) FILTER (WHERE o_orderstatus = 'F') > count(*) FILTER (WHERE o_orderstatus = 'O')"""


@register("incremental_todo", O.sql("""
SELECT s.channel_id, s.month_key FROM scaffold s
WHERE NOT EXISTS (SELECT 1 FROM seed k WHERE k.channel_id = s.channel_id AND k.month_key = s.month_key)
  AND s.month_key NOT IN (SELECT month_key FROM months_done)""", "scaffold", "seed", "months_done"))
def q_incremental_todo(spark, d):
    sc = SC.panel_scaffold(B.channels(spark, d), B.month_span(spark, d))
    status = F.col("o_orderstatus")
    # done: months with more finished than open orders
    done_months = (table(spark, d, "orders", "o_orderdate", "o_orderstatus")
                   .groupBy(S.month_key_of_month_start(F.to_date("o_orderdate")).alias("month_key"))
                   .agg(F.count_if(status == "F").alias("f"), F.count_if(status == "O").alias("o"))
                   .where("f > o").select("month_key"))
    return I.incremental_todo(sc, B.seed_rows(spark, d), done_months).select("channel_id", "month_key")




@register("remaining_targets", O.sql("""
SELECT s.channel_id, s.month_key FROM scaffold s
WHERE NOT EXISTS (SELECT 1 FROM seed k WHERE k.rank_position > 0 AND k.channel_id = s.channel_id
                  AND k.month_key = s.month_key)""", "scaffold", "seed"))
def q_remaining_targets(spark, d):
    found = B.seed_rows(spark, d).where(F.col("rank_position") > 0).select("channel_id", "month_key")
    return SC.scaffold_except(B.channels(spark, d), B.month_span(spark, d), found)


O.CTES["fallback_rows"] = """
SELECT c_custkey AS channel_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'gone-' ELSE '' END || lower(c_name) AS channel_slug,
       c_name AS display_name FROM customer"""


def _fallback_rows(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    return c.select(F.col("c_custkey").alias("channel_id"),
                    F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "gone-").otherwise(""),
                             F.lower("c_name")).alias("channel_slug"),
                    F.col("c_name").alias("display_name"))


O.CTES["fallback_lookup"] = """
SELECT login, created_at FROM users
UNION ALL SELECT regexp_replace(login, '[^a-z0-9_]', '', 'g'), created_at FROM users"""


@register("slug_fallback_join", O.sql(r"""
SELECT r.channel_id, coalesce(a.created_at, b.created_at) AS created_at,
       CASE WHEN a.created_at IS NOT NULL THEN 'slug' WHEN b.created_at IS NOT NULL THEN 'name' END AS matched_by
FROM fallback_rows r
LEFT JOIN fallback_lookup a ON lower(regexp_replace(r.channel_slug, '^\s+|\s+$', '', 'g')) = a.login
LEFT JOIN fallback_lookup b ON a.login IS NULL
     AND regexp_replace(lower(trim(r.display_name)), '[^a-z0-9_]', '', 'g') = b.login""",
    "fallback_rows", "fallback_lookup"))
def q_slug_fallback_join(spark, d):
    u = B.users(spark, d)
    lookup = u.unionByName(u.select(S.slugify("login").alias("login"), "created_at"))
    out = E.slug_fallback_join(_fallback_rows(spark, d), lookup, ["created_at"])
    return out.select("channel_id", "created_at", "matched_by")


O.CTES["outcome_lookup"] = """
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN regexp_replace(lower(c_name), '[^a-z0-9_]', '', 'g') ELSE lower(c_name) END AS login,
       CASE WHEN c_acctbal < 0 THEN 'empty' WHEN c_mktsegment = 'FURNITURE' THEN 'error' ELSE 'ok' END AS state,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS balance,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' THEN c_nationkey END AS nation FROM customer"""


@register("slug_lookup_outcomes", O.sql(r"""
SELECT channel_id, CASE WHEN sa IN ('ok', 'empty') THEN sa ELSE coalesce(sb, 'error') END AS outcome,
       CASE WHEN sa IN ('ok', 'empty') THEN 'slug' WHEN sb IN ('ok', 'empty') THEN 'name' END AS matched_by,
       CASE WHEN sa IN ('ok', 'empty') THEN ba ELSE bb END AS balance, CASE WHEN sa IN ('ok', 'empty') THEN na ELSE nb END AS nation
FROM (SELECT r.channel_id, a.state AS sa, b.state AS sb, a.balance AS ba, b.balance AS bb, a.nation AS na, b.nation AS nb FROM fallback_rows r
      LEFT JOIN outcome_lookup a ON lower(trim(r.channel_slug)) = a.login
      LEFT JOIN outcome_lookup b ON regexp_replace(lower(trim(r.display_name)), '[^a-z0-9_]', '', 'g') = b.login)""",
    "fallback_rows", "outcome_lookup"))
def q_slug_lookup_outcomes(spark, d):
    """Accounts in debt answer with nothing, those of one segment with an error; another segment is known by its plain name."""
    c = table(spark, d, "customer", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    seg, debt = F.col("c_mktsegment"), F.col("c_acctbal") < 0
    answers = ~debt & (seg != "FURNITURE")
    lookup = c.select(F.when(seg == "MACHINERY", S.slugify("c_name")).otherwise(F.lower("c_name")).alias("login"),
                      F.when(debt, "empty").when(seg == "FURNITURE", "error").otherwise("ok").alias("state"),
                      F.when(answers, F.col("c_acctbal")).alias("balance"), F.when(answers, F.col("c_nationkey")).alias("nation"))
    return E.slug_fallback_join(_fallback_rows(spark, d), lookup, ["balance", "nation"]).select(
        "channel_id", "outcome", "matched_by", "balance", "nation")


# --- scalar functions ---------------------------------------------------------------

_HOST = r"[a-z.]*example\.(com|net|org)"


@register("slug_norm", O.sql(r"""
SELECT page_id, lower(regexp_replace(coalesce(url, ''), '^\s+|\s+$', '', 'g')) AS slug FROM pages"""))
def q_slug_norm(spark, d):
    return table(spark, d, "pages", "page_id", "url").select("page_id", S.slug_norm("url").alias("slug"))


@register("slug_norm_url", O.sql(r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(
         lower(regexp_replace(coalesce(url, ''), '^\s+|\s+$', '', 'g')),
         'https?://(www\.)?[a-z.]*example\.(com|net|org)/', '', 'g'), '^/+|/+$', '', 'g'), '\s+', '', 'g') AS slug
FROM pages"""))
def q_slug_norm_url(spark, d):
    return table(spark, d, "pages", "page_id", "url").select("page_id", S.slug_norm_url("url", _HOST).alias("slug"))


@register("slugify", O.sql(r"""
SELECT page_id, regexp_replace(lower(regexp_replace(coalesce(url, ''), '^\s+|\s+$', '', 'g')), '[^a-z0-9_]', '', 'g')
       AS slug FROM pages"""))
def q_slugify(spark, d):
    return table(spark, d, "pages", "page_id", "url").select("page_id", S.slugify("url").alias("slug"))


@register("url_last_part", O.sql(r"""
SELECT page_id, list_extract(string_split(regexp_replace(url, '^/+|/+$', '', 'g'), '/'), -1) AS slug FROM pages"""))
def q_url_last_part(spark, d):
    return table(spark, d, "pages", "page_id", "url").select("page_id", S.url_last_part("url").alias("slug"))


def _number_text():
    e = F.col("event_type")
    return (F.when(e == "error", F.concat(F.lit("x"), F.col("event_id").cast("string")))
            .when(e == "click", F.concat(F.lit("1,"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")))
            .when(e == "view", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
            .otherwise(F.col("value").cast("string")))


_NUM_EXPECTED = """CASE event_type WHEN 'error' THEN NULL
                   WHEN 'click' THEN 1000.0 + event_id % 1000 ELSE value END"""


@register("clean_number", O.sql(f"SELECT event_id, {_NUM_EXPECTED} AS num FROM events"))
def q_clean_number(spark, d):
    e = B.events(spark, d, "event_id", "event_type", "value")
    return e.select("event_id", S.clean_number(_number_text()).alias("num"))


@register("safe_int", O.sql(f"SELECT event_id, CAST(trunc({_NUM_EXPECTED}) AS BIGINT) AS num FROM events"))
def q_safe_int(spark, d):
    e = B.events(spark, d, "event_id", "event_type", "value")
    return e.select("event_id", S.safe_int(_number_text()).alias("num"))


@register("first_nonempty", O.sql("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'x' || event_id
       WHEN 'click' THEN '1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')
       ELSE CAST(value AS VARCHAR) END AS first FROM events"""))
def q_first_nonempty(spark, d):
    e = B.events(spark, d, "event_id", "event_type", "value")
    blank = F.when(F.col("event_type") == "view", F.lit(" \t"))
    return e.select("event_id", S.first_nonempty(blank, F.lit(None).cast("string"), _number_text()).alias("first"))


@register("rank_bands", O.sql("""
SELECT CAST(CASE WHEN event_id < 500 THEN 0 WHEN event_id < 2000 THEN 1 WHEN event_id < 5000 THEN 2
            WHEN event_id < 10000 THEN 3 WHEN event_id < 20000 THEN 4 WHEN event_id >= 20000 THEN 5 END AS BIGINT) AS band,
       count(*) AS rows
FROM events GROUP BY 1"""))
def q_rank_bands(spark, d):
    e = B.events(spark, d, "event_id")
    return e.groupBy(S.rank_band("event_id").alias("band")).agg(F.count(F.lit(1)).alias("rows"))


# --- scan bookkeeping over events ----------------------------------------------------

def _event_log(spark, d):
    e = B.events(spark, d, "ts", "user_id")
    wk = F.date_trunc("week", "ts")
    return I.page_log(e, F.date_format(wk, "yyyy-MM-dd"),
                      F.floor((F.unix_seconds("ts") - F.unix_seconds(wk)) / 3600).cast("bigint"), "user_id")


O.CTES["ev_pages"] = """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS scope,
       CAST(date_diff('hour', date_trunc('week', ts), ts) AS BIGINT) AS page_seq, user_id FROM events"""
O.CTES["plog"] = """
SELECT pp.scope, pp.page_seq, pp.n_rows, CAST(coalesce(fs.n_new, 0) AS BIGINT) AS n_new,
       CAST(coalesce(sum(pp.n_rows) OVER (PARTITION BY pp.scope ORDER BY pp.page_seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
FROM (SELECT scope, page_seq, count(*) AS n_rows FROM ev_pages GROUP BY 1, 2) pp
LEFT JOIN (SELECT scope, page_seq, count(*) AS n_new
           FROM (SELECT scope, user_id, min(page_seq) AS page_seq FROM ev_pages GROUP BY 1, 2) GROUP BY 1, 2) fs
  ON pp.scope = fs.scope AND pp.page_seq = fs.page_seq"""
O.CTES["plog_b"] = """
SELECT *, CAST(CASE WHEN "offset" < 500 THEN 0 WHEN "offset" < 2000 THEN 1 WHEN "offset" < 5000 THEN 2
       WHEN "offset" < 10000 THEN 3 WHEN "offset" < 20000 THEN 4 WHEN "offset" >= 20000 THEN 5 END AS BIGINT) AS band FROM plog"""
O.CTES["cutoffs"] = """
SELECT scope, min(CASE WHEN run >= 10 THEN page_seq END) AS cutoff_zero_run,
       min(CASE WHEN i >= 5 AND recent < 3 THEN page_seq END) AS cutoff_recent, count(*) AS pages
FROM (SELECT *, sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY scope, island ORDER BY page_seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY scope ORDER BY page_seq
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island,
                   row_number() OVER (PARTITION BY scope ORDER BY page_seq) AS i,
                   sum(n_new) OVER (PARTITION BY scope ORDER BY page_seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
                     AS recent
            FROM plog))
GROUP BY scope"""


@register("scan_log_stats", O.sql("""
SELECT scope, band, count(*) AS pages, count(*) FILTER (WHERE n_rows > 0) AS nonempty_pages,
       CAST(sum(n_rows) AS BIGINT) AS rows, CAST(sum(n_new) AS BIGINT) AS found, sum(n_rows) / count(*) AS density
FROM plog_b GROUP BY scope, band""", "plog_b"))
def q_scan_log_stats(spark, d):
    return I.scan_log_stats(_event_log(spark, d))


@register("zero_yield_cutoff", O.sql("SELECT * FROM cutoffs", "cutoffs"))
def q_zero_yield_cutoff(spark, d):
    return I.zero_yield_cutoff(_event_log(spark, d), n_zero=10, recent=5, recent_min=3)


O.CTES["slot_log"] = """
SELECT p.scope, p.page_seq, p.page_seq * 20 AS "offset", coalesce(r.n_rows, 0) AS n_rows, coalesce(f.n_new, 0) AS n_new,
       CAST(CASE WHEN p.page_seq * 20 < 500 THEN 0 WHEN p.page_seq * 20 < 2000 THEN 1 WHEN p.page_seq * 20 < 5000 THEN 2
                 WHEN p.page_seq * 20 < 10000 THEN 3 WHEN p.page_seq * 20 < 20000 THEN 4 ELSE 5 END AS BIGINT) AS phase
FROM (SELECT scope, unnest(generate_series(0, max(page_seq))) AS page_seq FROM slots GROUP BY scope) p
LEFT JOIN (SELECT scope, page_seq, count(*) AS n_rows FROM slots GROUP BY 1, 2) r ON r.scope = p.scope AND r.page_seq = p.page_seq
LEFT JOIN (SELECT scope, page_seq, count(*) AS n_new FROM (
             SELECT scope, user_id, min(page_seq) AS page_seq FROM slots GROUP BY 1, 2) GROUP BY 1, 2) f
  ON f.scope = p.scope AND f.page_seq = p.page_seq"""
O.CTES["slots"] = """
SELECT event_type || ' ' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS scope, user_id,
       CAST(floor((epoch(ts) - epoch(date_trunc('week', ts))) / 600) AS BIGINT) AS page_seq FROM events"""
O.CTES["slot_pages"] = """
SELECT *, (row_number() OVER (PARTITION BY scope, phase ORDER BY page_seq) - 1) // 8 AS batch,
       CAST(n_rows > 0 OR "offset" <= 10000 AS BIGINT) AS counted FROM slot_log"""
O.CTES["slot_batches"] = """
SELECT scope, phase, batch, min("offset") AS min_offset, max(page_seq) AS last_page, sum(n_new) AS new,
       phase >= 4 AND batch >= 2 AND sum(n_rows) = 0 AS jump FROM slot_pages GROUP BY 1, 2, 3"""
O.CTES["slot_runs"] = """
SELECT scope, phase, batch, page_seq, c - coalesce(max(CASE WHEN n_new > 0 OR (jump AND page_seq = last_page) THEN c END) OVER (
         PARTITION BY scope ORDER BY page_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS run
FROM (SELECT p.*, b.jump, b.last_page, sum(p.counted) OVER (PARTITION BY p.scope ORDER BY p.page_seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
      FROM slot_pages p JOIN slot_batches b ON b.scope = p.scope AND b.phase = p.phase AND b.batch = p.batch)"""
O.CTES["slot_tests"] = """
SELECT b.*, r.run, row_number() OVER w AS g,
       sum(new) OVER (PARTITION BY b.scope ORDER BY last_page ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS last3,
       sum(new) OVER (PARTITION BY b.scope ORDER BY last_page ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS last5
FROM slot_batches b JOIN slot_runs r ON r.scope = b.scope AND r.page_seq = b.last_page WINDOW w AS (PARTITION BY b.scope ORDER BY last_page)"""


@register("scan_stop_points", O.sql("""
SELECT a.scope, s.phase AS stop_phase, CAST(s.batch + 1 AS BIGINT) AS stop_batch, s.last_page AS stop_page, s.reason, CAST(s.run AS BIGINT) AS run,
       a.pages, a.last - s.last_page AS pages_after
FROM (SELECT scope, count(*) AS pages, max(page_seq) AS last FROM slot_log GROUP BY scope) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY g) AS n FROM (
             SELECT *, CASE WHEN jump THEN NULL
                 WHEN batch >= 3 AND run >= CASE WHEN min_offset > 10000 THEN 20 ELSE 10 END THEN 'no_new'
                 WHEN phase >= 5 AND g >= 3 AND last3 = 0 THEN 'zero_yield' WHEN phase >= 4 AND g >= 5 AND last5 < 3 THEN 'sparse_tail' END AS reason
             FROM slot_tests) WHERE reason IS NOT NULL) s ON s.scope = a.scope AND s.n = 1""", "slot_log", "slot_tests"))
def q_scan_stop_points(spark, d):
    """Pages are ten-minute slots of one event type's week, empty ones too, at offsets of 20; targets are users."""
    e = B.events(spark, d, "ts", "user_id", "event_type")
    wk = F.date_trunc("week", "ts")
    scope = F.concat("event_type", F.lit(" "), F.date_format(wk, "yyyy-MM-dd"))
    log = I.page_log(e, scope, F.floor((F.unix_seconds("ts") - F.unix_seconds(wk)) / 600).cast("bigint"), "user_id")
    pages = I.page_spine(log).join(log.select("scope", "page_seq", "n_rows", "n_new"), ["scope", "page_seq"], "left").fillna(0, ["n_rows", "n_new"])
    return I.stop_points(pages.withColumn("offset", F.col("page_seq") * 20))


@register("resume_offsets", O.sql("""
SELECT p.scope, CAST(CASE WHEN bool_or(c.cutoff_zero_run IS NOT NULL AND p.page_seq >= c.cutoff_zero_run) THEN 0
       ELSE coalesce(arg_max(p."offset" + p.n_rows, p.page_seq), 0) END AS BIGINT) AS resume_offset,
       bool_or(c.cutoff_zero_run IS NOT NULL AND p.page_seq >= c.cutoff_zero_run) AS done
FROM plog p JOIN cutoffs c ON p.scope = c.scope GROUP BY p.scope""", "plog", "cutoffs"))
def q_resume_offsets(spark, d):
    log = _event_log(spark, d)
    cut = I.zero_yield_cutoff(log, n_zero=10)
    progress = log.join(cut.select("scope", "cutoff_zero_run"), "scope").select(
        "scope", F.col("page_seq").alias("seq"), (F.col("offset") + F.col("n_rows")).alias("offset"),
        F.coalesce(F.col("page_seq") >= F.col("cutoff_zero_run"), F.lit(False)).alias("done"))
    return I.resume_offsets(progress)


@register("error_bursts", O.sql("""
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
         RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n_in_window,
       count(*) OVER (PARTITION BY user_id ORDER BY ts
         RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) >= 3 AS burst
FROM events WHERE event_type = 'error'"""))
def q_error_bursts(spark, d):
    e = B.events(spark, d, "event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "error")
    return I.error_bursts(e, "user_id", "ts", span_seconds=86_400, threshold=3)


@register("error_runs", O.sql("""
SELECT user_id, CAST(max(run) AS BIGINT) AS longest_run FROM (
  SELECT user_id, grp, count(*) AS run FROM (
    SELECT user_id, event_type, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
    FROM events) WHERE event_type = 'error' GROUP BY user_id, grp) GROUP BY user_id"""))
def q_error_runs(spark, d):
    e = B.events(spark, d, "event_id", "ts", "user_id", "event_type")
    return I.failure_runs(e, "user_id", ["ts", "event_id"], F.col("event_type") == "error")


_NOW = "2024-01-31 00:00:00"


@register("ttl_latest", O.sql(f"""
SELECT user_id, w.payload AS payload, strftime(w.created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
       CAST(epoch(TIMESTAMP '{_NOW}') AS BIGINT) - CAST(floor(epoch(w.created_at)) AS BIGINT) AS age_s
FROM (SELECT user_id, first({{'payload': props, 'created_at': ts}} ORDER BY ts DESC, event_id DESC) AS w
      FROM events GROUP BY user_id)
WHERE CAST(epoch(TIMESTAMP '{_NOW}') AS BIGINT) - CAST(floor(epoch(w.created_at)) AS BIGINT) <= 259200
  AND try(json_extract(w.payload, '$')) IS NOT NULL"""))
def q_ttl_latest(spark, d):
    e = B.events(spark, d, "event_id", "ts", "user_id", "props")
    r = I.ttl_latest(e, "user_id", "props", "ts", 3 * 86_400, F.lit(_NOW).cast("timestamp"), order=["ts", "event_id"])
    return r.select("user_id", "payload", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
                    "age_s")


# --- payloads ---------------------------------------------------------------------------


@register("payload_leaderboard", O.sql("""
SELECT month_key, channel_id, rank, average_viewers, hours_watched * 60.0 / 60.0 AS hours_watched,
       hours_streamed * 60.0 / 60.0 AS hours_streamed, peak_viewers, language FROM live WHERE channel_id > 0""",
    "live"))
def q_payload_leaderboard(spark, d):
    rows = PL.read_leaderboard(PL.land_leaderboard_pages(B.live_rows(spark, d)))
    return rows.select("month_key", "channel_id", "rank", "average_viewers", "hours_watched", "hours_streamed",
                       "peak_viewers", "language")


@register("leaderboard_pages_union", O.sql("""
SELECT month_key, count(DISTINCT page_seq) AS pages, count(*) AS rows, count(DISTINCT channel_id) AS channels
FROM live WHERE channel_id > 0 GROUP BY month_key""", "live"))
def q_leaderboard_pages_union(spark, d):
    rows = PL.read_leaderboard(PL.land_leaderboard_pages(B.live_rows(spark, d)))
    return rows.groupBy("month_key").agg(F.count_distinct("page_seq").alias("pages"), F.count(F.lit(1)).alias("rows"),
                                         F.count_distinct("channel_id").alias("channels"))


@register("payload_games", O.sql("""
SELECT channel_id, month_key, pos, game, round(hours * 60.0 / 60.0, 2) AS hours, peak_viewers, avg_viewers,
       view_minutes FROM games""", "games"))
def q_payload_games(spark, d):
    g = PL.read_games(PL.land_games_pages(B.games_rows(spark, d), B.GAMES_PAGE_SIZE))
    return g.select("channel_id", "month_key", (F.col("page") * B.GAMES_PAGE_SIZE + F.col("idx")).alias("pos"),
                    "game", "hours", "peak_viewers", "avg_viewers", "view_minutes")


@register("payload_games_ingest", O.sql("""
SELECT channel_id, month_key, pos, game, round(hours * 60.0 / 60.0, 2) AS hours,
       CAST(trunc(avg_viewers) AS BIGINT) AS avg_viewers, peak_viewers,
       round(view_minutes / 60.0, 2) AS hours_watched FROM games""", "games"))
def q_payload_games_ingest(spark, d):
    g = PL.read_games_ingest(PL.land_games_pages(B.games_rows(spark, d), B.GAMES_PAGE_SIZE))
    return g.select("channel_id", "month_key", (F.col("page") * B.GAMES_PAGE_SIZE + F.col("idx")).alias("pos"),
                    "game", "hours", "avg_viewers", "peak_viewers", "hours_watched")


def _landed_games_pages(spark, d):
    """Games pages with the time they land: the view minutes of their games after the month's start. First pages land once
    more, a day later."""
    g = B.games_rows(spark, d)
    pages = PL.land_games_pages(g, B.GAMES_PAGE_SIZE)
    minutes = g.groupBy("channel_id", "month_key", F.floor((F.col("pos") - 1) / B.GAMES_PAGE_SIZE).cast("bigint").alias("page")).agg(
        F.sum(F.floor("view_minutes")).cast("bigint").alias("landed_at"))
    pages = pages.join(minutes, ["channel_id", "month_key", "page"])
    return pages.unionByName(pages.where("page = 0").withColumn("landed_at", F.col("landed_at") + 1440))


# a month's pages are looked at when its average channel has landed
O.CTES["game_pages"] = """
SELECT channel_id, month_key, (pos - 1) // 10 AS page, count(*) AS n, CAST(sum(CAST(floor(view_minutes) AS BIGINT)) AS BIGINT) AS landed_at
FROM games GROUP BY 1, 2, 3"""
O.CTES["game_totals"] = "SELECT channel_id, month_key, count(*) AS total FROM games GROUP BY 1, 2"
_AS_OF = 400_000


@register("games_pages_complete", O.sql(f"""
SELECT p.channel_id, p.month_key, count(*) AS pages, CAST(sum(n) AS BIGINT) AS rows, max(total) AS records_total, sum(n) >= max(total) AS complete
FROM game_pages p JOIN game_totals t ON t.channel_id = p.channel_id AND t.month_key = p.month_key
WHERE landed_at <= {_AS_OF} GROUP BY 1, 2""", "game_pages", "game_totals"))
def q_games_pages_complete(spark, d):
    """As of a time: pages that land later are not there yet. First pages land twice."""
    return PL.games_pages_complete(_landed_games_pages(spark, d).where(F.col("landed_at") <= _AS_OF))


@register("games_page_gaps", O.sql(f"""
SELECT e.channel_id, e.month_key, min(e.page) AS first_missing, max(e.page) AS last_missing
FROM (SELECT x.channel_id, x.month_key, x.page, x.page - row_number() OVER (PARTITION BY x.channel_id, x.month_key ORDER BY x.page) AS island
      FROM (SELECT t.channel_id, t.month_key, unnest(generate_series(0, (t.total - 1) // 10)) AS page FROM game_totals t
            WHERE EXISTS (SELECT 1 FROM game_pages p WHERE p.channel_id = t.channel_id AND p.month_key = t.month_key AND p.landed_at <= {_AS_OF})) x
      WHERE NOT EXISTS (SELECT 1 FROM game_pages p WHERE p.channel_id = x.channel_id AND p.month_key = x.month_key AND p.page = x.page
                        AND p.landed_at <= {_AS_OF})) e
GROUP BY e.channel_id, e.month_key, e.island""", "game_pages", "game_totals"))
def q_games_page_gaps(spark, d):
    return PL.games_page_gaps(_landed_games_pages(spark, d).where(F.col("landed_at") <= _AS_OF), B.GAMES_PAGE_SIZE)


@register("pie_top5_other", O.sql("""
SELECT channel_id, month_key, CAST(rn AS BIGINT) AS slot, game AS label, round(hours / 4.0, 2) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, month_key ORDER BY hours DESC, game) AS rn FROM games)
WHERE rn <= 5
UNION ALL
SELECT channel_id, month_key, CAST(6 AS BIGINT), 'Other', round(CAST(sum(CAST(hours / 4.0 AS DECIMAL(38,6))) AS DOUBLE), 2)
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, month_key ORDER BY hours DESC, game) AS rn FROM games)
WHERE rn > 5 GROUP BY 1, 2 HAVING sum(hours) <> 0""", "games"))
def q_pie_top5_other(spark, d):
    tops = PL.read_pie_tops(PL.land_pies(B.games_rows(spark, d, with_pos=False)))
    return tops.select("channel_id", "month_key", F.posexplode("top").alias("p", "t")).select(
        "channel_id", "month_key", (F.col("p") + 1).cast("bigint").alias("slot"), "t.label", "t.value")


def _channel_payloads(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    seg = F.col("c_mktsegment")
    keep_nulls = {"ignoreNullFields": "false"}
    p = (F.when(seg == "AUTOMOBILE", F.to_json(F.struct(F.struct(
            F.col("c_acctbal").alias("avgViewers"), F.col("c_custkey").cast("string").alias("followerCount"),
            F.col("c_custkey").alias("avgViewerRank"), F.col("c_nationkey").alias("peak_viewer_rank"))
            .alias("result"))))
         .when(seg == "BUILDING", F.to_json(F.array(F.struct(
            F.col("c_acctbal").alias("avg_viewers"), F.col("c_custkey").alias("followers"),
            F.col("c_nationkey").cast("string").alias("lang"), F.lit(True).alias("mature"),
            F.lit(1).alias("isVarietyStreamer"), F.col("c_nationkey").alias("follower_gain_rank")))))
         .when(seg == "FURNITURE", F.to_json(F.struct(F.struct(
            F.lit(None).cast("double").alias("average_viewers"), F.col("c_acctbal").alias("avg_viewers"),
            F.col("c_name").alias("language")).alias("data")), keep_nulls))
         .when(seg == "MACHINERY", F.to_json(F.array(F.struct(F.col("c_acctbal").alias("avg_viewers")),
                                                     F.struct(F.col("c_acctbal").alias("avg_viewers")))))
         # no leaderboard metric at all: the game fields alone make a row
         .when(F.col("c_custkey") % 2 == 0, F.to_json(F.struct(
            F.col("c_name").alias("topGame"), F.col("c_acctbal").alias("top_game_hours"),
            F.lit(12.5).alias("topGamePct"), F.col("c_nationkey").alias("gameCount"),
            F.col("c_custkey").alias("followerRank"))))
         .otherwise(F.to_json(F.struct(F.col("c_acctbal").alias("hours_watched"),
                                       F.col("c_custkey").alias("new_followers")))))
    return c.select(F.col("c_custkey").alias("channel_id"), p.alias("payload"))


@register("payload_channel", O.sql("""
SELECT c_custkey AS channel_id,
       CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING') THEN c_acctbal END AS average_viewers,
       CASE WHEN seg = 'HOUSEHOLD' THEN c_acctbal END AS hours_watched,
       CAST(NULL AS DOUBLE) AS hours_streamed,
       CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING') THEN c_custkey END AS followers,
       CASE WHEN seg = 'HOUSEHOLD' THEN c_custkey END AS followers_gained,
       CAST(NULL AS BIGINT) AS peak_viewers,
       CASE WHEN seg = 'GAMES' THEN c_name END AS top_game,
       CASE WHEN seg = 'GAMES' THEN c_acctbal END AS top_game_hours,
       CASE WHEN seg = 'GAMES' THEN CAST(12.5 AS DOUBLE) END AS top_game_pct,
       CASE WHEN seg = 'GAMES' THEN CAST(c_nationkey AS BIGINT) END AS game_count,
       CASE WHEN seg = 'BUILDING' THEN CAST(1 AS BIGINT) END AS is_variety_streamer,
       CASE WHEN seg = 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) WHEN seg = 'FURNITURE' THEN c_name END AS language,
       CAST(NULL AS VARCHAR) AS created,
       CASE WHEN seg = 'BUILDING' THEN 'true' END AS mature,
       CASE WHEN seg = 'AUTOMOBILE' THEN CAST(c_nationkey AS BIGINT) END AS peak_viewer_rank,
       CASE WHEN seg = 'AUTOMOBILE' THEN c_custkey END AS avg_viewer_rank,
       CASE WHEN seg = 'GAMES' THEN c_custkey END AS follower_rank,
       CASE WHEN seg = 'BUILDING' THEN CAST(c_nationkey AS BIGINT) END AS follower_gain_rank
FROM (SELECT *, CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0 THEN 'GAMES' ELSE c_mktsegment END AS seg
      FROM customer)
WHERE seg <> 'MACHINERY'"""))
def q_payload_channel(spark, d):
    return PL.read_channel(_channel_payloads(spark, d))


@register("payload_users", O.sql("SELECT login, created_at FROM users", "users"))
def q_payload_users(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name").select(
        "c_name", F.floor(F.col("c_custkey") / 100).alias("batch_id"))
    u = B.users(spark, d).join(c, F.lower(c.c_name) == F.col("login")).select(
        "batch_id", F.col("c_name").alias("login"), "created_at")
    return PL.read_users(PL.land_users(u))


def _games_texts(spark, d):
    """One games text per channel and month, its form by the month: JSON lists of objects or arrays, JSON in a
    ``rows`` wrapper, and Python literals: lists of tuples, of dicts, and a wrapper of tuples."""
    g = B.games_rows(spark, d)
    values = ("game", "hours", "peak_viewers", "avg_viewers", "view_minutes")
    forms = {
        "array": F.format_string('["%s",%s,%s,%s,%s]', *values),
        "object": F.to_json(F.struct("game", "hours", "avg_viewers")),
        "tuple": F.format_string("('%s', %s, %s, %s, None, True,)", *values[:4]),
        "dict": F.format_string("""{'title': None, 'game': "%s", u'hours': %s, 'avg_viewers': %s, 'live': False,}""",
                                "game", "hours", "avg_viewers"),
    }
    lists = g.groupBy("channel_id", "month_key", "month_order").agg(
        F.array_sort(F.collect_list(F.struct("pos", *[v.alias(k) for k, v in forms.items()]))).alias("items"))

    def joined(form, before="[", after="]"):
        return F.concat(F.lit(before), F.array_join(F.transform("items", lambda x: x[form]), ", "), F.lit(after))
    kind = F.col("month_order") % 6
    text = (F.when(kind == 0, joined("tuple", after=",]")).when(kind == 1, joined("array", '{"rows":[', "]}"))
            .when(kind == 2, joined("object")).when(kind == 3, joined("array")).when(kind == 4, joined("dict"))
            .otherwise(joined("tuple", "{'rows': [], 'data': [  # of one month\n", "],}")))
    return lists.select("channel_id", "month_key", "month_order", text.alias("games_text"))


@register("games_parse", O.sql("SELECT channel_id, month_key, pos, game, hours, avg_viewers FROM games", "games"))
def q_games_parse(spark, d):
    return PL.parse_games_text(_games_texts(spark, d), "games_text", ["channel_id", "month_key"])


@register("games_text_forms", O.sql("""
SELECT month_order, CASE WHEN month_order = 12 THEN 'unparsed' WHEN month_order = 9 THEN 'blank' WHEN month_order = 8 THEN 'not_list'
                         WHEN month_order % 6 IN (1, 2, 3) THEN 'json' ELSE 'literal' END AS form, count(*) AS texts
FROM (SELECT DISTINCT channel_id, month_key, month_order FROM games) GROUP BY 1, 2""", "games"))
def q_games_text_forms(spark, d):
    """December's texts are cut off before their end, September's are blank, August's lists are tuples."""
    t, mo = F.col("games_text"), F.col("month_order")
    broken = (F.when(mo == 12, F.substring(t, 1, F.length(t) - 3)).when(mo == 9, F.lit(" \n"))
              .when(mo == 8, F.concat(F.lit("{'rows': ("), t, F.lit(", None)}"))).otherwise(t))
    return PL.games_text_forms(_games_texts(spark, d).withColumn("games_text", broken), "games_text", ["month_order"])


@register("games_json_roundtrip", O.sql("""
SELECT channel_id, month_key, pos, game, round(coalesce(hours, 0.0), 2) AS hours,
       coalesce(peak_viewers, 0) AS peak_viewers, coalesce(avg_viewers, 0.0) AS avg_viewers,
       coalesce(view_minutes, 0.0) AS view_minutes FROM games""", "games"))
def q_games_json_roundtrip(spark, d):
    a = G.games_agg(B.games_rows(spark, d), with_lists=True)
    sch = a.schema["all_games"].dataType.simpleString()
    txt = a.select("channel_id", "month_key", F.to_json("all_games").alias("all_games_json"))
    back = txt.select("channel_id", "month_key", F.from_json("all_games_json", sch).alias("g"))
    return G.explode_list(back, "g", ["channel_id", "month_key"])


# --- sinks and report ------------------------------------------------------------


@register("write_read_partitioned", O.sql("SELECT channel_id, month_key, rank, status FROM panel", "panel"))
def q_write_read_partitioned(spark, d):
    path = SK.scratch_path(spark, "panel-parquet")
    panel = P.landed_panel(spark, d).select("channel_id", "month_key", "year", "month_order", "rank", "status")
    for _ in range(2):  # a rerun replaces partitions instead of adding rows
        SK.write_partitioned(panel, path, "month_key", ["channel_id"])
    return spark.read.parquet(path).select("channel_id", "month_key", "rank", "status")


@register("incremental_run", O.sql("SELECT * FROM panel", "panel"))
def q_incremental_run(spark, d):
    """Two landings, a run after each: finished orders first, then all others, which come late for months
    that are written already."""
    landed, path = SK.scratch_path(spark, "landed"), SK.scratch_path(spark, "panel-incremental")
    table(spark, d, "customer").write.parquet(f"{landed}/customer.parquet")
    orders = table(spark, d, "orders")
    finished = F.col("o_orderstatus") == "F"
    for part in (orders.where(finished), orders.where(~finished | F.col("o_orderstatus").isNull())):
        part.write.mode("append").parquet(f"{landed}/orders.parquet")
        back = P.incremental_run(spark, landed, path, months_per_run=24)
    return back.select(*M.PANEL_COLUMNS)


def _unpivot(section: str, key: str, source: str, *values: str) -> str:
    names = ", ".join(f"'{v}'" for v in values)
    cast = ", ".join(f"CAST({v} AS DOUBLE)" for v in values)
    return (f"SELECT '{section}' AS section, CAST({key} AS VARCHAR) AS key, unnest([{names}]) AS item, "
            f"unnest([{cast}]) AS value FROM ({source})")


_OVERVIEW_SQL = f"""SELECT count(*) AS total_rows, count(DISTINCT channel_id) AS unique_channels, 31 AS columns_seen,
  count(rank) AS rows_with_rank, count(*) FILTER (WHERE {_ANY_METRIC}) AS rows_with_any_metric,
  count(*) FILTER (WHERE {_ACTIVE}) AS active_rows, count(*) - count(*) FILTER (WHERE {_ACTIVE}) AS inactive_rows,
  count(*) FILTER (WHERE status = 'active_top500') AS top500_rows FROM enriched"""
_REPORT_LONG = "\nUNION ALL\n".join([
    _unpivot("overview", "'panel'", _OVERVIEW_SQL, "total_rows", "unique_channels", "columns_seen", "rows_with_rank",
             "rows_with_any_metric", "active_rows", "inactive_rows", "top500_rows"),
    _unpivot("status", "status", SQL["status_distribution"].split("\n)\n")[-1], "count"),
    _unpivot("missing", '"column"', _MISS_SQL, "missing", "missing_pct"),
    _unpivot("monthly", "month_key", SQL["monthly_summary"].split("\n)\n")[-1], "rows", "rank_coverage",
             "panel_coverage", "avg_viewers_mean", "hours_watched_mean"),
    _unpivot("created_year", "created_year", SQL["created_cohorts"].split("\n)\n")[-1], "count"),
    *[_unpivot(f"top_channels_by_{m}", "channel_id",
               f"SELECT * FROM channel_stats ORDER BY {m} DESC NULLS LAST, channel_id LIMIT 20", m)
      for m in ("avg_viewers", "hours_watched")],
    _unpivot("top_games_by_hours", "game", "SELECT * FROM game_stats ORDER BY total_hours DESC, game LIMIT 20",
             "mentions", "total_hours", "avg_viewers_mean"),
])


@register("report_long", O.sql(_REPORT_LONG, "enriched", "channel_stats", "game_stats"))
def q_report_long(spark, d):
    """The enriched panel is computed once, into the cells that all sections read."""
    return RP.report_long(P.enriched_panel(spark, d, lists=("all_games",)))


# --- reading and building facts -------------------------------------------------------


@register("read_fact", O.sql("""
SELECT channel_id, year, month, month_key, month_order, rank_position, average_viewers, hours_watched, followers,
       followers_gained, peak_viewers, language, mature, created, 'c-' || channel_id AS channel_slug,
       '' AS display_name, row_number() OVER (PARTITION BY channel_id, month_key ORDER BY row_seq) AS place
FROM seed""", "seed"))
def q_read_fact(spark, d):
    """Seed rows written as CSV (one folder per landing) and read back."""
    root = SK.scratch_path(spark, "seed-csv")
    seed = B.seed_rows(spark, d).withColumn(
        "channel_slug", F.concat(F.lit("C-"), F.col("channel_id").cast("string")))
    text = SH.ensure_columns(seed, {c: (None, "string") for c in SH.SEED_REQUIRED})
    for landing in (0, 1):
        SK.write_csv(text.where(F.col("row_seq") == landing).select(*SH.SEED_REQUIRED), f"{root}/{landing}")
    back = SH.read_fact_csv(spark, f"{root}/*")
    place = F.row_number().over(Window.partitionBy("channel_id", "month_key").orderBy("row_seq"))
    return back.select("channel_id", "year", "month", "month_key", "month_order", "rank_position", "average_viewers",
                       "hours_watched", "followers", "followers_gained", "peak_viewers", "language", "mature",
                       "created", "channel_slug", "display_name", place.cast("bigint").alias("place"))


@register("monthly_leaderboard", O.sql("""
SELECT channel_id, month_key, row_number() OVER (PARTITION BY month_key ORDER BY average_viewers DESC NULLS LAST,
       channel_id) AS position FROM panel""", "panel"))
def q_monthly_leaderboard(spark, d):
    panel = P.landed_panel(spark, d).select("channel_id", "month_key", "average_viewers")
    return R.monthly_leaderboard(panel, "average_viewers", ["month_key"], rank_col="position").drop("average_viewers")


@register("add_games", O.sql("""
SELECT l.channel_id, l.year, l.month, l.month_key, c.channel_name AS channel_slug, c.display_name,
       l.rank AS rank_position, l.average_viewers, l.peak_viewers, round(l.hours_streamed, 2) AS hours_streamed,
       round(l.hours_watched, 2) AS hours_watched, l.language, u.created_at AS created,
       coalesce(t.labels, '') AS top_labels, coalesce(t.games, '') AS games
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, month_key ORDER BY page_seq, row_pos) AS rn FROM live) l
JOIN channels c ON l.channel_id = c.channel_id
LEFT JOIN users_k u ON c.channel_name = u.login
LEFT JOIN (SELECT channel_id, month_key,
                  string_agg(game, ',' ORDER BY by_hours) FILTER (WHERE by_hours <= 5)
                    || CASE WHEN sum(hours) FILTER (WHERE by_hours > 5) <> 0 THEN ',Other' ELSE '' END AS labels,
                  string_agg(game, ',' ORDER BY pos) AS games
           FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, month_key ORDER BY hours DESC, game) AS by_hours
                 FROM games) GROUP BY 1, 2) t
  ON l.channel_id = t.channel_id AND l.month_key = t.month_key
WHERE l.rn = 1 AND l.channel_id > 0""", "live", "channels", "users_k", "games"))
def q_add_games(spark, d):
    """Fact table of landed leaderboard pages, pies, users and games pages."""
    games = B.games_rows(spark, d)
    fact = P.build_fact(PL.land_leaderboard_pages(_named_live(spark, d)), pies_by_time=PL.land_pies(games), users=B.users(spark, d))
    out = P.add_games(fact, PL.land_games_pages(games, B.GAMES_PAGE_SIZE))

    def listed(col, field):
        items = F.from_json(col, f"array<struct<{field}:string>>")
        return F.array_join(F.transform(items, lambda x: x[field]), ",")
    return out.select("channel_id", "year", "month", "month_key", "channel_slug", "display_name", "rank_position",
                      "average_viewers", "peak_viewers", "hours_streamed", "hours_watched", "language", "created",
                      listed("top5_games_by_stream_time_json", "label").alias("top_labels"),
                      listed("all_games_json", "game").alias("games"))


# --- streaming ----------------------------------------------------------------------


def _landed_stream(spark, name, runs, run):
    """Files that land one after another, with a run of the stream after each group of them: later runs start from the
    checkpoint."""
    src, out, ckpt = (SK.scratch_path(spark, f"{name}-{x}") for x in ("src", "out", "ckpt"))
    for landings in runs:
        for rows in landings:
            rows.write.mode("append").parquet(src)
        found = run(src, out, ckpt)
    return found


@register("stream_enrich", O.sql("""
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""))
def q_stream_enrich(spark, d):
    cust = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").withColumnRenamed("c_custkey", "o_custkey")

    def run(src, out, ckpt):
        s = ST.file_stream(spark, src, max_files=1).select("o_orderkey", "o_custkey")
        return ST.stream_enrich(s, cust, ["o_custkey"], keys=["o_orderkey"], out=out, checkpoint=ckpt)
    orders = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    # open orders land a second time, after the restart
    return _landed_stream(spark, "enrich", [[orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus = 'F'")],
                                            [orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus NOT IN ('O', 'F')")]], run)


@register("stream_status_counts", O.sql("""
SELECT trim(coalesce(status, 'UNKNOWN')) AS status, count(*) AS count FROM enriched GROUP BY 1""", "enriched"))
def q_stream_status_counts(spark, d):
    path = SK.scratch_path(spark, "enriched-panel")
    SK.write_partitioned(P.enriched_panel(spark, d).select("channel_id", "month_key", "status"), path, "month_key")
    s = ST.file_stream(spark, path, max_files=16)
    st = S.py_strip(F.coalesce(F.col("status"), F.lit("UNKNOWN")))
    return ST.stream_counts(s, [st.alias("status")], "stream_status_counts")


@register("stream_monthly", O.sql("""
SELECT strftime(date_trunc('month', o_orderdate), '%Y') || lower(strftime(date_trunc('month', o_orderdate), '%B'))
         AS month_key, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1"""))
def q_stream_monthly(spark, d):
    mk = S.month_key_of(F.trunc(F.to_date("o_orderdate"), "month"))

    def run(src, out, ckpt):
        return ST.stream_counts(ST.file_stream(spark, src, max_files=1), [mk.alias("month_key")], "stream_monthly", [
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")], out=out, checkpoint=ckpt, compact_every=2)
    orders = table(spark, d, "orders", "o_orderdate", "o_totalprice", "o_orderstatus")
    parts = [orders.where(f"o_orderstatus = '{x}'") for x in "FO"] + [orders.where("o_orderstatus NOT IN ('O', 'F')")]
    return _landed_stream(spark, "monthly", [parts[:2], parts[2:]], run)


@register("stream_dedupe", O.sql("""
SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day FROM events"""))
def q_stream_dedupe(spark, d):
    def run(src, out, ckpt):
        return ST.stream_dedupe(ST.file_stream(spark, src, max_files=1), ["user_id", "day"], out=out, checkpoint=ckpt, compact_every=2)
    e = B.events(spark, d, "user_id", "ts", "event_type").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    first, others = F.col("event_type").isin("view", "click"), ~F.col("event_type").isin("view", "click", "error")
    parts = [e.where(c).select("user_id", "day", "event_type") for c in (first, F.col("event_type") == "error", others | F.col("event_type").isNull())]
    return _landed_stream(spark, "dedupe", [parts[:1], parts[1:]], run).select("user_id", "day")


@register("stream_error_bursts", O.sql("""
SELECT user_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM (SELECT user_id, date_trunc('hour', ts) - to_hours(k) AS ws
      FROM events, range(0, 24) r(k) WHERE event_type = 'error')
GROUP BY 1, 2 HAVING count(*) >= 3"""))
def q_stream_error_bursts(spark, d):
    s = ST.file_stream(spark, f"{d}/events.parquet").where(F.col("event_type") == "error").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"))
    r = ST.stream_window_counts(s, "user_id", "ts", "1 day", "1 hour", "1 day", 3)
    return r.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


_DAY = 86_400


@register("stream_error_bursts_exact", O.sql("""
SELECT event_id, user_id, count(*) OVER w AS n_in_window, count(*) OVER w >= 3 AS burst,
       ts < (SELECT max(ts) FROM events WHERE event_type = 'error') - INTERVAL 6 DAY AS settled
FROM events WHERE event_type = 'error'
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)"""))
def q_stream_error_bursts_exact(spark, d):
    """Every error lands up to a day late, with those that arrive in the same five days; the stream is started again
    halfway."""
    e = B.events(spark, d, "event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "error")
    arrival = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(_DAY))
    e = e.select("event_id", "user_id", "ts", F.floor(arrival / (5 * _DAY)).alias("landing"))
    lo, hi = e.agg(F.min("landing"), F.max("landing")).first()  # a few landings
    lands = [e.where(F.col("landing") == k).select("event_id", "user_id", "ts") for k in range(lo, hi + 1)] if lo is not None else [e.drop("landing")]

    def run(src, out, ckpt):
        return ST.stream_bursts(ST.file_stream(spark, src, max_files=1), "user_id", "ts", "event_id", delay_seconds=6 * _DAY,
                                span_seconds=_DAY, threshold=3, out=out, checkpoint=ckpt)
    return _landed_stream(spark, "bursts", [lands[:3], lands[3:]] if len(lands) > 3 else [lands], run)
