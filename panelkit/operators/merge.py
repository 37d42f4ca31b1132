"""Source precedence and the field-by-field merge into the panel.

Every source is first reduced to one row per (channel_id, month_key) with a
single hash aggregate (partial aggregation before the shuffle), so the joins
onto the scaffold are 1:1 and cannot multiply rows. The aggregates come out
hash-partitioned on the join keys, which the joins then reuse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

KEY = ["channel_id", "month_key"]
CARRIED = "_sources"  # the keyed sources on a scaffold that carries them

# Fixed names, in the order of the source data's columns.
SEED_METRICS = [
    "average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained",
    "peak_viewers", "top_game", "top_game_hours", "top_game_pct", "game_count",
    "is_variety_streamer", "language", "created", "mature",
    "peak_viewer_rank", "avg_viewer_rank", "follower_rank", "follower_gain_rank",
]
LIVE_METRICS = [
    "average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained",
    "peak_viewers", "language", "display_name", "channel_slug",
]
PANEL_COLUMNS = [
    "channel_id", "channel_name", "display_name", "year", "month", "month_key", "month_order",
    "rank", "average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained",
    "peak_viewers", "top_game", "top_game_hours", "top_game_pct", "game_count",
    "is_variety_streamer", "language", "created", "mature", "peak_viewer_rank",
    "avg_viewer_rank", "follower_rank", "follower_gain_rank", "status", "source",
]
_TYPES = {
    "average_viewers": "double", "hours_watched": "double", "hours_streamed": "double",
    "followers": "bigint", "followers_gained": "bigint", "peak_viewers": "bigint",
    "top_game": "string", "top_game_hours": "double", "top_game_pct": "double",
    "game_count": "bigint", "is_variety_streamer": "boolean", "language": "string",
    "created": "string", "mature": "boolean", "peak_viewer_rank": "bigint",
    "avg_viewer_rank": "bigint", "follower_rank": "bigint", "follower_gain_rank": "bigint",
    "display_name": "string", "channel_slug": "string",
}


def _with_all(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = {c: F.lit(None).cast(_TYPES[c]) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def last_per_key(seed: DataFrame, order_col: str = "row_seq") -> DataFrame:
    """Duplicate seed keys: the last row's metrics win whole; the last
    *positive* rank wins. One hash aggregate, no window."""
    seed = _with_all(seed, SEED_METRICS)
    pos = F.col("rank_position") > 0
    return seed.groupBy(*KEY).agg(
        F.max_by(F.struct(*SEED_METRICS), F.col(order_col)).alias("seed"),
        F.max_by(F.when(pos, F.col("rank_position")), F.when(pos, F.col(order_col))).alias("seed_rank"),
        F.count(F.lit(1)).alias("seed_rows"),
    )


def live_first_last(live: DataFrame) -> DataFrame:
    """Live rows: first-seen rank, last-seen metrics (whole dict) per key.

    Order is (page_seq, row_pos). Rows with no non-null field never win the
    metrics; ``live_has`` says whether any row had a value.
    """
    live = _with_all(live, LIVE_METRICS)
    order = F.struct("page_seq", "row_pos")
    has = S.any_not_null(*LIVE_METRICS)
    return live.groupBy(*KEY).agg(
        F.min_by("rank", order).alias("live_rank"),
        F.max_by(F.struct(*LIVE_METRICS), F.when(has, order)).alias("live"),
        F.bool_or(has).alias("live_has"),
    )


def keyed_sources(tagged: DataFrame) -> DataFrame:
    """Seed and live reduced per key in ONE hash/sort aggregate.

    ``tagged`` holds (channel_id, month_key, is_seed, is_live, seed_row,
    live_row); the result has the columns of :func:`last_per_key` and
    :func:`live_first_last` together, so the scaffold needs a single join.
    Seed fields absent from ``seed_row``'s schema are null.
    Same rules: last seed row wins whole, last positive seed rank wins, first
    live rank, last live row with a value wins whole.
    """
    sr, lr = F.col("seed_row"), F.col("live_row")
    present = set(tagged.schema["seed_row"].dataType.fieldNames())
    seed_struct = F.struct(*[(sr[f] if f in present else F.lit(None)).cast(_TYPES[f]).alias(f)
                             for f in SEED_METRICS])
    pos_rank = F.col("is_seed") & (sr["rank_position"] > 0)
    live_struct = F.struct(*[lr[f].alias(f) for f in LIVE_METRICS])
    order = F.struct(lr["page_seq"].alias("page_seq"), lr["row_pos"].alias("row_pos"))
    has = F.col("is_live") & S.any_not_null(*[lr[f] for f in LIVE_METRICS])
    cnt = F.count_if("is_seed")
    return tagged.groupBy(*KEY).agg(
        F.max_by(seed_struct, F.when(F.col("is_seed"), sr["row_seq"])).alias("seed"),
        F.max_by(F.when(pos_rank, sr["rank_position"]), F.when(pos_rank, sr["row_seq"])).alias("seed_rank"),
        F.when(cnt > 0, cnt).alias("seed_rows"),
        F.min_by(F.when(F.col("is_live"), lr["rank"]), F.when(F.col("is_live"), order)).alias("live_rank"),
        F.max_by(live_struct, F.when(has, order)).alias("live"),
        F.bool_or(has).alias("live_has"),
    )


def merge_sources(
    scaffold: DataFrame,
    seed_k: DataFrame | None,
    live_k: DataFrame | None,
    top_k: int = S.DEFAULT_TOP_K,
    active_rule: str = "row_present",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Attach seed and live values to the scaffold, field by field.

    * rank: seed's positive rank, else the first live rank (seed > live)
    * metrics: live non-null value, else seed value (live > seed), per field
    * source: 'leaderboard' when a live row had a value, 'csv' when a seed row exists
    * status: from presence of metrics (``active_rule`` 'row_present' as the
      seed row counts even with all-null metrics, or 'any_metric') and rank.
    * ``keep``: further columns of the scaffold, after PANEL_COLUMNS.

    A scaffold's rows are made by an ``explode``, which Spark's size estimate leaves out: a filter that makes
    the join an inner one would let it broadcast the whole scaffold. The hints keep the joins sorted merges.
    Without ``seed_k`` the scaffold's rows carry the columns of :func:`keyed_sources` already, as the struct CARRIED
    (:func:`scaffold.attach_months`), and nothing is joined.
    """
    j = scaffold.join(seed_k.hint("merge"), KEY, "left") if seed_k is not None else scaffold.select(
        *[c for c in scaffold.columns if c != CARRIED], f"{CARRIED}.*")
    if live_k is not None:
        j = j.join(live_k.hint("merge"), KEY, "left")
    live_has = F.coalesce(F.col("live_has"), F.lit(False))
    has_seed = F.col("seed_rows").isNotNull()
    out = {}
    for f in SEED_METRICS:
        seed_v = F.col(f"seed.{f}")
        if f in LIVE_METRICS:
            out[f] = F.coalesce(F.col(f"live.{f}"), seed_v)
        else:
            out[f] = seed_v
    rank = F.coalesce(F.col("seed_rank"), F.col("live_rank")).cast("bigint")
    metric_cols = [out[m] for m in S.METRIC_FIELDS]
    if active_rule == "row_present":
        has_metrics = has_seed | live_has
    elif active_rule == "any_metric":
        has_metrics = S.any_not_null(*metric_cols)
    else:
        raise ValueError(f"unknown active_rule {active_rule!r}")
    source = F.when(live_has, F.lit("leaderboard")).when(has_seed, F.lit("csv"))
    return j.select(
        "channel_id", "channel_name", "display_name", "year", "month", "month_key", "month_order",
        rank.alias("rank"),
        *[out[f].alias(f) for f in SEED_METRICS],
        S.panel_status(has_metrics, rank, top_k).alias("status"),
        source.alias("source"), *keep,
    ).select(*PANEL_COLUMNS, *keep)
