"""Schema shaping on the DataFrame's schema (no job needed for the checks)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

log = logging.getLogger(__name__)

# Column order of the final fact table (fixed values).
FINAL_COLUMNS = [
    "year", "month", "channel_id", "channel_slug", "display_name",
    "rank_position", "followers", "followers_gained", "average_viewers", "peak_viewers",
    "hours_streamed", "hours_watched", "status", "mature", "language", "created",
    "peak_viewer_rank", "avg_viewer_rank", "follower_rank", "follower_gain_rank",
    "top5_games_by_avg_viewers_json", "top5_games_by_stream_time_json", "all_games_json",
]
# Default list of columns removed by the drop step (fixed values; the sixth
# name does not match the real rank column, so that one is never dropped).
DROP_COLUMNS = [
    "top_game", "top_game_hours", "top_game_pct", "game_count", "is_variety_streamer",
    "peak_view_rank", "avg_viewer_rank", "follower_rank", "follower_gain_rank",
]
# Required columns of the seed fact table (fixed values).
SEED_REQUIRED = [
    "year", "month", "channel_id", "channel_slug", "display_name", "rank_position",
    "followers", "followers_gained", "average_viewers", "peak_viewers",
    "hours_streamed", "hours_watched", "status", "mature", "language", "created",
    "peak_viewer_rank", "avg_viewer_rank", "follower_rank", "follower_gain_rank",
    "games_by_avg_viewers_json", "games_by_stream_time_json", "all_games_json",
    "top_game", "top_game_hours", "top_game_pct", "game_count", "is_variety_streamer",
]
INT_COLUMNS = ["channel_id", "year", "month_order", "rank", "rank_position", "followers", "followers_gained",
               "peak_viewers", "game_count", "peak_viewer_rank", "avg_viewer_rank", "follower_rank",
               "follower_gain_rank"]
BOOL_COLUMNS = ["mature", "is_variety_streamer"]
FLOAT_COLUMNS = ["average_viewers", "hours_watched", "hours_streamed", "top_game_hours", "top_game_pct"]


def require_columns(df: DataFrame, required: list[str]) -> None:
    absent = sorted(set(required).difference(df.columns))
    if absent:
        raise ValueError(f"required columns absent: {', '.join(absent)}")


def final_projection(df: DataFrame, order: list[str] = FINAL_COLUMNS) -> DataFrame:
    """Fixed column order, keeping only the columns that exist."""
    return df.select(*[c for c in order if c in df.columns])


def drop_columns(df: DataFrame, columns: list[str] = DROP_COLUMNS) -> DataFrame:
    """Drop the listed columns; error when none exists, warn about the others."""
    existing = [c for c in columns if c in df.columns]
    if not existing:
        raise ValueError(f"none of the columns to drop exist: {columns}")
    absent = [c for c in columns if c not in df.columns]
    if absent:
        log.warning("columns not found, skipped: %s", absent)
    return df.drop(*existing)


def ensure_columns(df: DataFrame, defaults: dict[str, tuple[object, str]]) -> DataFrame:
    """Add missing columns as ``lit(default).cast(type)``; existing ones untouched."""
    add = {c: F.lit(v).cast(t) for c, (v, t) in defaults.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def coerce_types(df: DataFrame, strip_commas: bool = True) -> DataFrame:
    """Text columns -> final numeric types and flags (true/false, yes/no or a
    number); unparsable text -> null."""
    cols = {}
    for c in df.columns:
        if c in INT_COLUMNS:
            cols[c] = S.safe_int(F.col(c), strip_commas)
        elif c in FLOAT_COLUMNS:
            cols[c] = S.clean_number(F.col(c), strip_commas)
        elif c in BOOL_COLUMNS:
            cols[c] = S.flag(F.col(c))
    return df.withColumns(cols) if cols else df


def fill_defaults(df: DataFrame, text_defaults: dict[str, str] | None = None) -> DataFrame:
    """Missing display names and created dates -> '', status -> 'UNKNOWN'."""
    d = text_defaults or {"display_name": "", "created": "", "status": "UNKNOWN"}
    return df.fillna({k: v for k, v in d.items() if k in df.columns})


def read_fact_csv(spark, path: str, required: list[str] = SEED_REQUIRED, multi_line: bool = False) -> DataFrame:
    """Seed fact CSV: header, every column read as text (no inference), required
    columns checked on the header, ids cleaned (dropped when unparsable),
    numbers and flags typed, slug/name normalised, month_key derived.

    ``row_seq`` gives the landing order: file name, then place in the file.
    ``multi_line`` allows line breaks inside quoted fields; such a file cannot
    be split, so each is read by one task."""
    header = spark.read.option("header", True).csv(path).columns
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType()) for c in header])
    raw = (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
           .option("escape", '"').csv(path))
    require_columns(raw, required)
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"))
    df = coerce_types(raw.withColumn("row_seq", order), strip_commas=False)
    df = df.where(F.col("channel_id").isNotNull())
    return df.withColumns({
        "channel_slug": S.slug_norm("channel_slug"),
        "display_name": F.coalesce(F.col("display_name"), F.lit("")),
        "month": S.normalize_month("month"),
        "month_key": S.month_key(F.col("year"), F.col("month")),
        "month_order": S.month_number(F.col("month")),
    })
