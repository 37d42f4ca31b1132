"""Lookups written back onto the panel: created dates, slug fallbacks, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

SLUG_SOURCES = ("channel_slug", "channel_name", "display_name")


def status_filter(panel: DataFrame, statuses: list[str]) -> DataFrame:
    return panel.where(F.col("status").isin(*statuses))


def slug_column(df: DataFrame, host_pattern: str | None = None):
    """Login slug from the first existing column of channel_slug, channel_name,
    display_name (chosen on the schema, no job)."""
    for c in SLUG_SOURCES:
        if c in df.columns:
            return S.slug_norm_url(c, host_pattern) if host_pattern else S.slug_norm(c)
    raise ValueError(f"none of {SLUG_SOURCES} present")


def created_missing(df: DataFrame) -> DataFrame:
    return df.where(S.blank(F.col("created")))


def distinct_logins(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Distinct non-blank logins (of rows missing created, by default)."""
    src = created_missing(df) if only_missing else df
    return src.select(slug_column(df).alias("login")).where(F.col("login") != "").distinct()


def enrich_created(panel: DataFrame, users: DataFrame) -> DataFrame:
    """Fill blank ``created`` from a (login, created_at) lookup by login.

    The lookup is reduced to distinct logins with one value each (newest
    non-blank wins on duplicates) before the join, so the join is 1:1 on the
    panel side and never multiplies rows. Blank text counts as missing too.
    Rows that need nothing or have no login take part under a spread value that no login
    has, so they do not meet in one task.
    """
    return fill_created(attach_created(panel, users))


def attach_created(rows: DataFrame, users: DataFrame, only_blank: bool = True) -> DataFrame:
    """``rows`` with the date found for their login as ``_created_at``: the join of :func:`enrich_created`. Where the login
    is the channel's, it is done on the channels (without ``only_blank``, as they have no date yet), before the scaffold is
    made from them: a row per channel is shuffled by its login, instead of one per channel and month."""
    u = (users.where(F.col("login").isNotNull() & (F.col("login") != "") & ~S.blank(F.col("created_at")))
              .groupBy(F.lower(F.col("login")).alias("_login"))
              .agg(F.max("created_at").alias("_created_at")))
    login = slug_column(rows)
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("array", "struct", "map", "variant")]
    nothing = F.concat(F.lit("\0"), F.xxhash64(*[F.col(c) for c in plain]).cast("string"))
    needs = (S.blank(F.col("created")) & (login != "")) if only_blank else login != ""
    return rows.withColumn("_login", F.when(needs, login).otherwise(nothing)).join(u, "_login", "left").drop("_login")


def fill_created(panel: DataFrame) -> DataFrame:
    """Blank ``created`` from ``_created_at`` (see :func:`attach_created`)."""
    found = F.when(S.blank(F.col("created")) & F.col("_created_at").isNotNull(), F.col("_created_at")).otherwise(F.col("created"))
    return panel.withColumn("created", found).drop("_created_at")


def slug_fallback_join(rows: DataFrame, lookup: DataFrame, value_cols: list[str],
                       slug_col: str = "channel_slug", name_col: str = "display_name",
                       fallback_on_miss: bool = True) -> DataFrame:
    """Look values up by normalised slug; where that fails, by slugified display name.

    ``lookup`` has a ``login`` column plus ``value_cols``, and may have a ``state`` (ok, empty or error) per login; without
    it a login is ok when any of its values is there, else empty. A login that is not in it is an error. Only an error
    goes on to the display name: an empty answer is an answer. Adds the values, ``outcome`` (ok, empty, error) and
    ``matched_by`` (slug, name, or null for an error)."""
    state = F.col("state") if "state" in lookup.columns else F.when(S.any_not_null(*value_cols), "ok").otherwise("empty")

    def side(name: str) -> DataFrame:
        return lookup.select(F.col("login").alias(f"_k{name}"), F.coalesce(state, F.lit("error")).alias(f"_s{name}"),
                             *[F.col(c).alias(f"_{name}_{c}") for c in value_cols])
    answered = F.coalesce(F.col("_sa") != "error", F.lit(False))
    j = rows.withColumn("_ka", S.slug_norm(slug_col)).join(side("a"), "_ka", "left")
    if fallback_on_miss:
        j = j.withColumn("_kb", F.when(~answered, S.slugify(name_col))).join(side("b"), "_kb", "left")
    else:
        j = j.withColumns({"_sb": F.lit(None).cast("string"), **{f"_b_{c}": F.lit(None).cast(lookup.schema[c].dataType) for c in value_cols}})
    by_name = F.coalesce(F.col("_sb") != "error", F.lit(False))
    out = {c: F.when(answered, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")) for c in value_cols}
    out["outcome"] = F.when(answered, F.col("_sa")).otherwise(F.coalesce("_sb", F.lit("error")))
    out["matched_by"] = F.when(answered, "slug").when(by_name, "name")
    j = j.withColumns(out)
    return j.drop(*[c for c in j.columns if c.startswith("_")])
