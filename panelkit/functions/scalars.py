"""Per-row helpers as Catalyst expressions (Column -> Column).

Every function here returns a plain ``Column`` built from
``pyspark.sql.functions``; nothing runs in Python per row, so the
expressions stay inside whole-stage codegen and push down where Spark can.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source data's conventions) -------------
# English month names, January..December, numbered 1..12.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
# Panel status labels.
STATUS_TOP = "active_top500"
STATUS_RANKED = "active_not_top500"
STATUS_UNRANKED = "active_unranked"
STATUS_INACTIVE = "inactive"
# Scan depth bands as [start, end) offsets, and the default top cut.
RANK_BANDS = [(0, 500), (500, 2_000), (2_000, 5_000), (5_000, 10_000), (10_000, 20_000)]
DEFAULT_TOP_K = 500
# The six leaderboard metrics that decide "has metrics".
METRIC_FIELDS = [
    "average_viewers", "hours_watched", "hours_streamed",
    "followers", "followers_gained", "peak_viewers",
]
# ---------------------------------------------------------------------------

# Number literal accepted by Python's float() for plain decimal text.
_NUMBER_RE = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ASCII whitespace removed by strip() (same set as the regex class \s).
WHITESPACE = " \t\n\r\x0b\x0c"


def py_strip(x) -> Column:
    """Python ``str.strip()`` on ASCII whitespace (not only spaces); a plain
    ``btrim`` with a character set, no regex per row."""
    return F.btrim(_c(x), F.lit(WHITESPACE))


def slug_norm(x) -> Column:
    """null -> '', strip, lower."""
    return F.lower(py_strip(F.coalesce(_c(x).cast("string"), F.lit(""))))


def slug_norm_url(x, host_pattern: str) -> Column:
    """Like :func:`slug_norm`, also removes ``http(s)://(www.)<host>/`` anywhere,
    strips '/' at both ends and removes all whitespace. ``host_pattern`` is a
    Java regex for the host (escape dots)."""
    s = slug_norm(x)
    s = F.regexp_replace(s, rf"https?://(www\.)?{host_pattern}/", "")
    s = F.regexp_replace(s, r"^/+|/+$", "")
    return F.regexp_replace(s, r"\s+", "")


def slugify(x) -> Column:
    """lower, drop whitespace, keep only [a-z0-9_]."""
    return F.regexp_replace(F.lower(py_strip(F.coalesce(_c(x), F.lit("")))), r"[^a-z0-9_]", "")


def url_last_part(x) -> Column:
    """Strip '/' at both ends, take the last path part."""
    trimmed = F.regexp_replace(_c(x), r"^/+|/+$", "")
    return F.element_at(F.split(trimmed, "/"), -1)


def clean_number(x, strip_commas: bool = True) -> Column:
    """Text -> double like Python ``float(str(x).strip())``; bad text -> null.

    Spark's own cast accepts Java forms such as ``'12d'``; a regex guard keeps
    only plain decimal / exponent literals. NaN becomes null. The text is named
    once: Catalyst copies an expression into every place that reads it, and the
    copies of several numbers make code that the JVM no longer compiles.
    """
    s = py_strip(_c(x).cast("string"))
    if strip_commas:
        s = F.replace(s, F.lit(","), F.lit(""))
    return F.regexp_extract(s, _NUMBER_RE, 0).try_cast("double")


def nan_to_null(x) -> Column:
    c = _c(x)
    return F.when(~F.isnan(c), c)


def safe_int(x, strip_commas: bool = True) -> Column:
    """Through float, truncated toward zero ('12.9' -> 12)."""
    return clean_number(x, strip_commas).try_cast("bigint")


def flag(x) -> Column:
    """Text -> boolean: the usual words, or a number that is not 0; else null."""
    t = py_strip(_c(x).cast("string"))
    return F.coalesce(t.try_cast("boolean"), clean_number(t) != 0)


def first_nonempty(*cols) -> Column:
    """First value whose stripped text is non-empty, else ''."""
    parts = [F.nullif(py_strip(_c(c).cast("string")), F.lit("")) for c in cols]
    return F.coalesce(*parts, F.lit(""))


def safe_str(x) -> Column:
    return py_strip(F.coalesce(_c(x).cast("string"), F.lit("")))


def normalize_month(x) -> Column:
    return F.lower(py_strip(F.coalesce(_c(x), F.lit(""))))


def _month_map() -> Column:
    kv = []
    for i, name in enumerate(MONTH_NAMES, start=1):
        kv += [F.lit(name), F.lit(i)]
    return F.create_map(*kv)


def month_number(x) -> Column:
    """Month name (any case/whitespace) -> 1..12, null when unknown."""
    return F.try_element_at(_month_map(), normalize_month(x)).cast("bigint")


def month_name_from_number(n) -> Column:
    """1..12 -> english month name (lower case); null otherwise."""
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), _c(n).cast("int"))


def month_key_of_month_start(d) -> Column:
    """month_key of a date without per-row formatting (same text as month_key_of)."""
    return F.concat(F.year(_c(d)).cast("string"), month_name_from_number(F.month(_c(d))))


def month_key(year, month) -> Column:
    """``<year><month name lower>``, e.g. 2024march."""
    return F.concat(_c(year).cast("bigint").cast("string"), normalize_month(month))


def month_name_of(d) -> Column:
    """English month name of a date/timestamp, lower case."""
    return F.lower(F.date_format(_c(d), "MMMM"))


def month_key_of(d) -> Column:
    return F.lower(F.date_format(_c(d), "yMMMM"))


def split_month_key(mk) -> tuple[Column, Column]:
    """month_key -> (year bigint, month name)."""
    c = _c(mk)
    return F.substring(c, 1, 4).try_cast("bigint"), F.substring(c, 5, 100)


def round_dp(x, digits: int = 2) -> Column:
    """Round half away from zero at ``digits`` decimals via x*10^d: the same
    bits as ANSI engines that scale, round and unscale a double."""
    p = float(10 ** digits)
    return F.round(_c(x) * p, 0) / p


def minutes_to_hours(x, digits: int | None = None) -> Column:
    h = _c(x) / F.lit(60.0)
    return h if digits is None else round_dp(h, digits)


def panel_status(has_metrics, rank, top_k: int = DEFAULT_TOP_K) -> Column:
    """Status from presence of metrics and rank."""
    r = _c(rank)
    return (
        F.when(~_c(has_metrics), F.lit(STATUS_INACTIVE))
        .when(r.isNotNull() & (r <= top_k), F.lit(STATUS_TOP))
        .when(r.isNotNull(), F.lit(STATUS_RANKED))
        .otherwise(F.lit(STATUS_UNRANKED))
    )


def created_year(x) -> Column:
    """Year of an ISO timestamp/date text; bad or blank -> null."""
    s = safe_str(x)
    return F.year(F.try_to_timestamp(F.nullif(s, F.lit("")))).cast("bigint")


def guarded_pct(part, whole, digits: int = 2) -> Column:
    """round(part / whole * 100, digits) when whole > 0, else 0.0."""
    w = _c(whole)
    return F.when(w > 0, round_dp(_c(part) / w * 100.0, digits)).otherwise(F.lit(0.0))


def variety_flag(top_pct, game_count, pct_limit: float = 75.0, min_games: int = 2) -> Column:
    return (_c(top_pct) < pct_limit) & (_c(game_count) > min_games)


def rank_band(offset, bands=RANK_BANDS) -> Column:
    """Index of the [start, end) band holding ``offset``; offsets past the last form one more, open band."""
    o = _c(offset)
    expr = None
    for i, (lo, hi) in enumerate(bands):
        cond = (o >= lo) & (o < hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.when(o >= bands[-1][1], F.lit(len(bands))).cast("bigint")


def pinned(df, name: str, value: Column):
    """``df`` with ``value`` as column ``name``, worked out once per row: a
    one-element generator keeps Catalyst from copying a costly expression into
    every place that reads the column."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def any_not_null(*cols) -> Column:
    out = None
    for c in cols:
        e = _c(c).isNotNull()
        out = e if out is None else (out | e)
    return out


def all_null(*cols) -> Column:
    return ~any_not_null(*cols)


def blank(x, is_text: bool = True) -> Column:
    """null or whitespace-only text (for non-text columns: null)."""
    if not is_text:
        return _c(x).isNull()
    return F.coalesce(py_strip(_c(x).cast("string")), F.lit("")) == F.lit("")


def cents(x) -> Column:
    """Money-like double with at most 2 decimals -> exact integer cents."""
    return F.round(_c(x) * 100.0).cast("bigint")


def sum_2dp(x) -> Column:
    """Exact sum of 2-decimal values as a double: integer cents added on a
    long (fast hash aggregate), then one correctly rounded division."""
    return F.sum(cents(x)) / 100.0


def exact_sum(x, scale: int = 6) -> Column:
    """Order-independent sum of doubles: add as decimal, return double."""
    return F.sum(_c(x).cast(f"decimal(38,{scale})")).cast("double")


def exact_mean(x, scale: int = 6) -> Column:
    """Mean over non-null values, sum taken as decimal (same in any order)."""
    return F.try_divide(exact_sum(x, scale), F.count(_c(x)))
