"""Cohort ranks and positions within monthly leaderboards.

A cohort or board may hold any share of the rows, and any share of its rows may have
one value, so neither is ever sorted in one task: ``ordering`` deals rows out by ranges of
equal depth, ties included, and the places within a part are shifted by the rows of the
parts before it.

:func:`bucketed_leaderboard` does without the written copy, for values that hardly
tie: it cuts them into buckets by a fixed, order-keeping function of the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import ordering as OD

# metric -> rank column (fixed names of the final fact table)
COHORT_RANKS = {
    "average_viewers": "avg_viewer_rank",
    "peak_viewers": "peak_viewer_rank",
    "followers": "follower_rank",
    "followers_gained": "follower_gain_rank",
}
# Buckets between a value and its double: 64 make each about 1.1 % wide.
BUCKETS_PER_OCTAVE = 64
_MAX_EXPONENT = 1100.0  # beyond the exponents of any finite double


def cohort_ranks(df: DataFrame, metrics: dict[str, str] = COHORT_RANKS,
                 cohort: tuple[str, str] = ("year", "month")) -> DataFrame:
    """Rank every row within its (year, month): highest value = 1, ties share
    the best rank (1,2,2,4), missing values share the last place (non-null
    count + 1), rows with a null cohort key get 0.

    ``df`` is computed once: it is written with a number per row. Its values become narrow rows
    (cohort, metric, value, number), dealt out by equal depth; a window ranks them within
    their part, and one row per (cohort, metric, part) holds the rows before the part and
    how many of them tie with its first value. The ranks are pivoted back to one row per
    number and joined with the written rows that have a value: the only shuffle of whole rows.
    Rows without any, as most of a gap-free panel, take the last places of their cohort unshuffled.
    """
    metrics = {m: r for m, r in metrics.items() if m in df.columns}
    if not metrics:
        return df
    keys, names = list(cohort), list(metrics)
    wide = OD.written(df.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    value = {m: S.nan_to_null(F.col(m).cast("double")) for m in names}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), value[m].alias("v")) for i, m in enumerate(names)])
    no_cohort = F.col(keys[0]).isNull() | F.col(keys[1]).isNull()
    narrow = (wide.where(~no_cohort).select(*keys, "_row", F.explode(pairs).alias("p"))
              .select(*keys, "_row", F.col("p.i").alias("_i"), F.col("p.v").alias("_v")).where("_v is not null"))
    group = [*keys, "_i"]
    rows = OD.dealt(narrow, group, [F.col("_v").desc()], "ranks")
    part = [*group, OD.PART]
    placed = rows.withColumn("_in", F.rank().over(Window.partitionBy(*part).orderBy(F.col("_v").desc())))
    stats = placed.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_top"), F.min("_v").alias("_low"),
                                      (F.count(F.lit(1)) - F.max("_in") + 1).alias("_ties"))
    in_order = Window.partitionBy(*group).orderBy(OD.PART)
    # rows up to here that have the part's last value; a part inside a run of ties adds all its rows
    run = F.sum("_ties").over(Window.partitionBy(*group, "_low").orderBy(OD.PART))
    stats = OD.written(stats.withColumns({"_before": F.sum("_n").over(in_order) - F.col("_n"), "_run": run})
                       .withColumn("_tied", F.when(F.lag("_low").over(in_order) == F.col("_top"), F.lag("_run").over(in_order)).otherwise(0)), "ranks")
    place = F.col("_before") + F.col("_in") - F.when(F.col("_v") == F.col("_top"), F.col("_tied")).otherwise(0)
    ranks = placed.join(stats.select(*part, "_before", "_top", "_tied"), part).select("_row", "_i", place.alias("_place"))
    back = ranks.groupBy("_row").agg(*[F.max(F.when(F.col("_i") == i, F.col("_place"))).alias(f"_p{i}") for i in range(len(names))])
    totals = stats.groupBy(*keys).agg(*[F.sum(F.when(F.col("_i") == i, F.col("_n"))).alias(f"_n{i}") for i in range(len(names))])
    ranked = ~no_cohort & S.any_not_null(*value.values())
    bare = wide.where(~ranked).withColumns({f"_p{i}": F.lit(None).cast("bigint") for i in range(len(names))})
    out = wide.where(ranked).join(back, "_row", "left").unionByName(bare).join(totals, keys, "left")
    last = {i: F.coalesce(F.col(f"_n{i}"), F.lit(0)) + 1 for i in range(len(names))}
    made = {r: F.when(no_cohort, 0).otherwise(F.coalesce(F.col(f"_p{i}"), last[i])).cast("bigint").alias(r) for i, r in enumerate(metrics.values())}
    kept = [made.pop(c) if c in made else F.col(c) for c in df.columns]
    return out.select(*kept, *made.values())


def monthly_leaderboard(df: DataFrame, metric: str, partition: list[str], key: str = "channel_id",
                        rank_col: str = "rank") -> DataFrame:
    """Position in a leaderboard sorted by ``metric`` desc (nulls last), ties by
    the numeric ``key``; rows with a null in ``partition`` form a board too.

    The rows are dealt out by (board, metric, key) in parts of equal depth: a board of one
    value is split by its keys."""
    v = S.nan_to_null(F.col(metric).cast("double"))
    return OD.positions(df, partition, [v.desc_nulls_last(), F.col(key).asc_nulls_last()], rank_col)


# --- without a written copy --------------------------------------------------------


def value_bucket(value: Column, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """Bucket of a number: never smaller for a greater value, equal for equal
    values, null for null. Logarithmic, so its count depends on the span of the
    values (at most some 280,000 for all doubles), not on the rows."""
    size = F.floor(F.least(F.log2(F.abs(value)), F.lit(_MAX_EXPONENT)) * per_octave) \
        + F.lit(int(_MAX_EXPONENT) * per_octave)
    return F.when(value > 0, size).when(value < 0, -size).when(value == 0, F.lit(0)).cast("bigint")


def _rows_above(buckets: DataFrame, keys: list[str], order: list[str], count: str, out: str) -> DataFrame:
    """Per bucket the rows of its group in the buckets above it."""
    above = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return buckets.select(*keys, *order, F.coalesce(F.sum(count).over(above), F.lit(0)).alias(out))


def bucketed_leaderboard(df: DataFrame, metric: str, partition: list[str], key: str = "channel_id",
                         rank_col: str = "rank", per_octave: int = BUCKETS_PER_OCTAVE) -> DataFrame:
    """:func:`monthly_leaderboard` as one lazy plan: a board is split over tasks by the metric's
    bucket, rows without a metric by the key's. Rows of one board with the same metric value
    stay together, so this is for values that hardly tie; rows with a null in ``partition`` get a
    null position.
    """
    v = S.nan_to_null(F.col(metric).cast("double"))
    order = ["_b", "_kb"]
    rows = df.withColumns({
        "_b": value_bucket(v, per_octave),
        "_kb": F.when(v.isNull(), -value_bucket(F.col(key).cast("double"), per_octave))})
    sizes = rows.groupBy(*partition, *order).agg(F.count(F.lit(1)).alias("_t"))
    # a null bucket (no metric, or a metric) takes part in the join under a value no bucket has
    none = F.lit(-(1 << 40))
    named = {c: F.coalesce(F.col(c), none) for c in order}
    above = _rows_above(sizes, partition, order, "_t", "_off").withColumns(named)
    local = Window.partitionBy(*partition, *order).orderBy(v.desc_nulls_last(), F.col(key))
    # the window has dealt out and sorted the rows by these keys, so a sorted merge moves the counts alone, which a
    # broadcast would bring to the driver
    return (rows.withColumns(named).withColumn("_at", F.row_number().over(local))
            .join(above.hint("merge"), [*partition, *order], "left")
            .select(*[F.col(c) for c in df.columns if c != rank_col],
                    (F.col("_off") + F.col("_at")).cast("bigint").alias(rank_col)))
