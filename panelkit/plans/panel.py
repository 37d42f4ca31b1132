"""Composite jobs: build, enrich, rank and report a panel.

``build_panel``, ``enrich_panel``, ``build_fact`` and ``add_games`` take frames
(a seed read by ``schema.read_fact_csv``, rows read from landed pages by
``sources.payloads``); the ``landed_*`` jobs apply them to the landed tables
through ``sources.bindings``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import games as G
from ..operators import lookups as E
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import ranks as R
from ..operators import scaffold as SC
from ..sources import bindings as B
from ..sources import payloads as PL

# --- jobs over frames ---------------------------------------------------------------


def build_panel(seed: DataFrame, live: DataFrame | None = None, channels: DataFrame | None = None,
                months: list[dt.date] | None = None, top_k: int = S.DEFAULT_TOP_K,
                active_rule: str = "row_present") -> DataFrame:
    """Gap-free channel x month panel from seed rows and live leaderboard rows.

    ``channels`` (channel_id, channel_name, display_name) defaults to the first
    seed row per channel. The months are those of the seed; ``months`` (month
    starts) narrows them, and raises when none is left."""
    if channels is None:
        first = SC.first_per_channel(seed, ["row_seq"])
        channels = first.select("channel_id", S.slug_norm("channel_slug").alias("channel_name"), "display_name")
    scope = seed.select(F.make_date(F.col("year").cast("int"), F.col("month_order").cast("int"), F.lit(1)).alias("m"))
    if months is not None:
        scope = scope.where(F.col("m").isin(months)) if months else scope.limit(0)
        Q.require_rows(scope, "no month of the seed lies in the asked scope")
    # distinct months of a calendar: a few hundred values at most
    spine = scope.where(F.col("m").isNotNull()).distinct().agg(F.array_sort(F.collect_list("m")).alias("m")).scalar()
    keyed = M.last_per_key(seed)
    return M.merge_sources(SC.panel_scaffold(channels, spine), keyed,
                           M.live_first_last(live) if live is not None else None,
                           top_k=top_k, active_rule=active_rule)


def enrich_panel(panel: DataFrame, games: DataFrame | None, users: DataFrame | None = None,
                 overwrite: bool = False, order=None, status_filter: list[str] | None = None,
                 with_lists: bool = True, lists: tuple[str, ...] = G.LISTS) -> DataFrame:
    """Panel + game features and lists (fill blanks, or overwrite) + creation
    dates. ``games`` holds one row per (channel, month, game); ``order`` is its
    source order (default ``pos``). ``status_filter`` keeps only the panel's rows of
    these statuses; without ``with_lists`` no list is collected or returned, and of
    the game lists only ``lists`` are filled (see :func:`games.games_agg`). A panel whose
    channels have been looked up already (:func:`lookups.attach_created`) needs no ``users``, and one that carries its
    game features (:func:`landed_panel`) no ``games``."""
    if status_filter:
        panel = E.status_filter(panel, status_filter)
    agg = G.games_agg(games, with_lists=with_lists, order=order, lists=lists) if games is not None else None
    out = G.enrich_games(panel, agg, overwrite=overwrite)
    if "_created_at" in out.columns:
        return E.fill_created(out)
    return E.enrich_created(out, users) if users is not None else out


def build_fact(pages: DataFrame, pies_by_time: DataFrame | None = None, pies_by_viewers: DataFrame | None = None,
               users: DataFrame | None = None) -> DataFrame:
    """Fact rows of the landed leaderboard pages, the top-five pies as JSON text
    and creation dates by login.

    ``pages`` (month_key, page_seq, payload) and the pies (channel_id,
    month_key, payload) are landed payloads; ``users`` has (login, created_at).
    A channel listed twice in a month keeps its first row. Ranks within the
    month are left to :func:`ranks.cohort_ranks`."""
    rows = PL.read_leaderboard(pages)
    once = SC.first_per_channel(rows, ["page_seq", "row_pos"], key=["channel_id", "month_key"])
    year, month = S.split_month_key("month_key")
    fact = once.select(
        year.alias("year"), month.alias("month"), "month_key", "channel_id",
        S.url_last_part("channel_slug").alias("channel_slug"), "display_name", F.col("rank").alias("rank_position"),
        "followers", "followers_gained", "average_viewers", "peak_viewers",
        F.when(F.col("hours_streamed") > 0, S.round_dp("hours_streamed", 2)).alias("hours_streamed"),
        F.when(F.col("hours_watched") > 0, S.round_dp("hours_watched", 2)).alias("hours_watched"), "language")
    for pies, name in ((pies_by_viewers, "top5_games_by_avg_viewers_json"),
                       (pies_by_time, "top5_games_by_stream_time_json")):
        if pies is None:
            fact = fact.withColumn(name, F.lit("[]"))
            continue
        top = PL.read_pie_tops(pies).select("channel_id", "month_key", F.to_json("top").alias(name))
        fact = fact.join(top, M.KEY, "left").withColumn(name, F.coalesce(F.col(name), F.lit("[]")))
    if users is None:
        return fact.withColumn("created", F.lit(None).cast("string"))
    return E.enrich_created(fact.withColumn("created", F.lit(None).cast("string")), users)


def add_games(fact: DataFrame, games_pages: DataFrame) -> DataFrame:
    """Fact rows with their games pages as one JSON list (``[]`` without pages)."""
    items = PL.read_games_ingest(games_pages)
    listed = items.groupBy(*M.KEY).agg(F.array_sort(F.collect_list(F.struct(
        "page", "idx", F.struct("game", "hours", "avg_viewers", "peak_viewers", "hours_watched").alias("g")))
    ).alias("_g")).select(*M.KEY, F.to_json(F.col("_g.g")).alias("all_games_json"))
    return fact.join(listed, M.KEY, "left").withColumn(
        "all_games_json", F.coalesce(F.col("all_games_json"), F.lit("[]")))


# --- jobs over the landed tables ----------------------------------------------------


def landed_panel(spark: SparkSession, sf_dir: str, top_k: int = S.DEFAULT_TOP_K,
                 active_rule: str = "row_present", months: list[dt.date] | None = None,
                 look_up_created: bool = False, games: Callable[[int], DataFrame] | None = None) -> DataFrame:
    """Panel of the landed tables.

    Its sources meet per channel, before the months are spread out: no row of the panel is shuffled.

    ``months``: month starts; only their span is read. Default is every month
    from the first to the last order month (scalar subqueries). With ``look_up_created``
    the channels' creation dates are looked up, one by channel, and kept as ``_created_at``
    for :func:`enrich_panel` to fill in; with ``games`` (a number of tasks -> features per channel and month that lie by
    channel over them) these are kept likewise."""
    span = B.month_span(spark, sf_dir) if months is None else months
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    channels = B.channels(spark, sf_dir)
    if look_up_created:
        channels = E.attach_created(channels, B.users(spark, sf_dir), only_blank=False)
    # seed and live share one orders scan and one keyed aggregate
    carried = {M.CARRIED: M.keyed_sources(B.tagged_sources(spark, sf_dir, months, partitions=parts))}
    if games is not None:
        carried[G.CARRIED] = games(parts)
    channels = channels.repartition(parts, "channel_id")
    for name, rows in carried.items():
        channels = SC.attach_months(channels, rows, name)
    scaffold = SC.panel_scaffold(channels, span)
    for name in carried:
        scaffold = SC.at_month(scaffold, name)
    keep = (["_created_at"] if look_up_created else []) + ([G.CARRIED] if games is not None else [])
    return M.merge_sources(scaffold, None, None, top_k=top_k, active_rule=active_rule, keep=tuple(keep))


def enriched_panel(spark: SparkSession, sf_dir: str, top_k: int = S.DEFAULT_TOP_K, overwrite: bool = False,
                   status_filter: list[str] | None = None, with_lists: bool = True,
                   lists: tuple[str, ...] = G.LISTS) -> DataFrame:
    """Landed panel + games features (fill blanks / overwrite) + created lookups."""
    def games(parts: int) -> DataFrame:
        # without lists only the hours and what the order reads
        rows = B.games_rows(spark, sf_dir, with_pos=False, partitions=parts, values=B.GAME_VALUES if with_lists else ("hours", "view_minutes"))
        return G.games_agg(rows, with_lists=with_lists, order=B.games_order(), lists=lists)
    return enrich_panel(landed_panel(spark, sf_dir, top_k=top_k, look_up_created=True, games=games), None,
                        overwrite=overwrite, status_filter=status_filter)


def final_panel(spark: SparkSession, sf_dir: str, top_k: int = S.DEFAULT_TOP_K) -> DataFrame:
    """Enriched panel with the four cohort ranks recomputed per (year, month).
    Enrichment changes no ranked metric, so the narrower panel is ranked first."""
    ranked = R.cohort_ranks(landed_panel(spark, sf_dir, top_k=top_k, look_up_created=True))
    return enrich_panel(ranked, B.games_rows(spark, sf_dir, with_pos=False), order=B.games_order())


def write_panel(panel: DataFrame, path: str) -> None:
    """Persist a panel as Parquet partitioned by month_key (dynamic overwrite:
    only the months present in ``panel`` are replaced)."""
    from ..sources.sinks import write_partitioned
    write_partitioned(panel, path, "month_key", ["channel_id"])


MANIFEST = "_inputs"  # folder inside a written panel; readers of the panel skip it


def input_manifest(spark: SparkSession, sf_dir: str, top_k: int = S.DEFAULT_TOP_K) -> list[dict]:
    """Month start, month key, rows and digest of the inputs of every month from the first to the last order.

    The digest adds the hashes of the month's order rows (no order of rows matters), those of the channels,
    which have a row in every month, and the parameters. One row a month, as many as the calendar has."""
    orders = B._orders_by_month(spark, sf_dir)
    wide = "decimal(38,0)"
    own = {r["ms"]: (r["rows"], r["digest"]) for r in orders.groupBy("ms").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*orders.columns).cast(wide)).alias("digest")).collect() if r["ms"] is not None}
    dim = B.channels(spark, sf_dir)
    channels = dim.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*dim.columns).cast(wide))).first()
    out, d = [], min(own, default=None)
    while d is not None and d <= max(own):
        rows, digest = own.get(d, (0, 0))
        out.append({"month_start": d, "month_key": f"{d.year}{S.MONTH_NAMES[d.month - 1]}", "rows": rows,
                    "digest": f"{digest}/{channels[0]}/{channels[1]}/{top_k}"})
        d = (d + dt.timedelta(days=32)).replace(day=1)
    return out


def committed(spark: SparkSession, path: str) -> tuple[dict[str, tuple[int, str]], int]:
    """(month key -> rows and digest of the inputs it was built from, last commit) of a written panel."""
    try:
        log = spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}, 0
    newest = log.groupBy("month_key").agg(F.max_by(F.struct("rows", "digest"), "commit").alias("i"), F.max("commit").alias("c")).collect()
    return {r["month_key"]: (r["i"]["rows"], r["i"]["digest"]) for r in newest}, max((r["c"] for r in newest), default=0)


def _commit(spark: SparkSession, path: str, months: list[dict], number: int) -> None:
    """Note the inputs a block of months was built from. Written after the block: months whose note is
    missing or older than their inputs are built again."""
    rows = [(m["month_key"], m["rows"], m["digest"], number) for m in months]
    spark.createDataFrame(rows, "month_key string, rows long, digest string, commit long").coalesce(1).write.mode("append").parquet(
        f"{path.rstrip('/')}/{MANIFEST}")


def _blocks(months: list[dict], size: int) -> list[list[dict]]:
    """Runs of months that follow each other, of at most ``size``: a block reads the orders of its span only."""
    out: list[list[dict]] = []
    for m in months:
        after = out and (out[-1][-1]["month_start"] + dt.timedelta(days=32)).replace(day=1) == m["month_start"]
        if after and len(out[-1]) < size:
            out[-1].append(m)
        else:
            out.append([m])
    return out


def incremental_run(spark: SparkSession, sf_dir: str, path: str, months_per_run: int = 12,
                    top_k: int = S.DEFAULT_TOP_K) -> DataFrame:
    """Bring the panel under ``path`` up to its inputs, a block of months at a time.

    A manifest kept inside ``path`` holds, per month, the row count and an order-free digest of the inputs
    the month was built from. Months that are new, or whose inputs have changed since (late rows, rows taken
    back, new channels, another cut), are built again; the others are not touched. A block is written first
    and noted afterwards, so a run that was cut off builds the block it was at again. Returns the table read
    back; it equals a build from scratch as long as no month has left the span of the orders.

    Finding the changes reads the orders' used columns once; a block then reads the orders of its span.
    The driver holds one row a month."""
    known, number = committed(spark, path)
    changed = [m for m in input_manifest(spark, sf_dir, top_k) if known.get(m["month_key"]) != (m["rows"], m["digest"])]
    for block in _blocks(changed, months_per_run):
        number += 1
        write_panel(landed_panel(spark, sf_dir, top_k=top_k, months=[m["month_start"] for m in block]), path)
        _commit(spark, path, block, number)
    return spark.read.parquet(path)


def report_tables(panel: DataFrame, top_n: int = 20, materialize_to: str | None = None) -> dict[str, DataFrame]:
    """All report sections of one panel, as DataFrames; the games sections only
    when the panel holds game lists.

    With ``materialize_to`` the panel is first written there (partitioned by
    month_key, e.g. under ``spark.checkpoint.dir``), so it is computed once for the whole
    report; the keyed sections share one scan of it (:func:`report.report_cells`)."""
    from ..operators import report as RP
    from ..operators.ordering import written
    if materialize_to:
        write_panel(panel, materialize_to)
        panel = panel.sparkSession.read.parquet(materialize_to)
    found = RP.sections(written(RP.report_cells(panel), "report-cells"), len(panel.columns), top_n)
    out = {
        "overview": found["overview"],
        "status_distribution": found["status_distribution"].orderBy(F.desc("count"), "status"),
        "missingness": found["missingness"],
        "monthly_summary": found["monthly_summary"].orderBy("month_key"),
        "created_cohorts": found["created_cohorts"].orderBy(F.desc("count"), "created_year"),
        **{f"top_channels_by_{m}": found[f"top_channels_by_{m}"] for m in ("avg_viewers", "hours_watched", "followers")},
        "coverage_pcts": RP.coverage_pcts(panel),
        "viewer_trend": RP.viewer_trend(panel),
        "rank_histogram": RP.rank_histogram(panel),
        "report_long": RP.report_long(panel, top_n),
    }
    if "all_games" in panel.columns:
        out["top_games_by_hours"] = found["top_games_by_hours"]
        out["top_games_by_mentions"] = found["top_games_by_mentions"]
    return out
