"""Incremental planning and scan bookkeeping as joins, aggregates and windows.

* work planning = anti-joins against done keys / done scopes
* scan logs, stop rules and resume offsets = aggregates and windows over a
  page table (one row per landed page), never a driver loop
* time-window rules (error bursts) and "latest unexpired value" lookups
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import ordering as OD

KEY = ["channel_id", "month_key"]


# --- work planning --------------------------------------------------------------

def missing_pairs(scaffold: DataFrame, *have: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Scaffold keys present in none of the ``have`` frames (left anti joins)."""
    out = scaffold
    for h in have:
        out = out.join(h.select(*key).distinct(), key, "left_anti")
    return out


def incremental_todo(scaffold: DataFrame, done_keys: DataFrame, done_scopes: DataFrame | None = None,
                     key: list[str] = KEY, scope: list[str] = ("month_key",)) -> DataFrame:
    """Keys still to process: not checkpointed, and not in a finished scope."""
    out = scaffold.join(done_keys.select(*key).distinct(), key, "left_anti")
    if done_scopes is not None:
        out = out.join(done_scopes.select(*scope).distinct(), list(scope), "left_anti")
    return out


# --- scan log -------------------------------------------------------------------

def page_log(events: DataFrame, scope_col: Column, page_col: Column, target: str) -> DataFrame:
    """Rows -> one row per (scope, page): n_rows, n_new (targets first seen on
    that page within the scope), offset (rows on earlier pages), band.

    First sightings come from a per-(scope, target) min; the running offset is
    a window over the pages of one scope (pages, not rows)."""
    e = events.select(scope_col.alias("scope"), page_col.alias("page_seq"), F.col(target).alias("_t"))
    per_page = e.groupBy("scope", "page_seq").agg(F.count(F.lit(1)).alias("n_rows"))
    first = (e.groupBy("scope", "_t").agg(F.min("page_seq").alias("page_seq"))
              .groupBy("scope", "page_seq").agg(F.count(F.lit(1)).alias("n_new")))
    log = per_page.join(first, ["scope", "page_seq"], "left").withColumn(
        "n_new", F.coalesce("n_new", F.lit(0)).cast("bigint"))
    w = Window.partitionBy("scope").orderBy("page_seq").rowsBetween(Window.unboundedPreceding, -1)
    log = log.withColumn("offset", F.coalesce(F.sum("n_rows").over(w), F.lit(0)).cast("bigint"))
    return log.withColumn("band", S.rank_band(F.col("offset")))


def scan_log_stats(log: DataFrame) -> DataFrame:
    """Per (scope, band): pages, non-empty pages, rows, new targets, density."""
    return log.groupBy("scope", "band").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("n_rows") > 0).alias("nonempty_pages"),
        F.sum("n_rows").cast("bigint").alias("rows"),
        F.sum("n_new").cast("bigint").alias("found"),
    ).withColumn("density", F.col("rows") / F.col("pages"))


def zero_yield_cutoff(log: DataFrame, n_zero: int = 10, recent: int = 5, recent_min: int = 3) -> DataFrame:
    """Per scope: first page where ``n_zero`` pages in a row brought no new
    target, and first page where the last ``recent`` pages brought fewer than
    ``recent_min`` in total (gaps-and-islands over the page order)."""
    w = Window.partitionBy("scope").orderBy("page_seq")
    island = F.sum(F.when(F.col("n_new") > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    l2 = log.withColumn("_island", island).withColumn("_i", F.row_number().over(w))
    run = F.sum(F.when(F.col("n_new") == 0, 1).otherwise(0)).over(
        Window.partitionBy("scope", "_island").orderBy("page_seq").rowsBetween(Window.unboundedPreceding, 0))
    recent_sum = F.sum("n_new").over(w.rowsBetween(-(recent - 1), 0))
    l3 = l2.withColumn("_run", run).withColumn("_recent", recent_sum)
    return l3.groupBy("scope").agg(
        F.min(F.when(F.col("_run") >= n_zero, F.col("page_seq"))).alias("cutoff_zero_run"),
        F.min(F.when((F.col("_i") >= recent) & (F.col("_recent") < recent_min), F.col("page_seq")))
         .alias("cutoff_recent"),
        F.count(F.lit(1)).alias("pages"),
    )

# --- stop rule over batches of pages ------------------------------------------------

DEEP_OFFSET = 10_000     # from here on empty pages are not counted, and more pages without a new target are borne
BLOCK_BATCHES = 500      # batches ordered in one window partition


def page_spine(log: DataFrame) -> DataFrame:
    """Every page of a scope from 0 to its last, those without rows too: (scope, page_seq)."""
    last = log.groupBy("scope").agg(F.max("page_seq").alias("_last"))
    return last.select("scope", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))).alias("page_seq"))


def scan_batches(log: DataFrame, batch_pages: int = 8) -> DataFrame:
    """Pages (scope, page_seq, offset, n_rows, n_new) -> their batches in order.

    A phase is a rank band of the offset; its pages form batches of ``batch_pages``. A page counts towards a run without
    new targets when it has rows, or is empty at an offset up to DEEP_OFFSET; a page with a new target ends the run. An
    all-empty batch from the fifth phase on, the third of its phase or later, jumps a dead zone: it ends the run too, and
    no stop is tested after it.
    """
    pages = OD.positions(log.select("scope", "page_seq", "offset", "n_rows", "n_new", S.rank_band("offset").alias("phase")),
                         ["scope", "phase"], [F.col("page_seq").asc()], "_i")
    hit = F.col("n_new") > 0
    counted = (F.col("n_rows") > 0) | (F.col("offset") <= DEEP_OFFSET)
    b = pages.groupBy("scope", "phase", F.floor((F.col("_i") - 1) / batch_pages).alias("batch")).agg(
        F.min("offset").alias("min_offset"), F.max("page_seq").alias("last_page"), F.count(F.lit(1)).alias("pages"),
        F.sum("n_rows").alias("rows"), F.sum("n_new").alias("new"), F.count_if(counted).alias("_counted"), F.bool_or(hit).alias("_hit"),
        F.sort_array(F.collect_list(F.struct("page_seq", hit.alias("hit"), counted.alias("counted")))).alias("_p"))  # of one batch
    tail = F.aggregate("_p", F.lit(0).cast("bigint"), lambda a, p: F.when(p["hit"], F.lit(0).cast("bigint")).otherwise(a + p["counted"].cast("bigint")))
    jump = (F.col("phase") >= 4) & (F.col("batch") >= 2) & (F.col("rows") == 0)
    b = b.withColumns({"jump": jump, "_ends": F.col("_hit") | jump,
                       "_run": F.when(jump, F.lit(0).cast("bigint")).otherwise(tail)}).drop("_p", "_counted", "_hit")
    return OD.positions(b, ["scope"], [F.col("phase").asc(), F.col("batch").asc()], "g")


def stop_points(log: DataFrame, batch_pages: int = 8, early_stop_pages: int = 10, block: int = BLOCK_BATCHES) -> DataFrame:
    """Per scope the batch after which its scan stops: (scope, stop_phase, stop_batch, stop_page, reason, run, pages, pages_after);
    a scope that is scanned to its end has no reason and no stop.

    Tested after each batch, in this order: ``no_new`` once a phase has had more than three batches and ``early_stop_pages`` pages
    in a row, ten more past DEEP_OFFSET, brought no new target; ``zero_yield`` from the sixth phase on, when the last three
    batches brought none; ``sparse_tail`` from the fifth on, when the last five brought fewer than three.

    A scope's batches are cut into blocks: a run is counted within its block, and what is open at a block's start is
    carried over by a window over the scope's blocks, 1 / ``block`` of its batches; the last four batches of a block are
    copied into the next one, for the tests that look back."""
    b = scan_batches(log, batch_pages).withColumn("_blk", F.floor((F.col("g") - 1) / block))
    in_block = Window.partitionBy("scope", "_blk").orderBy("g")
    b = b.withColumn("_island", F.sum(F.col("_ends").cast("bigint")).over(in_block))
    b = b.withColumn("_local", F.sum("_run").over(Window.partitionBy("scope", "_blk", "_island").orderBy("g")))
    ends = b.groupBy("scope", "_blk").agg(F.max_by("_local", "g").alias("_open"), F.bool_or("_ends").alias("_any"))
    of_scope = Window.partitionBy("scope").orderBy("_blk")
    ends = ends.withColumn("_grp", F.sum(F.col("_any").cast("bigint")).over(of_scope))
    ends = ends.withColumn("_end", F.sum("_open").over(Window.partitionBy("scope", "_grp").orderBy("_blk")))
    carried = ends.select(F.col("scope").alias("_s"), (F.col("_blk") + 1).alias("_b"), F.col("_end").alias("_carry"))
    b = b.join(carried, (F.col("scope") == F.col("_s")) & (F.col("_blk") == F.col("_b")), "left").drop("_s", "_b")
    b = b.withColumn("run", F.col("_local") + F.when(F.col("_island") == 0, F.coalesce("_carry", F.lit(0))).otherwise(0))
    # with the four batches before it, every batch finds the last five in its block
    ctx = b.where((F.col("g") - 1) % block >= block - 4).withColumns({"_blk": F.col("_blk") + 1, "_ctx": F.lit(True)})
    both = b.withColumn("_ctx", F.lit(False)).unionByName(ctx)
    both = both.withColumns({f"_last{n}": F.sum("new").over(in_block.rowsBetween(1 - n, 0)) for n in (3, 5)})
    nth = F.col("batch") + 1
    reason = (F.when(F.col("jump"), None)
              .when((nth > 3) & (F.col("run") >= early_stop_pages + F.when(F.col("min_offset") > DEEP_OFFSET, 10).otherwise(0)), "no_new")
              .when((F.col("phase") >= 5) & (F.col("g") >= 3) & (F.col("_last3") == 0), "zero_yield")
              .when((F.col("phase") >= 4) & (F.col("g") >= 5) & (F.col("_last5") < 3), "sparse_tail"))
    at = both.where(~F.col("_ctx")).withColumn("reason", reason)
    stop = F.col("reason").isNotNull()
    first = at.groupBy("scope").agg(
        F.min_by(F.struct("phase", nth.alias("batch"), "last_page", "reason", "run"), F.when(stop, F.col("g"))).alias("s"),
        F.sum("pages").alias("pages"), F.max("last_page").alias("_last"))
    return first.select("scope", F.col("s.phase").alias("stop_phase"), F.col("s.batch").cast("bigint").alias("stop_batch"),
                        F.col("s.last_page").alias("stop_page"), F.col("s.reason").alias("reason"), F.col("s.run").cast("bigint").alias("run"),
                        F.col("pages").cast("bigint").alias("pages"), (F.col("_last") - F.col("s.last_page")).alias("pages_after"))


def resume_offsets(progress: DataFrame) -> DataFrame:
    """progress(scope, seq, offset, done) -> per scope the offset to resume
    from (last saved by seq; 0 once done) and the done flag."""
    return progress.groupBy("scope").agg(
        F.max_by("offset", "seq").alias("_last"), F.bool_or("done").alias("done"),
    ).select("scope", F.when(F.col("done"), F.lit(0)).otherwise(F.coalesce("_last", F.lit(0)))
             .cast("bigint").alias("resume_offset"), "done")


# --- time rules -------------------------------------------------------------------

def error_bursts(errors: DataFrame, key: str, ts: str, span_seconds: int = 60, threshold: int = 3,
                 id_col: str = "event_id") -> DataFrame:
    """Count of events of the same key within the ``span_seconds`` ending at
    each event (inclusive); ``burst`` when it reaches ``threshold``.

    Exact range frame, but partitioned by (key, span bucket): each event is
    also copied into the next bucket as context, so a hot key's history is
    split into span-sized window partitions instead of one."""
    e = errors.select(F.col(key).alias("_k"), F.col(id_col).alias("_id"), F.col(ts).alias("_ts"))
    us = F.unix_micros(F.col("_ts"))
    span_us = span_seconds * 1_000_000
    b = F.floor(us / span_us)
    own = e.withColumn("_b", b).withColumn("_ctx", F.lit(False))
    ctx = e.withColumn("_b", b + 1).withColumn("_ctx", F.lit(True))
    both = own.unionByName(ctx).withColumn("_us", F.unix_micros("_ts"))
    w = Window.partitionBy("_k", "_b").orderBy("_us").rangeBetween(-span_us, 0)
    counted = both.withColumn("_n", F.count(F.lit(1)).over(w)).where(~F.col("_ctx"))
    return counted.select(F.col("_id").alias(id_col), F.col("_k").alias(key),
                          F.col("_n").cast("bigint").alias("n_in_window"),
                          (F.col("_n") >= threshold).alias("burst"))


def failure_runs(events: DataFrame, key: str, order: list[str], is_fail: Column, ts: str = "ts") -> DataFrame:
    """Longest run of consecutive failures per key; keys without a failure give
    no row. ``order`` starts with ``ts``.

    A key's history is cut into days, each ordered in its own window partition
    and reduced to (events, failures at its start, at its end, longest run);
    the days are then joined into one run across midnight by folding the key's
    day rows, as many as the calendar has."""
    part = [key, "_day"]
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    e = events.select(key, *[c for c in dict.fromkeys([ts, *order]) if c != key], is_fail.alias("_fail")) \
        .withColumn("_day", F.to_date(ts))
    e = e.withColumn("_grp", F.sum(F.when(F.col("_fail"), 0).otherwise(1)).over(w))
    # group g holds the g-th success and the failures after it; group 0 has no success
    runs = e.groupBy(*part, "_grp").agg(F.count_if("_fail").alias("_run"), F.count(F.lit(1)).alias("_n"))
    days = runs.groupBy(*part).agg(
        F.sum("_n").alias("n"), F.coalesce(F.sum(F.when(F.col("_grp") == 0, F.col("_run"))), F.lit(0)).alias("head"),
        F.max_by("_run", "_grp").alias("tail"), F.max("_run").alias("best"))
    days = days.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_day", "n", "head", "tail", "best"))).alias("_d"))
    start = F.struct(F.lit(0).cast("bigint").alias("open"), F.lit(0).cast("bigint").alias("best"))
    folded = F.aggregate("_d", start, lambda a, x: F.struct(
        F.when(x["head"] == x["n"], a["open"] + x["n"]).otherwise(x["tail"]).alias("open"),
        F.greatest(a["best"], x["best"], a["open"] + x["head"]).alias("best")))
    return days.select(key, folded["best"].alias("longest_run")).where("longest_run > 0")


def ttl_latest(writes: DataFrame, key: str, payload: str, created_at: str, ttl_seconds: Column | int,
               now: Column, order: list[str] | None = None) -> DataFrame:
    """Newest write per key, kept while now - created_at <= ttl; a payload that
    is not a JSON object counts as a miss. One hash aggregate per key."""
    ttl = F.lit(ttl_seconds) if isinstance(ttl_seconds, int) else ttl_seconds
    ordering = F.struct(*[F.col(c) for c in (order or [created_at])])
    latest = writes.groupBy(key).agg(
        F.max_by(F.struct(F.col(payload).alias("payload"), F.col(created_at).alias("created_at"),
                          ttl.alias("ttl")), ordering).alias("w"))
    age = F.unix_seconds(now) - F.unix_seconds(F.col("w.created_at"))
    ok = F.from_json(F.col("w.payload"), "map<string,string>").isNotNull()
    return latest.where((age <= F.col("w.ttl")) & ok).select(
        key, F.col("w.payload").alias("payload"), F.col("w.created_at").alias("created_at"),
        age.cast("bigint").alias("age_s"))
