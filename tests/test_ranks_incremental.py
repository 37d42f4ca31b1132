"""Cohort ranks, scan stop rules, resume offsets, TTL lookups, error bursts."""
import contextlib
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.operators import incremental as I
from panelkit.operators import ordering as OD
from panelkit.operators import ranks as R

from conftest import rows


def test_cohort_ranks_ties_nulls(spark):
    df = spark.createDataFrame([(1, 2024, "march", "5"), (2, 2024, "march", "5"), (3, 2024, "march", "3"),
                                (4, 2024, "march", None), (5, 2024, "march", ""), (6, None, "march", "9"),
                                (7, 2024, "march", "NaN")],
                               "id int, year bigint, month string, average_viewers string")
    df = df.withColumn("average_viewers", F.col("average_viewers").try_cast("double"))
    out = R.cohort_ranks(df, {"average_viewers": "avg_viewer_rank"})
    assert rows(out, "id", "avg_viewer_rank") == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 0), (7, 4)]


def test_zero_yield_cutoff_and_resume(spark):
    log = spark.createDataFrame([("m", i, 10, n) for i, n in enumerate([1, 0, 0, 1, 0, 0, 0, 5])],
                                "scope string, page_seq bigint, n_rows bigint, n_new bigint")
    c = I.zero_yield_cutoff(log, n_zero=3, recent=5, recent_min=3).first()
    assert c["cutoff_zero_run"] == 6          # 7th page: third empty page in a row
    assert c["cutoff_recent"] == 4            # pages 0..4 brought 2 < 3
    prog = spark.createDataFrame([("a", 1, 100, False), ("a", 2, 200, False), ("b", 1, 50, False),
                                  ("b", 2, 60, True)], "scope string, seq bigint, offset bigint, done boolean")
    assert rows(I.resume_offsets(prog)) == [("a", 200, False), ("b", 0, True)]


def test_page_log(spark):
    ev = spark.createDataFrame([("s", 0, 1), ("s", 0, 2), ("s", 1, 1), ("s", 2, 3)],
                               "scope string, page bigint, user_id bigint")
    log = I.page_log(ev, F.col("scope"), F.col("page"), "user_id")
    assert rows(log, "page_seq", "n_rows", "n_new", "offset") == [(0, 2, 2, 0), (1, 1, 0, 2), (2, 1, 1, 3)]


def test_ttl_latest_boundary(spark):
    now = dt.datetime(2024, 1, 31)
    w = spark.createDataFrame([
        ("a", '{"v":1}', now - dt.timedelta(seconds=100), 1),
        ("a", '{"v":2}', now - dt.timedelta(seconds=50), 2),      # newest: wins
        ("b", '{"v":3}', now - dt.timedelta(seconds=60), 3),      # age == ttl: still valid
        ("c", '{"v":4}', now - dt.timedelta(seconds=61), 4),      # expired
        ("d", 'oops', now - dt.timedelta(seconds=1), 5),          # unparsable: miss
    ], "k string, payload string, created_at timestamp, id int")
    got = rows(I.ttl_latest(w, "k", "payload", "created_at", 60, F.lit(now), order=["created_at", "id"]),
               "k", "payload", "age_s")
    assert got == [("a", '{"v":2}', 50), ("b", '{"v":3}', 60)]


def test_error_bursts_and_runs(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    ts = [0, 20, 59, 61, 200, 230, 250]
    e = spark.createDataFrame([(i, 1, t0 + dt.timedelta(seconds=s)) for i, s in enumerate(ts)],
                              "event_id bigint, user_id bigint, ts timestamp")
    got = rows(I.error_bursts(e, "user_id", "ts", span_seconds=60, threshold=3), "event_id", "n_in_window", "burst")
    assert got == [(0, 1, False), (1, 2, False), (2, 3, True), (3, 3, True), (4, 1, False), (5, 2, False),
                   (6, 3, True)]
    # hours 0..7 and, from hour 22 on, a run over midnight; user 3 never fails
    at = [(1, h, t) for h, t in enumerate("eeoeeeoe")] + [(2, 22 + h, t) for h, t in enumerate("oe" + "e" * 24 + "eo")]
    ev = spark.createDataFrame([*at, (3, 1, "o")], "user_id bigint, h int, t string").withColumn(
        "ts", F.timestamp_seconds(F.col("h") * 3600))
    assert rows(I.failure_runs(ev, "user_id", ["ts"], F.col("t") == "e")) == [(1, 3), (2, 26)]


def test_planning_anti_joins(spark):
    sc = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b")], "channel_id bigint, month_key string")
    done = spark.createDataFrame([(1, "a")], "channel_id bigint, month_key string")
    months = spark.createDataFrame([("b",)], "month_key string")
    assert rows(I.missing_pairs(sc, done)) == [(1, "b"), (2, "a"), (2, "b")]
    assert rows(I.incremental_todo(sc, done, months), "channel_id", "month_key") == [(2, "a")]



def test_range_rank_equals_window(spark):
    import random
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        y = rnd.choice([2023, 2024, None]) if i % 97 else None
        m = rnd.choice(["march", "april"])
        v = rnd.choice([None, float(rnd.randint(-40, 40)), rnd.random() * 10, -1e300, 1e300, float("inf")])
        data.append((i, y, m, v))
    df = spark.createDataFrame(data, "id int, year bigint, month string, average_viewers double")
    spec = {"average_viewers": "avg_viewer_rank"}
    a = rows(R.cohort_ranks(df, spec), "id", "avg_viewer_rank")
    w = Window.partitionBy("year", "month").orderBy(F.col("average_viewers").desc_nulls_last())
    b = rows(df.withColumn("avg_viewer_rank", F.when(F.col("year").isNull(), 0).otherwise(F.rank().over(w))),
             "id", "avg_viewer_rank")
    assert a == b


def test_leaderboard_equals_row_number(spark):
    import random
    rnd = random.Random(8)
    data = [(i, rnd.choice(["a", "b"]), rnd.choice([None, None, float(rnd.randint(-9, 9)), rnd.random()]))
            for i in rnd.sample(range(5000), 2000)]
    df = spark.createDataFrame(data, "channel_id bigint, month_key string, v double")
    w = Window.partitionBy("month_key").orderBy(F.col("v").desc_nulls_last(), "channel_id")
    assert rows(R.monthly_leaderboard(df, "v", ["month_key"])) == rows(df.withColumn("rank", F.row_number().over(w)))


@contextlib.contextmanager
def parts_kept(spark, n=32):
    """``n`` shuffle partitions, none merged: how evenly rows are dealt out shows on small data too."""
    set_to = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(n)}
    before = {k: spark.conf.get(k) for k in set_to}
    for k, v in set_to.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def skewed(spark, n=20_000):
    """Values inside one octave; 90 % of the rows of one month have one value; a fifth has none."""
    v = (F.when(F.col("id") % 5 == 0, None).when((F.col("id") % 10 != 3) & (F.col("m") == "may"), 1.5)
         .otherwise(1.0 + F.pmod(F.xxhash64("id"), F.lit(997)) / 1000.0))
    return (spark.range(n).withColumn("m", F.when(F.col("id") % 4 == 0, "june").otherwise("may"))
            .select(F.col("id").alias("channel_id"), F.lit(2024).alias("year"), F.col("m").alias("month"), v.cast("double").alias("average_viewers"),
                    F.lit(7.0).alias("followers")))


def test_boards_and_ranks_of_ties_are_split_evenly(spark, monkeypatch):
    sizes = []
    deal = OD.dealt

    def watched(df, group, order, name="ordered"):
        out = deal(df, group, order, name)
        sizes.append([r["count"] for r in out.groupBy(OD.PART).count().collect()])
        return out
    monkeypatch.setattr(OD, "dealt", watched)
    df = skewed(spark)
    with parts_kept(spark):
        board = R.monthly_leaderboard(df, "average_viewers", ["month"], rank_col="place")
        ranked = R.cohort_ranks(df, {"average_viewers": "a", "followers": "f"})
        w = Window.partitionBy("month")
        want = df.withColumn("place", F.row_number().over(w.orderBy(F.col("average_viewers").desc_nulls_last(), "channel_id")))
        assert rows(board, "channel_id", "place") == rows(want, "channel_id", "place")
        want = df.withColumns({"a": F.rank().over(w.orderBy(F.col("average_viewers").desc_nulls_last())),
                               "f": F.rank().over(w.orderBy(F.col("followers").desc_nulls_last()))})
        assert rows(ranked, "channel_id", "a", "f") == rows(want, "channel_id", "a", "f")
    assert len(sizes) == 2
    for found in sizes:
        assert max(found) < sum(found) / 10 and len(found) >= 16


def test_ranks_shuffle_whole_rows_once(spark):
    df = skewed(spark, 500).withColumn("payload", F.repeat(F.lit("x"), 100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = R.cohort_ranks(df, {"average_viewers": "a", "followers": "f"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "_row" in x]
    assert len(wide) == 2 and "payload" in plan     # the ranks pivoted by row, and the rows themselves


def test_no_metrics_null_cohorts_and_empty(spark):
    df = skewed(spark, 50)
    assert R.cohort_ranks(df.drop("average_viewers", "followers")).columns == ["channel_id", "year", "month"]
    out = R.cohort_ranks(df.withColumn("year", F.lit(None).cast("int")), {"followers": "f"})
    assert {r["f"] for r in out.collect()} == {0}
    assert R.cohort_ranks(df.limit(0)).count() == 0
    assert R.monthly_leaderboard(df.limit(0), "followers", ["month"]).count() == 0


def landed(spark, orders, customers, path=None, mode="append"):
    from panelkit.sources import sinks as SK
    path = path or SK.scratch_path(spark, "t-landed")
    if orders is not None:
        orders.write.mode(mode).parquet(f"{path}/orders.parquet")
    if customers is not None:
        customers.write.mode(mode).parquet(f"{path}/customer.parquet")
    return path


def test_incremental_run_takes_in_late_rows(spark):
    from conftest import SMALL
    from panelkit.plans import panel as P
    from panelkit.sources import sinks as SK
    orders, customers = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("orders", "customer"))
    late = (F.col("o_orderdate") >= "1995-03-01") & (F.col("o_orderdate") < "1995-05-01") & (F.col("o_orderstatus") != "F")
    src, path = landed(spark, orders.where(~late), customers), SK.scratch_path(spark, "t-incremental")

    def files(df):
        return {f.rsplit("month_key=", 1)[1] for f in df.inputFiles()}
    first = P.incremental_run(spark, src, path, months_per_run=40)
    before, known = files(first), P.committed(spark, path)
    again = P.incremental_run(spark, src, path)
    assert files(again) == before and P.committed(spark, path) == known      # nothing changed: nothing written
    assert again.count() == first.count()
    landed(spark, orders.where(late), None, src)
    second = P.incremental_run(spark, src, path)
    touched = {f.split("/")[0] for f in files(second) ^ before}
    assert touched == {"1995march", "1995april"}
    whole = P.landed_panel(spark, SMALL)
    assert second.select(whole.columns).exceptAll(whole).isEmpty() and second.count() == whole.count()
    # a new channel has a row in every month, and another cut changes every status
    new = customers.limit(1).withColumns({"c_custkey": F.lit(10_000_001).cast("bigint"), "c_name": F.lit("New")})
    landed(spark, None, new, src)
    third = P.incremental_run(spark, src, path, months_per_run=100)
    assert third.count() == P.landed_panel(spark, src).count() == whole.count() + whole.select("month_key").distinct().count()
    assert P.incremental_run(spark, src, path, months_per_run=100, top_k=1).where("status = 'active_top500' and rank > 1").isEmpty()


def test_incremental_run_goes_on_where_it_was_cut_off(spark, monkeypatch):
    import pytest
    from conftest import SMALL
    from panelkit.plans import panel as P
    from panelkit.sources import sinks as SK
    orders, customers = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("orders", "customer"))
    src, path = landed(spark, orders.where("o_orderstatus = 'F'"), customers), SK.scratch_path(spark, "t-cut")
    commit, calls = P._commit, []

    def broken(*args):  # the second block is written but not noted
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        commit(*args)
    monkeypatch.setattr(P, "_commit", broken)
    with pytest.raises(RuntimeError):
        P.incremental_run(spark, src, path, months_per_run=20)
    assert len(P.committed(spark, path)[0]) == 20
    monkeypatch.setattr(P, "_commit", commit)
    landed(spark, orders.where("o_orderstatus <> 'F'"), None, src)  # meanwhile late rows came for months of both
    back, whole = P.incremental_run(spark, src, path, months_per_run=30), P.landed_panel(spark, SMALL)
    assert back.select(whole.columns).exceptAll(whole).isEmpty() and back.count() == whole.count()


def test_months_are_read_by_their_span(spark):
    from conftest import SMALL
    from panelkit.plans import panel as P
    plan = P.landed_panel(spark, SMALL, months=[dt.date(1996, 1, 1), dt.date(1996, 2, 1)]) \
        .select("*")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan and "LessThan(o_orderdate,1" in plan
    months = [{"month_start": dt.date(1996 + (m - 1) // 12, (m - 1) % 12 + 1, 1)} for m in (1, 2, 3, 4, 6, 12, 13)]
    assert [[m["month_start"].month for m in b] for b in P._blocks(months, 3)] == [[1, 2, 3], [4], [6], [12, 1]]


def stop_by_loop(pages, batch_pages=8, early=10):
    """The stop rule page by page: (phase, batch, page, reason, run) of one scope, or None."""
    from panelkit.functions import scalars as S

    def phase_of(offset):
        return next((i for i, (lo, hi) in enumerate(S.RANK_BANDS) if lo <= offset < hi), len(S.RANK_BANDS))
    phases: dict = {}
    for p in pages:
        phases.setdefault(phase_of(p[1]), []).append(p)
    run, news = 0, []
    for phase in sorted(phases):
        for n, at in enumerate(range(0, len(phases[phase]), batch_pages), 1):
            batch = phases[phase][at:at + batch_pages]
            for _, offset, n_rows, n_new in batch:
                if n_new:
                    run = 0
                elif n_rows or offset <= 10_000:
                    run += 1
            news.append(sum(p[3] for p in batch))
            if phase >= 4 and n >= 3 and not any(p[2] for p in batch):
                run = 0
                continue
            least = early + (10 if batch[0][1] > 10_000 else 0)
            reason = ("no_new" if n > 3 and run >= least else "zero_yield" if phase >= 5 and len(news) >= 3 and not sum(news[-3:])
                      else "sparse_tail" if phase >= 4 and len(news) >= 5 and sum(news[-5:]) < 3 else None)
            if reason:
                return phase, n, batch[-1][0], reason, run
    return None


def test_stop_points_equal_a_loop(spark):
    import random
    rnd, data, want = random.Random(11), [], {}
    for k in range(60):
        scope, step = f"s{k}", rnd.choice([20, 50, 100])
        hit, empty, quiet = rnd.choice([0.9, 0.4, 0.1, 0.03]), rnd.choice([0.0, 0.2, 0.7, 0.98]), rnd.randrange(0, 400)
        pages = []
        for i in range(rnd.randrange(1, 420)):
            n_rows = 0 if rnd.random() < (empty if i > quiet else 0.1) else 100
            pages.append((i, i * step, n_rows, rnd.randrange(1, 3) if n_rows and rnd.random() < (0.9 if i < quiet else hit) else 0))
        if k >= 50:  # now and then one target, deep down: never a long run, and too few of them
            pages = [(i, i * 100, 100, 1 if i < 100 or i % (14 + k % 5) == 0 else 0) for i in range(190)]
        data += [(scope, *p) for p in pages]
        want[scope] = stop_by_loop(pages)
    log = spark.createDataFrame(data, "scope string, page_seq long, offset long, n_rows long, n_new long")
    for block in (500, 8):
        got = {r["scope"]: None if r["reason"] is None else (r["stop_phase"], r["stop_batch"], r["stop_page"], r["reason"], r["run"])
               for r in I.stop_points(log, block=block).collect()}
        assert got == want
    assert len({w[3] for w in want.values() if w}) == 3 and None in want.values()


def test_stop_points_jump_and_empty_log(spark):
    # past 10,000 empty pages do not count, and an all-empty batch ends the run
    pages = [(i, i * 100, 0 if i >= 100 else 100, 1 if i < 100 else 0) for i in range(200)]
    log = spark.createDataFrame([("a", *p) for p in pages], "scope string, page_seq long, offset long, n_rows long, n_new long")
    r = I.stop_points(log).first()
    assert stop_by_loop(pages) == (r["stop_phase"], r["stop_batch"], r["stop_page"], r["reason"], r["run"]) if r["reason"] else stop_by_loop(pages) is None
    assert I.stop_points(log.limit(0)).count() == 0
    assert rows(I.page_spine(log.where("page_seq in (0, 3)")), "scope", "page_seq") == [("a", i) for i in range(4)]


def test_lookup_outcomes(spark):
    from panelkit.operators import lookups as E
    rows_ = spark.createDataFrame([(1, "ok", "Name1"), (2, "empty", "Name1"), (3, "error", "Name1"), (4, "gone", "Name 1"), (5, "gone", "Nobody"),
                                   (6, "gone", "empty!"), (7, "half", "x"), (8, "gone", "error")], "id int, channel_slug string, display_name string")
    lookup = spark.createDataFrame([("ok", "ok", 1, None), ("empty", "empty", None, None), ("error", "error", None, None), ("name1", "ok", 2, 3),
                                    ("half", "ok", None, 4)], "login string, state string, a int, b int")
    got = rows(E.slug_fallback_join(rows_, lookup, ["a", "b"]), "id", "outcome", "matched_by", "a", "b")
    assert got == [(1, "ok", "slug", 1, None), (2, "empty", "slug", None, None), (3, "ok", "name", 2, 3), (4, "ok", "name", 2, 3),
                   (5, "error", None, None, None), (6, "empty", "name", None, None), (7, "ok", "slug", None, 4), (8, "error", None, None, None)]
    plain = rows(E.slug_fallback_join(rows_, lookup.drop("state"), ["a", "b"]), "id", "outcome", "matched_by")
    assert plain[1:3] == [(2, "empty", "slug"), (3, "empty", "slug")] and plain[6] == (7, "ok", "slug")
    alone = rows(E.slug_fallback_join(rows_, lookup, ["a", "b"], fallback_on_miss=False), "id", "outcome", "matched_by")
    assert alone[2:5] == [(3, "error", None), (4, "error", None), (5, "error", None)]


def test_created_lookup_spreads_blank_logins(spark):
    from panelkit.operators import lookups as E
    panel = spark.createDataFrame([(i, "m", "" if i % 2 else f"u{i}", None if i % 3 else "2020-01-01") for i in range(300)],
                                  "channel_id int, month_key string, channel_name string, created string")
    users = spark.createDataFrame([(f"U{i}", "2019-05-05") for i in range(0, 300, 2)], "login string, created_at string")
    out = E.enrich_created(panel, users)
    want = [(i, "2020-01-01" if i % 3 == 0 else None if i % 2 else "2019-05-05") for i in range(300)]
    assert rows(out, "channel_id", "created") == sorted(want) and out.columns == panel.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with parts_kept(spark, 8):
            # the looked-up column is read, or the join would be left out
            found = out.where("channel_name = ''").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("created"))
            sizes = [r["n"] for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) > 4 and max(sizes) < 75


def test_report_scans_the_panel_once(spark):
    from conftest import SMALL
    from panelkit.operators import report as RP
    from panelkit.plans import panel as P
    from panelkit.sources import sinks as SK
    path = SK.scratch_path(spark, "t-report-panel")
    P.enriched_panel(spark, SMALL).write.parquet(path)
    panel = spark.read.parquet(path)
    plan = RP.report_cells(panel)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan
    found = RP.sections(OD.written(RP.report_cells(panel), "t-cells"), len(panel.columns))
    for name, want in (("overview", RP.overview(panel)), ("status_distribution", RP.status_distribution(panel)), ("missingness", RP.missingness(panel)),
                       ("monthly_summary", RP.monthly_summary(panel)), ("created_cohorts", RP.created_cohorts(panel)),
                       ("channel_stats", RP.channel_stats(panel)), ("game_stats", RP.game_stats(panel)),
                       ("top_channels_by_followers", RP.top_channels(panel, 20, "followers")), ("top_games_by_mentions", RP.top_games(panel, 20, "mentions"))):
        assert rows(found[name].select(*want.columns)) == rows(want), name
    empty = RP.report_long(panel.limit(0))
    assert {r["value"] for r in empty.where("section = 'overview' and item <> 'columns_seen'").collect()} == {0.0}


def test_rows_without_values_take_last_places_unshuffled(spark):
    """Rows without any ranked value, or without a cohort, do not go through the join of whole rows."""
    from panelkit.operators import ranks as RK
    schema = "id bigint, year bigint, month string, average_viewers double, peak_viewers bigint, followers bigint, followers_gained bigint"
    data = [(1, 2024, "may", 5.0, None, 7, None), (2, 2024, "may", 5.0, None, None, None), (3, 2024, "may", float("nan"), None, None, None),
            (4, 2024, "may", None, None, None, None), (5, 2024, "june", None, None, None, None), (6, None, "may", 9.0, 9, 9, 9), (7, 2024, None, None, None, None, None)]
    out = RK.cohort_ranks(spark.createDataFrame(data, schema))
    got = {r["id"]: tuple(r[c] for c in RK.COHORT_RANKS.values()) for r in out.collect()}
    assert got == {1: (1, 1, 1, 1), 2: (1, 1, 2, 1), 3: (3, 1, 2, 1), 4: (3, 1, 2, 1), 5: (1, 1, 1, 1), 6: (0, 0, 0, 0), 7: (0, 0, 0, 0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
