"""Plans of steps that must not grow faster than their input."""

from pyspark.sql import functions as F

from conftest import SMALL, rows

from panelkit.operators import lookups as E
from panelkit.operators import ranks as R
from panelkit.plans import catalog, catalog_more  # noqa: F401
from panelkit.plans import panel as P
from panelkit.sources import payloads as PL
from panelkit.streaming.state import KeyedState


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_games_items_are_parsed_once(spark):
    pages = spark.createDataFrame([
        (1, "2024march", 0, ' \n[{"gamesplayed": "A|a", "streamtime": "1,200", "avgviewers": "7 "}, 3]'),
        (1, "2024march", 1, '{"recordsTotal": 4, "data": [{"title": "B", "streamtime": "x"}]}'),
    ], "channel_id long, month_key string, page long, payload string")
    for read in (PL.read_games, PL.read_games_ingest):
        assert _plan(read(pages)).count("MapType(StringType") == 1
    assert rows(PL.read_games(pages), "page", "idx", "game", "hours", "avg_viewers") == [(0, 1, "A", 20.0, 7.0), (1, 1, "B", 0.0, None)]
    counted = PL.games_pages_complete(pages)
    assert rows(counted, "pages", "rows", "records_total", "complete") == [(2, 2, 4, False)]
    # the total is read per page: below the explode of its items
    plan = _plan(counted)
    assert plan.index("posexplode") < plan.index("get_json_object")


def test_created_is_looked_up_per_channel(spark):
    plan = P.enriched_panel(spark, SMALL, lists=())._jdf.queryExecution().analyzed().toString()
    assert plan.index("month_start") < plan.index("_login")  # the scaffold is made above the lookup
    channels = spark.createDataFrame([(1, "a"), (1, "a"), (2, ""), (None, None), (3, "z")], "channel_id long, channel_name string")
    users = spark.createDataFrame([("A", "2020"), ("a", "2021"), ("z", " ")], "login string, created_at string")
    looked = E.attach_created(channels, users, only_blank=False)
    for old in (None, " ", "2001"):
        panel = channels.withColumn("created", F.lit(old).cast("string"))
        kept = looked.withColumn("created", F.lit(old).cast("string"))
        assert rows(E.fill_created(kept), *panel.columns) == rows(E.enrich_created(panel, users))


def test_leaderboard_counts_are_not_broadcast(spark):
    df = spark.createDataFrame([(1, "m", 5.0), (2, "m", 5.0), (3, "m", None), (4, "n", 1.0)], "channel_id long, m string, v double")
    out = R.bucketed_leaderboard(df, "v", ["m"])
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out, "channel_id", "rank") == [(1, 1), (2, 2), (3, 3), (4, 1)]


def test_filtered_panels_broadcast_nothing(spark):
    """A status or metric filter makes the scaffold's join an inner one: neither its rows nor the boards' counts may go
    through the driver, in the plan as it ends too."""
    for name in ("status_filter", "ranked_missing_metrics", "rows_with_any_metric"):
        df = catalog.QUERIES[name](spark, SMALL)
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString(), name


def test_state_is_written_by_no_more_tasks_than_buckets(spark, tmp_path):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a micro-batch with state
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    sc = spark.sparkContext
    try:
        sc.setJobGroup("state-append", "")
        state = KeyedState(str(tmp_path / "s"), ("k",), buckets=2)
        state.append(spark.range(0, 50, 1, 1).select(F.col("id").alias("k")), 0)
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("state-append") for s in tracker.getJobInfo(j).stageIds]
        assert max(i.numTasks for i in map(tracker.getStageInfo, stages) if i) <= 2
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in kept.items():
            spark.conf.set(k, v)
    schema = spark.range(1).select(F.col("id").alias("k")).schema
    assert state.read(spark, schema).count() == 50
