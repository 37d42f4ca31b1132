"""What a panel leaves on the disk: its rows are not shuffled, and a step's shuffle files go once its result is written."""

import datetime as dt
import time

from pyspark.sql import functions as F

from conftest import SMALL, rows

from panelkit.operators import games as G
from panelkit.operators import merge as M
from panelkit.operators import ordering as OD
from panelkit.operators import scaffold as SC
from panelkit.plans import panel as P
from panelkit.sources import bindings as B

MONTHS = [dt.date(2024, 3, 1), dt.date(2024, 4, 1)]


def test_months_attached_per_channel_equal_the_join(spark):
    channels = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n"), (3, None)], "channel_id long, channel_name string") \
        .withColumn("display_name", F.lit("x"))
    seed = spark.createDataFrame([
        (1, "2024march", 0, 3, 1.5), (1, "2024march", 1, 0, 2.5), (2, "2024april", 0, 7, None), (2, "2024may", 0, 1, 9.0),
        (9, "2024march", 0, 1, 9.0), (None, "2024march", 0, 2, 4.0), (None, "2024march", 1, 2, 4.0), (3, None, 0, 1, 6.0)],
        "channel_id long, month_key string, row_seq long, rank_position long, average_viewers double")
    keyed = M.last_per_key(seed).withColumns({"live_rank": F.lit(None).cast("long"), "live_has": F.lit(False), "live": F.struct(
        *[F.lit(None).cast(M._TYPES[c]).alias(c) for c in M.LIVE_METRICS])})
    agg = G.games_agg(spark.createDataFrame([
        (1, "2024april", 0, "g", 2.0, 3, 1.0, 5.0), (1, "2024april", 1, "h", 2.0, 3, 4.0, 5.0), (None, "2024april", 0, "g", 1.0, 1, 1.0, 1.0),
        (2, None, 0, "g", 1.0, 1, 1.0, 1.0)],
        "channel_id long, month_key string, pos long, game string, hours double, peak_viewers long, avg_viewers double, view_minutes double"))
    joined = G.enrich_games(M.merge_sources(SC.panel_scaffold(channels, MONTHS), keyed, None), agg)
    attached = SC.attach_months(SC.attach_months(channels, keyed, M.CARRIED), agg, G.CARRIED)
    scaffold = SC.at_month(SC.at_month(SC.panel_scaffold(attached, MONTHS), M.CARRIED), G.CARRIED)
    carried = G.enrich_games(M.merge_sources(scaffold, None, None, keep=(G.CARRIED,)), None)
    assert carried.columns == joined.columns and carried.count() == 10
    assert rows(carried, F.to_json(F.struct("*"))) == rows(joined, F.to_json(F.struct("*")))


def test_panel_rows_are_not_shuffled(spark):
    for panel in (P.landed_panel(spark, SMALL), P.enriched_panel(spark, SMALL, lists=("all_games",))):
        plan = panel._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Exchange")  # the months are spread above the last shuffle


def test_shuffle_files_go_once_a_step_is_written(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}
    kept = spark.conf.get(OD._FREE_SHUFFLES, None)
    before = files()
    back = OD.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")), "free")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(OD._FREE_SHUFFLES, None) == kept
    assert back.agg(F.sum("n")).first()[0] == 1000


def test_lines_are_shuffled_before_the_panel_is_made(spark):
    """The enriched panel reads its games from a written step: the shuffles of the lines have gone by then."""
    plan = P.enriched_panel(spark, SMALL, lists=("all_games",))._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "/games-" in plan


def test_games_rows_are_the_same_with_parts_joined_first_and_written(spark):
    lazy = B.games_rows(spark, SMALL, with_pos=False)
    for values in (B.GAME_VALUES, ("hours", "view_minutes")):
        by_channel = B.games_rows(spark, SMALL, with_pos=False, partitions=3, values=values)
        assert by_channel.columns == [c for c in lazy.columns if c not in B.GAME_VALUES or c in values]
        assert rows(by_channel) == rows(lazy, *by_channel.columns)
