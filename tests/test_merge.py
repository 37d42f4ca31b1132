"""Seed/live precedence, status rules and panel checks on hand-made rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.operators import merge as M
from panelkit.operators import quality as Q
from panelkit.operators import scaffold as SC

from conftest import rows

SEED = ("channel_id bigint, month_key string, row_seq bigint, rank_position bigint, "
        "average_viewers double, hours_watched double, followers bigint")
LIVE = ("channel_id bigint, month_key string, page_seq bigint, row_pos bigint, rank bigint, "
        "average_viewers double, hours_watched double, language string")


def scaffold(spark, ids=(1, 2, 3, 4, 5)):
    ch = spark.createDataFrame([(i, f"c{i}", f"C{i}") for i in ids],
                               "channel_id bigint, channel_name string, display_name string")
    return SC.panel_scaffold(ch, [dt.date(2024, 3, 1), dt.date(2024, 4, 1)])


def test_scaffold_is_gap_free(spark):
    sc = scaffold(spark)
    assert sc.count() == 10
    assert sc.select("channel_id", "month_key").distinct().count() == 10
    assert set(r[0] for r in sc.select("month_key").distinct().collect()) == {"2024march", "2024april"}


def test_last_per_key(spark):
    seed = spark.createDataFrame([
        (2, "2024march", 0, 10, 1.0, 1.0, 5),
        (2, "2024march", 1, 0, 2.0, None, 6),   # later row: its metrics win whole, its rank 0 does not
    ], SEED)
    k = M.last_per_key(seed).select("seed_rank", "seed.average_viewers", "seed.hours_watched",
                                    "seed.followers", "seed_rows").first()
    assert tuple(k) == (10, 2.0, None, 6, 2)


def test_live_first_rank_last_metrics(spark):
    live = spark.createDataFrame([
        (7, "2024march", 0, 5, 5, 100.0, 1.0, "en"),
        (7, "2024march", 1, 2, 102, 90.0, None, None),
        (7, "2024march", 2, 1, 201, None, None, None),   # no value: never the metrics row
    ], LIVE)
    k = M.live_first_last(live).select("live_rank", "live.average_viewers", "live.language", "live_has").first()
    assert tuple(k) == (5, 90.0, None, True)


def test_merge_precedence_and_status(spark):
    sc = scaffold(spark)
    seed = spark.createDataFrame([
        (1, "2024march", 0, 3, None, None, None),     # seed row with all-null metrics
        (2, "2024march", 0, 10, 50.0, 5.0, 9),
        (3, "2024march", 0, 0, 20.0, None, 1),        # no valid seed rank
    ], SEED)
    live = spark.createDataFrame([
        (2, "2024march", 0, 1, 1, 70.0, None, "de"),  # live rank ignored (seeded), metrics win per field
        (3, "2024march", 0, 2, 700, 30.0, 3.0, None),
        (4, "2024march", 0, 3, 4, None, None, None),  # ranked, no metrics anywhere
    ], LIVE)
    p = M.merge_sources(sc, M.last_per_key(seed), M.live_first_last(live), top_k=500)
    got = {r["channel_id"]: r for r in p.where("month_key = '2024march'").collect()}
    assert got[1]["status"] == "active_top500" and got[1]["source"] == "csv"
    assert got[2]["rank"] == 10 and got[2]["average_viewers"] == 70.0 and got[2]["hours_watched"] == 5.0
    assert got[2]["language"] == "de" and got[2]["source"] == "leaderboard"
    assert got[3]["rank"] == 700 and got[3]["status"] == "active_not_top500"
    assert got[4]["rank"] == 4 and got[4]["status"] == "inactive" and got[4]["source"] is None
    assert got[5]["status"] == "inactive"
    p2 = M.merge_sources(sc, M.last_per_key(seed), M.live_first_last(live), top_k=500, active_rule="any_metric")
    assert p2.where("channel_id = 1 AND month_key = '2024march'").first()["status"] == "inactive"
    # the ranked row without metrics is reported, the panel checks pass
    assert rows(Q.ranked_missing_metrics(p), "channel_id", "month_key") == [(1, "2024march"), (4, "2024march")]
    report = Q.validate_panel(p, 10)
    r = Q.assert_valid(report)
    assert r["rows"] == 10 and r["duplicate_keys"] == 0 and r["ranked_missing_metrics"] == 2


def test_validate_panel_raises(spark):
    sc = scaffold(spark, (1,))
    dup = sc.unionByName(sc.limit(1)).withColumn("rank", F.lit(None).cast("bigint"))
    for c in ("average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained", "peak_viewers"):
        dup = dup.withColumn(c, F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="channels x months"):
        Q.assert_valid(Q.validate_panel(dup, 2))
    with pytest.raises(ValueError, match="more than once"):
        Q.assert_valid(Q.validate_panel(dup, 3))
    bad = sc.withColumn("rank", F.lit(0).cast("bigint"))
    for c in ("average_viewers", "hours_watched", "hours_streamed", "followers", "followers_gained", "peak_viewers"):
        bad = bad.withColumn(c, F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="rank below 1"):
        Q.assert_valid(Q.validate_panel(bad, 2))


def test_first_per_channel(spark):
    df = spark.createDataFrame([(3, 2, "B"), (3, 1, "A"), (4, 5, "Z")], "channel_id bigint, seq int, name string")
    assert rows(SC.first_per_channel(df, ["seq"]), "channel_id", "name") == [(3, "A"), (4, "Z")]


def test_keyed_sources_keeps_all_seed_fields(spark):
    row = spark.createDataFrame([(1, "2024march")], "channel_id bigint, month_key string").select(
        "*", F.lit(True).alias("is_seed"), F.lit(False).alias("is_live"),
        F.struct(F.lit(0).cast("bigint").alias("row_seq"), F.lit(3).cast("bigint").alias("rank_position"),
                 F.lit("Chess").alias("top_game"), F.lit(7).cast("bigint").alias("follower_rank")).alias("seed_row"),
        F.struct(F.lit(0).alias("page_seq"), F.lit(0).alias("row_pos"), F.lit(None).cast("bigint").alias("rank"),
                 *[F.lit(None).cast(M._TYPES[c]).alias(c) for c in M.LIVE_METRICS]).alias("live_row"))
    got = M.keyed_sources(row).select("seed.top_game", "seed.follower_rank", "seed.followers", "seed_rank").first()
    assert tuple(got) == ("Chess", 7, None, 3)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_filter_never_broadcasts_the_scaffold(spark):
    """A size estimate leaves out the months of a scaffold: an inner join must not build its hash table from it."""
    from panelkit.operators import games as G
    keyed = M.last_per_key(spark.createDataFrame([(2, "2024march", 0, 10, 1.0, 1.0, 5)], SEED)).withColumns(
        {"live_rank": F.lit(None).cast("bigint"), "live_has": F.lit(False),
         "live": F.struct(*[F.lit(None).cast(M._TYPES[f]).alias(f) for f in M.LIVE_METRICS])})
    panel = M.merge_sources(scaffold(spark), keyed, None)
    assert "BuildLeft" not in plan_of(panel.where("rank is not null").select("channel_id"))
    agg = G.games_agg(spark.createDataFrame([(2, "2024march", "G", 1.0, 1, 1.0, 1.0, 1)],
                                            "channel_id bigint, month_key string, game string, hours double, "
                                            "peak_viewers bigint, avg_viewers double, view_minutes double, pos bigint"))
    played = G.enrich_games(panel, agg).select(F.explode("all_games").alias("g"))
    assert "BuildLeft" not in plan_of(played)
    assert played.count() == 1


def test_scaffold_except_is_except_all(spark):
    """Channels may repeat or be null: of a key's rows one goes for a found key, as EXCEPT ALL of distinct keys has it."""
    ch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n"), (4, "d")], "channel_id bigint, channel_name string")
    months = [dt.date(2024, 3, 1), dt.date(2024, 4, 1)]
    found = spark.createDataFrame([(1, "2024march"), (1, "2024march"), (2, "2024april"), (None, "2024april"), (9, "2024march"), (4, None)],
                                  "channel_id bigint, month_key string")
    out = SC.scaffold_except(ch, months, found)
    want = SC.panel_scaffold(ch, months).select("channel_id", "month_key").exceptAll(found.distinct())
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    plan = plan_of(out)
    assert "Exchange" not in plan[:plan.index("Generate explode([")]  # nothing made of the scaffold is shuffled
