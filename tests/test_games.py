"""Nested games features, write-back and pies (hand-made rows)."""
import pytest
from pyspark.sql import functions as F

from panelkit.operators import games as G
from panelkit.sources import payloads as PL

from conftest import rows

GAMES = ("channel_id bigint, month_key string, pos bigint, game string, hours double, "
         "peak_viewers bigint, avg_viewers double, view_minutes double")
PANEL = "channel_id bigint, month_key string, hours_streamed double, top_game string, game_count bigint"


def features(spark, games, panel_rows, overwrite=False):
    g = spark.createDataFrame(games, GAMES)
    p = spark.createDataFrame(panel_rows, PANEL)
    out = G.enrich_games(p, G.games_agg(g), overwrite=overwrite)
    return {r["channel_id"]: r for r in out.collect()}


def test_features_rules(spark):
    games = [
        (1, "m", 1, "A", 75.0, 1, 1.0, 1.0), (1, "m", 2, "B", 15.0, 1, 1.0, 1.0), (1, "m", 3, "C", 10.0, 1, 1.0, 1.0),
        (2, "m", 1, "A", 74.0, 1, 1.0, 1.0), (2, "m", 2, "B", 16.0, 1, 1.0, 1.0), (2, "m", 3, "C", 10.0, 1, 1.0, 1.0),
        (3, "m", 1, "A", 50.0, 1, 1.0, 1.0), (3, "m", 2, "B", 50.0, 1, 1.0, 1.0),
        (4, "m", 1, "A", 30.0, 1, 1.0, 1.0), (4, "m", 2, "B", 10.0, 1, 1.0, 1.0),
        (5, "m", 1, "A", 0.0, 1, 1.0, 1.0),
    ]
    panel = [(1, "m", 100.0, None, None), (2, "m", 100.0, None, None), (3, "m", 100.0, None, None),
             (4, "m", 0.0, None, None), (5, "m", None, None, None), (6, "m", 1.0, "keep", 3)]
    f = features(spark, games, panel)
    assert (f[1]["top_game_pct"], f[1]["is_variety_streamer"]) == (75.0, False)
    assert (f[2]["top_game_pct"], f[2]["is_variety_streamer"]) == (74.0, True)
    assert (f[3]["top_game"], f[3]["is_variety_streamer"]) == ("A", False)   # tie: first in source order
    assert f[4]["top_game_pct"] == 75.0                                      # denominator = total hours
    assert f[5]["top_game_pct"] == 0.0                                       # total 0
    assert (f[6]["top_game"], f[6]["game_count"]) == ("keep", 3)             # no games result: kept
    assert [g["game"] for g in f[3]["games_by_stream_time"]] == ["A", "B"]
    assert f[1]["all_games"][0].asDict() == {"game": "A", "hours": 75.0, "peak_viewers": 1,
                                             "avg_viewers": 1.0, "view_minutes": 1.0}


def test_fill_blank_vs_overwrite(spark):
    games = [(1, "m", 1, "New", 5.0, 1, 1.0, 1.0)]
    panel = [(1, "m", 10.0, "Old", None), (2, "m", 10.0, " ", None)]
    f = features(spark, games + [(2, "m", 1, "New2", 5.0, 1, 1.0, 1.0)], panel)
    assert f[1]["top_game"] == "Old" and f[1]["game_count"] == 1   # only blank cells filled
    assert f[2]["top_game"] == "New2"                               # whitespace counts as blank
    f = features(spark, games, panel, overwrite=True)
    assert f[1]["top_game"] == "New"


def test_needs_games(spark):
    df = spark.createDataFrame([(1, None, ""), (2, "[]", None)], "id int, all_games_json string, games_by_stream_time_json string")
    assert rows(G.needs_games(df), "id") == [(1,)]
    assert G.needs_games(df, overwrite=True).count() == 2


def test_pie_top5_other(spark):
    payload = '{"data":{"labels":["A","B","C","D","E","F","G"],"datasets":[{"data":[40,36,32,28,24,20,4]}]}}'
    five = '{"data":{"labels":["A","B","C","D","E"],"datasets":[{"data":[4,4,4,4,4]}]}}'
    bad = '{"data":{"labels":["A"]}}'
    pies = spark.createDataFrame([(1, "m", payload), (2, "m", five), (3, "m", bad)],
                                 "channel_id bigint, month_key string, payload string")
    got = rows(G.pie_top5_other(PL.read_pies(pies), ["channel_id", "month_key"]), "channel_id", "slot", "label", "value")
    assert got == [(1, 1, "A", 10.0), (1, 2, "B", 9.0), (1, 3, "C", 8.0), (1, 4, "D", 7.0), (1, 5, "E", 6.0),
                   (1, 6, "Other", 6.0), (2, 1, "A", 1.0), (2, 2, "B", 1.0), (2, 3, "C", 1.0), (2, 4, "D", 1.0),
                   (2, 5, "E", 1.0)]
    tops = {r["channel_id"]: [tuple(x) for x in r["top"]] for r in PL.read_pie_tops(pies).collect()}
    assert tops == {1: [("A", 10.0), ("B", 9.0), ("C", 8.0), ("D", 7.0), ("E", 6.0), ("Other", 6.0)],
                    2: [(c, 1.0) for c in "ABCDE"], 3: []}
