"""Property checks against brute force on small random inputs."""
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.operators import games as G
from panelkit.operators import merge as M
from panelkit.operators import report as RP
from panelkit.plans import panel as P

from conftest import SMALL, rows

SEED = "channel_id bigint, month_key string, row_seq bigint, rank_position bigint, average_viewers double"
LIVE = "channel_id bigint, month_key string, page_seq bigint, row_pos bigint, rank bigint, average_viewers double"

seed_rows = st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["a", "b"]), st.integers(0, 5),
                               st.one_of(st.none(), st.integers(-1, 9)),
                               st.one_of(st.none(), st.floats(0, 100, allow_nan=False))),
                     min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1], r[2]))
live_rows = st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["a", "b"]), st.integers(0, 3), st.integers(0, 3),
                               st.integers(1, 900), st.one_of(st.none(), st.floats(0, 100, allow_nan=False))),
                     min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1], r[2], r[3]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed_rows)
def test_last_per_key_brute_force(spark, data):
    got = rows(M.last_per_key(spark.createDataFrame(data, SEED)),
               "channel_id", "month_key", "seed_rank", "seed.average_viewers", "seed_rows")
    want = []
    for key in sorted({(r[0], r[1]) for r in data}):
        grp = sorted((r for r in data if (r[0], r[1]) == key), key=lambda r: r[2])
        pos = [r for r in grp if r[3] is not None and r[3] > 0]
        want.append((key[0], key[1], pos[-1][3] if pos else None, grp[-1][4], len(grp)))
    assert got == sorted(want, key=lambda t: tuple((x is None, x) for x in t))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(live_rows)
def test_live_first_last_brute_force(spark, data):
    got = rows(M.live_first_last(spark.createDataFrame(data, LIVE)),
               "channel_id", "month_key", "live_rank", "live.average_viewers", "live_has")
    want = []
    for key in sorted({(r[0], r[1]) for r in data}):
        grp = sorted((r for r in data if (r[0], r[1]) == key), key=lambda r: (r[2], r[3]))
        valued = [r for r in grp if r[5] is not None]
        want.append((key[0], key[1], grp[0][4], valued[-1][5] if valued else None, bool(valued)))
    assert got == sorted(want, key=lambda t: tuple((x is None, x) for x in t))


def test_panel_invariants(spark):
    p = P.landed_panel(spark, SMALL)
    n = p.count()
    assert n == p.select("channel_id").distinct().count() * p.select("month_key").distinct().count()
    assert p.select("channel_id", "month_key").distinct().count() == n
    # status totals add up to the rows
    assert sum(r["count"] for r in RP.status_distribution(p).collect()) == n
    # merging is idempotent: a second merge of the same keyed sources changes nothing
    assert p.exceptAll(P.landed_panel(spark, SMALL)).count() == 0


def test_game_hours_conserved(spark):
    from panelkit.sources import bindings as B
    g = B.games_rows(spark, SMALL)
    a = G.games_agg(g)
    total_rows = g.agg(F.sum("hours")).first()[0]
    total_agg = a.agg(F.sum("total_hours")).first()[0]
    exploded = RP.game_rows(a).agg(F.sum("hours")).first()[0]
    assert round(total_rows, 6) == round(total_agg, 6) == round(exploded, 6)
    assert a.agg(F.sum("game_count")).first()[0] == g.count()


def test_report_tables_from_written_panel(spark):
    from panelkit.sources import sinks as SK
    e = P.enriched_panel(spark, SMALL)
    direct = P.report_tables(e)
    written = P.report_tables(e, materialize_to=SK.scratch_path(spark, "t-report"))
    for name in ("overview", "status_distribution", "monthly_summary", "top_games_by_hours"):
        assert rows(direct[name]) == rows(written[name]), name


def test_build_panel_from_frames_equals_landed(spark):
    import pytest
    from panelkit.sources import bindings as B
    seed, live = B.seed_rows(spark, SMALL), B.live_rows(spark, SMALL)
    whole = P.landed_panel(spark, SMALL)
    months = seed.select("month_key").distinct()
    mine = P.build_panel(seed, live, channels=B.channels(spark, SMALL))
    assert mine.exceptAll(whole.join(months, "month_key", "left_semi").select(*mine.columns)).isEmpty()
    assert mine.count() == B.channels(spark, SMALL).count() * months.count()
    with pytest.raises(ValueError, match="scope"):
        P.build_panel(seed, live, channels=B.channels(spark, SMALL), months=[])


def test_csv_to_report(spark):
    """Seed CSV and landed pages to a checked, enriched, ranked and reported panel."""
    from panelkit.operators import quality as Q
    from panelkit.operators import ranks as R
    from panelkit.operators import schema as SH
    from panelkit.sources import bindings as B
    from panelkit.sources import payloads as PL
    from panelkit.sources import sinks as SK
    path = SK.scratch_path(spark, "t-seed")
    seed = B.seed_rows(spark, SMALL).withColumns({"channel_slug": F.concat(F.lit("c"), "channel_id"),
                                                 "top_game": F.lit("Chess")})
    text = SH.ensure_columns(seed, {c: (None, "string") for c in SH.SEED_REQUIRED}).select(*SH.SEED_REQUIRED)
    SK.write_csv(text, path)
    fact = SH.read_fact_csv(spark, path)
    live = PL.read_leaderboard(PL.land_leaderboard_pages(B.live_rows(spark, SMALL)))
    panel = P.build_panel(fact, live)
    checked = Q.assert_valid(Q.validate_panel(panel))
    assert checked["rows"] == fact.select("channel_id").distinct().count() * fact.select("month_key").distinct().count()
    assert panel.where("top_game = 'Chess'").count() == fact.select("channel_id", "month_key").distinct().count()
    games = PL.read_games(PL.land_games_pages(B.games_rows(spark, SMALL))).withColumn(
        "pos", F.col("page") * 10 + F.col("idx"))
    final = R.cohort_ranks(P.enrich_panel(panel, games, B.users(spark, SMALL)))
    tables = P.report_tables(final, top_n=3, materialize_to=SK.scratch_path(spark, "t-final"))
    sections = {r["section"] for r in tables["report_long"].select("section").distinct().collect()}
    assert {"overview", "status", "missing", "monthly", "top_channels_by_avg_viewers", "top_games_by_hours"} <= sections
