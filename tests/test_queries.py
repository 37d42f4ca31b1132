"""Registered queries: oracle agreement on the smallest tables, plan shape checks."""
import os
import sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

import __spark_entry__ as ent
from conftest import SMALL
from panelkit.plans import catalog

sys_oracle = pytest.importorskip("duckdb")

FAST = ["panel_full", "monthly_summary", "enrich_games", "cohort_ranks", "channel_stats",
        "top_channels_by_avg_viewers", "game_stats", "pie_top5_other", "payload_leaderboard",
        "payload_channel", "games_parse", "error_bursts", "zero_yield_cutoff", "ttl_latest",
        "slug_fallback_join", "missingness", "validate_panel", "games_text_forms", "monthly_leaderboard",
        "scan_stop_points", "games_pages_complete", "games_page_gaps", "phase1_record", "slug_lookup_outcomes",
        "report_long", "rank_histogram", "low_coverage_months", "stream_dedupe", "stream_error_bursts_exact"]
NAMES = list(ent.oracle_sql()) if os.environ.get("PANELKIT_ALL_QUERIES") else FAST


@pytest.fixture(scope="module")
def con():
    from oracle_check import duck
    return duck(SMALL)


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["month_key", "rows", "rank_coverage", "panel_coverage", "avg_viewers_mean",
                          "hours_watched_mean"]
    assert df.count() > 0


def test_every_panel_query_has_oracle():
    """The optional corpus queries may have no SQL form; every panel query has one."""
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(ent.queries())
    assert set(catalog.SQL) <= set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    from oracle_check import compare
    msg = compare(spark, con, name, ent.queries()[name], ent.oracle_sql()[name], SMALL)
    assert msg.startswith("OK"), msg


@pytest.mark.parametrize("name", ["panel_full", "enrich_games", "report_long", "payload_leaderboard",
                                  "top_channels_by_hours_watched", "error_bursts"])
def test_plan_shape(spark, name):
    plan = _plan(ent.queries()[name](spark, SMALL))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name.startswith("top_channels"):
        assert "TakeOrderedAndProject" in plan


def _plan(df):
    # a fresh QueryExecution: the initial physical plan, not a finished adaptive one
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark):
    df = ent.queries()["panel_full"](spark, SMALL)
    plan = _plan(df)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double," in plan
    # one orders scan serves both seed and live rows (plus the month bounds subquery)
    assert plan.count("orders.parquet") <= 3
    bursts = _plan(ent.queries()["error_bursts"](spark, SMALL))
    assert "EqualTo(event_type,error)" in bursts
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in bursts


PLAN_ONLY = [n for n in catalog.QUERIES if not n.startswith("stream_")
             and n not in ("write_read_partitioned", "incremental_run", "cohort_ranks_range")]


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_udf_or_cartesian_anywhere(spark, name):
    plan = _plan(ent.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)
