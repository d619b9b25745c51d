"""How the plans behave when data are large or one key holds a third of them."""

import re

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from oracles.queries import queries
from oracles.sql import oracle_sql
from trialmetrics import Tables
from trialmetrics.plans import chat
from trialmetrics.sources.fixtures import PHASE, fixture_tables

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()
PYTHON = {"r6_new_user_report", "r7_active_user_report", "r6_new_user_report_wins", "r7_active_user_report_wins",
          "r8_new_user_overall", "r9_active_user_overall", "r9_active_user_overall_uncut",
          "r8_new_user_overall_hard", "g3_recharge_evaluation", "v2_ads_evaluation", "t2_beta_comparison", "t2_beta_interval", "t3_assumed_normal_win", "t7_regression_p_values", "t8_mean_tests_p_values",
          "t9_posterior_difference_probability", "t10_bootstrap", "t11_rank_test_p_value"}
# Written before they are returned, so that the plan is a scan of the result.
WRITTEN = {"m8_m10_stored_and_looked_up", "s3_exported_documents", "s4_s5_csv_round_trip", "s6_published_twice"}


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITTEN))
def test_plans(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Broadcast" not in plan
    assert ("Python" in plan or "MapInPandas" in plan or "ArrowEval" in plan) == (name in PYTHON)
    for columns in re.findall(r"events.parquet\].*?ReadSchema: struct<([^>]*)>", plan):
        assert "props" not in columns
    # Only aggregates (one row per variation, bucket or resample) meet in one partition.
    for step in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "partial_" in step or "Aggregate(keys=[variation" in step or "Project [variation" in step \
            or "Aggregate(keys=[bucket" in step or "Project [rate" in step, step


def test_days_prune_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(QUERIES["e1_continues"](spark, FOLDER))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("GreaterThanOrEqual(ts,2024-01-03") == 2 and plan.count("LessThan(ts,2024-01-28") == 2


def test_click_rate_reads_assignments_of_its_days(spark, tmp_path):
    """Of other days only the variations are read, not the users."""
    plain = fixture_tables(spark, FOLDER)
    plain["assignment"].write.parquet(f"{tmp_path}/assignment")
    t = Tables(spark, lambda name: Tables.in_folder(spark, str(tmp_path))[name] if name == "assignment" else plain[name])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(chat.click_rate(t, PHASE))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "variation_id" in line]
    assert len(scans) == 2
    for scan in scans:
        assert ("timestamp_assigned" in scan.split("ReadSchema")[1]) == ("GreaterThanOrEqual(event_date,2024-01-03)" in scan)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The test tables with a third of all events given to one user."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    moved = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 4).otherwise(F.col("user_id")))
    moved.select(events.columns).coalesce(1).write.parquet(f"{folder}/events")
    for name in ("nation", "region", "orders"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").coalesce(1).write.parquet(f"{folder}/{name}")
    from pathlib import Path

    for written in list(Path(folder).iterdir()):
        part = next(written.glob("*.parquet"))
        part.rename(f"{folder}/{written.name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["r1_new_user_retention", "r2_active_user_retention", "b4_revenue_per_user", "b6_lifetime_value",
                                  "b10_cancellation_rate", "u1_subscription_orders_fanout", "e1_continues", "e5_new_conversations",
                                  "c1_click_rate", "c2_start_rate", "c3_chat_depth", "c7_explore_click_rate", "g1_recharge", "v1_ads"])
def test_one_user_with_a_third_of_all_events(spark, no_broadcast, skewed, name):
    assert difference(QUERIES[name](spark, skewed), connect(skewed), SQL[name]) is None


@pytest.mark.parametrize("name", ["e1_continues", "c2_start_rate", "b4_revenue_per_user", "r2_active_user_retention"])
def test_a_heavy_user_reaches_the_joins_as_one_row_per_day(spark, no_broadcast, skewed, name):
    """No join reads the events of one user side by side: its inputs are grouped by user (and day)."""
    plan = plan_of(QUERIES[name](spark, skewed))
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    assert joins
    for i in joins:
        below = [line for line in lines[i + 1:] if "Aggregate(keys=[user_id" in line or "Aggregate(key=[user_id" in line]
        assert below
