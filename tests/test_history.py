"""Reports from a history that was kept in steps."""

import re
from datetime import date, datetime

import pytest
from build import JULY, day, given, tables
from pyspark.sql import functions as F

from test_together import SEVERAL, VARIANTS, by_tag, scans, stored  # noqa: F401
from trialmetrics import registry
from trialmetrics.experiment import Experiments
from trialmetrics.operators import assignment
from trialmetrics.operators.activity import is_active
from trialmetrics.operators.history import History
from trialmetrics.operators.windows import Days

NAMES = ["retention_new", "retention_active", "retention_country", "order_value", "revenue_per_paying_user", "lifetime_value", "follows",
         "click_rate", "regenerations", "edits_of_phase", "explore_click_rate", "recall_impressions", "revenue_per_user"]
CUTS = [datetime(1970, 1, 1), datetime(2024, 1, 9), datetime(2024, 1, 21), datetime(2100, 1, 1)]


@pytest.fixture(scope="module")
def kept(spark, stored, tmp_path_factory):  # noqa: F811
    """Three steps by day. Some rows come a step late and others twice; the first two partials are merged."""
    history = History(spark, str(tmp_path_factory.mktemp("history")))
    for i, (start, end) in enumerate(zip(CUTS, CUTS[1:])):
        def new(name, day_):
            rows, bounds = stored[name], (F.lit(start.date()), F.lit(end.date()))
            late = F.pmod(F.xxhash64("user_id", day_), F.lit(5)) == 0
            arrived = F.when(late, F.date_add(day_, 12)).otherwise(F.col(day_))
            again = F.pmod(F.xxhash64("user_id", day_), F.lit(7)) == 0
            inside = (arrived >= bounds[0]) & (arrived < bounds[1])
            return rows.filter(inside | again & (F.lit(i) == 2) & (arrived < bounds[1]))

        events = stored["app_event"].filter(F.pmod(F.xxhash64("user_id", "geo"), F.lit(3)) == i)
        history.add(new("active", "active_date"), new("assignment", "event_date"), events)
        if i == 1:
            history.compact()
    return stored.with_history(history)


@pytest.mark.parametrize("name", NAMES)
def test_reports_from_history(stored, kept, name):  # noqa: F811
    for exp in (SEVERAL[0], SEVERAL[3], Experiments(SEVERAL)):
        found = by_tag(registry.REPORTS[name](kept, exp))
        assert found == by_tag(registry.REPORTS[name](stored, exp))


@pytest.mark.parametrize("name", ["strict bounds", "strict bounds of active users", "raw totals", "parts"])
def test_variants_from_history(stored, kept, name):  # noqa: F811
    for exp in (SEVERAL[0], Experiments(SEVERAL)):
        assert by_tag(VARIANTS[name](kept, exp)) == by_tag(VARIANTS[name](stored, exp))


@pytest.mark.parametrize("policy", ["user_first", "user_latest_day", "user_first_day", "any"])
def test_assignments_from_history(stored, kept, policy):  # noqa: F811
    for exp in (SEVERAL[0], Experiments(SEVERAL)):
        found = assignment.resolve(kept, exp, policy)
        assert by_tag(found) == by_tag(assignment.resolve(stored, exp, policy))
        assert set(scans(found)) == {"data"}  # folders of the history's writes, not the table


def test_history_is_not_read_again(spark, kept):
    """Of the assignments only rows of the phase are read, and activity and app events not at all."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    plan = registry.REPORTS["retention_country"](kept, SEVERAL[0])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    files = [line for line in plan.splitlines() if "FileScan" in line]
    raw = [line for line in files if re.search(r"/assignment\]", line)]
    assert len(raw) == 1 and "GreaterThanOrEqual(timestamp_assigned,2024-01-02" in raw[0]
    assert not any(re.search(r"/(active|app_event)\]", line) for line in files)
    assert all("PushedFilters: [IsNotNull(word), GreaterThanOrEqual(word," in line for line in files if "word" in line)


def test_partials_are_merged_whatever_their_order(spark, tmp_path):
    rows = [given("u", 1, 5), given("u", 0, 3), given("u", None, 3, hour=11), given("v", 1, 9), given("w", None, 4)]
    undated = {**given("v", 0, 2), "event_date": None}
    wanted = tables(spark, assignment=[*rows, undated])
    for order in ([0, 1, 2], [2, 0, 1]):
        history = History(spark, f"{tmp_path}/{order[0]}")
        steps = [rows[:2], rows[1:4], [rows[4], undated, rows[0]]]
        for i in order:
            history.add(assignments=tables(spark, assignment=steps[i])["assignment"])
        found = wanted.with_history(history)
        for policy in ("user_first", "user_latest_day", "user_first_day", "any"):
            assert by_tag(assignment.resolve(found, JULY, policy)) == by_tag(assignment.resolve(wanted, JULY, policy))
        assert by_tag(assignment.variations(found, JULY)) == by_tag(assignment.variations(wanted, JULY))


def test_words_of_bits(spark, tmp_path):
    """Days on both sides of the ends of words, and days before 1970."""
    days = [date(1969, 12, 31), date(1970, 1, 1), date(1970, 3, 5), date(1970, 3, 6), date(1970, 5, 8), date(1970, 5, 9)]
    active = tables(spark, active=[{"user_id": "u", "active_date": d, "keep_alive_flag": 1} for d in days]
                    + [{"user_id": u, "active_date": d, "keep_alive_flag": f} for u, d, f in (("u", day(1), 0), ("", day(1), 1), (None, day(1), 1))])["active"]
    history = History(spark, str(tmp_path))
    history.add(active=active)
    bits, origin = history.active_bits(Days(days[0], days[-1]))
    rows = bits.withColumn("day", F.explode(F.sequence(F.lit(days[0]), F.lit(days[-1]))))
    found = rows.filter(F.expr(is_active(f"datediff(day, DATE '{origin}')"))).select("day").collect()
    assert sorted(r.day for r in found) == days and {r.user_id for r in bits.collect()} == {"u"}


def test_a_run_with_history_shares_it(kept, tmp_path):
    run = registry.run_all(kept, SEVERAL[:2], str(tmp_path), ["order_value"])
    assert not run.failures and kept.sharing().history is kept.history
