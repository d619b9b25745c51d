"""Bad records set apart, and tables stored by user."""

import json

import pytest
from build import day

from test_together import by_tag
from trialmetrics import Tables, registry
from trialmetrics.experiment import Experiments
from trialmetrics.plans import catalog
from trialmetrics.sources import bucketed
from trialmetrics.sources.documents import read_experiment_documents
from trialmetrics.sources.fixtures import PHASE, fixture_tables
from trialmetrics.sources.quarantine import Quarantine, TooManyBadRecords

FOLDER = "/root/testdata/sf0.001"
HEADER = "event_id,user_id,event_date,revenue,is_first_flux\n"
GOOD = ["1,u,2024-07-02,1.5,0", "2,v,2024-07-03,,1", "3,,2024-07-03,2.0,"]
BAD = ["4,u,2024-07-32,1.0,0", "5,u,2024-07-02,much,no", "6,u,2024-07-02,1.0", "7,u,2024-07-02,1.0,0,more"]


def csv_table(folder, *files):
    (folder / "currency").mkdir(parents=True)
    for i, lines in enumerate(files):
        (folder / "currency" / f"part{i}.csv").write_text(HEADER + "\n".join(lines) + "\n")
    return str(folder)


def test_bad_lines_are_set_apart(spark, tmp_path):
    root = csv_table(tmp_path / "in", [GOOD[0], BAD[0], GOOD[1]], [BAD[1], BAD[2], BAD[3], GOOD[2]])
    quarantine = Quarantine(str(tmp_path / "bad"), at_most=4)
    found = Tables.in_folder(spark, root, "csv", quarantine=quarantine)["currency"]
    assert sorted((r.event_id, r.event_date, r.revenue, r.is_first_flux) for r in found.collect()) == [
        ("1", day(2), 1.5, 0), ("2", day(3), None, 1), ("3", day(3), 2.0, None)]
    bad = {(r.file.rsplit("/", 1)[1], r.reason): r.record for r in quarantine.bad(spark, "currency").collect()}
    assert set(bad) == {("part0.csv", "event_date is no date: 2024-07-32"), ("part1.csv", "not a line of the table"),
                        ("part1.csv", "revenue is no double: much; is_first_flux is no int: no")}
    assert quarantine.bad(spark, "currency").count() == 4
    assert json.loads(bad["part0.csv", "event_date is no date: 2024-07-32"])["event_id"] == "4"


def test_more_bad_records_than_stated_are_an_error(spark, tmp_path):
    root = csv_table(tmp_path / "in", GOOD, BAD)
    quarantine = Quarantine(str(tmp_path / "bad"), at_most=3)
    with pytest.raises(TooManyBadRecords, match="4 records of currency"):
        Tables.in_folder(spark, root, "csv", quarantine=quarantine)["currency"]
    assert quarantine.bad(spark, "currency").count() == 4
    with pytest.raises(Exception):
        Tables.in_folder(spark, root, "csv")["currency"].collect()


def test_nothing_bad(spark, tmp_path):
    root = csv_table(tmp_path / "in", GOOD)
    quarantine = Quarantine(str(tmp_path / "bad"), at_most=0)
    assert Tables.in_folder(spark, root, "csv", quarantine=quarantine)["currency"].count() == 3
    assert quarantine.bad(spark, "currency").count() == 0


def test_typed_files_with_values_that_do_not_fit(spark, tmp_path):
    spark.createDataFrame([("u", "2024-07-02", "1"), ("v", "some day", "1"), ("w", None, "yes")], "user_id string, active_date string, keep_alive_flag string") \
        .write.parquet(str(tmp_path / "in" / "active"))
    quarantine = Quarantine(str(tmp_path / "bad"), at_most=2)
    found = Tables.in_folder(spark, str(tmp_path / "in"), quarantine=quarantine)["active"]
    assert [tuple(r) for r in found.collect()] == [("u", day(2), 1)]
    assert {r.reason for r in quarantine.bad(spark, "active").collect()} == {"active_date is no date: some day", "keep_alive_flag is no int: yes"}


def test_a_response_that_is_cut_short_is_set_apart(spark, tmp_path):
    page = {"offset": 0, "experiments": [{"name": "x", "tags": ["a"], "variations": [], "phases": []}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "in" / "b.json").write_text(json.dumps(page)[:-30])
    quarantine = Quarantine(str(tmp_path / "bad"), at_most=1)
    found = read_experiment_documents(spark, str(tmp_path / "in"), quarantine=quarantine)
    assert [r.tag for r in catalog.by_tag(found).collect()] == ["a"]
    (bad,) = quarantine.bad(spark, "documents").collect()
    assert bad.file.endswith("b.json") and bad.reason == "not a response" and '"experiments"' in bad.record


@pytest.fixture(scope="module")
def by_user(spark, tmp_path_factory):
    """The fixtures in eight buckets by user, and plain."""
    spark.sql(f"CREATE DATABASE by_user LOCATION '{tmp_path_factory.mktemp('by_user')}'")
    keys = {**bucketed.SETTINGS, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    plain = fixture_tables(spark, FOLDER)
    yield bucketed.store_by_user(plain, "by_user", 8), plain
    for key in keys:
        spark.conf.unset(key)
    spark.sql("DROP DATABASE by_user CASCADE")


REPORTS = ["retention_active", "retention_new", "revenue_per_user", "order_value", "chat_depth", "subscription_orders", "continues", "click_rate"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_of_tables_stored_by_user(by_user, name):
    stored, plain = by_user
    job = registry.REPORTS[name]
    assert by_tag(job(stored, PHASE)) == by_tag(job(plain, PHASE))
    several = Experiments([PHASE])
    assert by_tag(job(stored, several)) == by_tag(job(plain, several))


def exchanges_below_joins(df):
    """Exchanges that stand under a join: those of the tables."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(lines)}
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    assert joins
    return [lines[j] for j in range(min(joins), len(lines)) if "Exchange" in lines[j] and depth[j] > depth[min(joins)]]


@pytest.mark.parametrize("name", ["retention_active", "continues"])
def test_tables_stored_by_user_are_joined_where_they_lie(by_user, name):
    stored, plain = by_user
    assert not exchanges_below_joins(registry.REPORTS[name](stored, PHASE))
    assert exchanges_below_joins(registry.REPORTS[name](plain, PHASE))
