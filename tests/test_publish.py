"""Reports written, overwritten and read back; runs of many reports."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from build import JULY, day, given, tables
from pyspark.sql import functions as F, types as T

from trialmetrics import Experiment, Tables, publish, registry
from trialmetrics.plans import catalog
from trialmetrics.publish import snapshots
from trialmetrics.sources.schemas import SCHEMAS
from trialmetrics.sources.tables import read_csv


@pytest.fixture
def report(spark):
    return spark.createDataFrame([(day(2), 0, 1.5), (day(2), 1, None)], "event_date date, variation int, value double")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_publishing_twice_leaves_one_copy(spark, tmp_path, report):
    root = str(tmp_path)
    for tag in ("a", "b", "a"):
        publish.publish(report, root, "metric", tag)
    assert rows(publish.published(spark, root, "metric", "a")) == rows(report)
    both = publish.published(spark, root, "metric")
    assert both.count() == 4 and {r.tag for r in both.collect()} == {"a", "b"}


def test_an_empty_report_replaces_the_old_one(spark, tmp_path, report):
    root = str(tmp_path)
    for rows_ in (report, report.limit(0)):
        publish.publish(rows_, root, "metric", "a")
    assert publish.published(spark, root, "metric", "a").count() == 0
    assert publish.published(spark, root, "metric", "a").columns == report.columns


@pytest.mark.parametrize("tag", ["", "a b", "../a", "a;b", "a'"])
def test_tags_are_checked(tmp_path, report, tag):
    with pytest.raises(ValueError):
        publish.publish(report, str(tmp_path), "metric", tag)


def test_catalog_table(spark, tmp_path, report):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub LOCATION '{tmp_path}/pub'")
    for frame, tag in ((report, "a"), (report, "b"), (report, "a"), (report.limit(0), "b")):
        publish.publish_table(frame, "pub.metric", tag)
    assert rows(spark.table("pub.metric").filter("tag = 'a'").drop("tag")) == rows(report)
    assert spark.table("pub.metric").filter("tag = 'b'").count() == 0
    spark.sql("DROP DATABASE pub CASCADE")


def test_csv_and_types(spark, tmp_path, report):
    publish.export_csv(report, f"{tmp_path}/csv")
    assert rows(read_csv(spark, f"{tmp_path}/csv", report.schema)) == rows(report)
    schema = T.StructType([T.StructField("variation", T.StringType()), T.StructField("value", T.FloatType())])
    assert publish.typed(report, schema).schema == schema


def test_preview_and_headings(report):
    assert [r.value for r in publish.preview(report, "variation").collect()] == [1.5, 0.0]
    assert publish.with_headings(report, publish.EDIT_HEADINGS).columns == ["日期", "实验分组", "value"]


def sample_tables(spark):
    users = [f"u{i}" for i in range(8)]
    return tables(
        spark, assignment=[given(u, i % 2, 2 + i % 3) for i, u in enumerate(users)],
        first_visit=[{"user_id": u, "first_visit_date": day(2)} for u in users],
        active=[{"user_id": u, "active_date": day(n), "keep_alive_flag": 1} for u in users for n in (2, 3, 5)],
        currency=[{"event_id": u, "user_id": u, "event_date": day(3), "revenue": 2.0, "is_first_flux": 0} for u in users[:5]],
        ads_impression=[{"event_id": u, "user_id": u, "event_date": day(3), "ad_revenue": 0.1} for u in users])


def test_running_everything(spark, tmp_path):
    run = registry.run_all(sample_tables(spark), [JULY], str(tmp_path))
    assert set(run.seconds) == {("tag", name) for name in registry.REPORTS} and not run.failures
    assert publish.published(spark, str(tmp_path), "retention_new", "tag").count() > 0
    assert publish.published(spark, str(tmp_path), "recharge_evaluation", "tag").count() == 1


def test_failures_are_raised_at_the_end(spark, tmp_path):
    t = sample_tables(spark)

    def opener(name):
        if name == "reset":
            raise FileNotFoundError(name)
        return t[name]

    other = Experiment("exp", "other", JULY.phase_start, JULY.phase_end)
    with pytest.raises(registry.RunFailed) as failed:
        registry.run_all(Tables(spark, opener), [JULY, other], str(tmp_path), ["conversation_resets", "recharge"])
    assert set(failed.value.run.failures) == {("tag", "conversation_resets"), ("other", "conversation_resets")}
    assert publish.published(spark, str(tmp_path), "recharge").count() == 4


def test_shared_assignments_give_the_same_reports(spark):
    t = sample_tables(spark)
    shared = Tables(spark, t.__getitem__, share_assignments=True)
    for name in ("revenue_per_user", "order_value", "recharge"):
        assert rows(registry.REPORTS[name](shared, JULY)) == rows(registry.REPORTS[name](t, JULY))
    assert len(shared._shared) == 3


def test_tables_in_a_folder_and_in_a_catalog(spark, tmp_path):
    t = sample_tables(spark)
    t["currency"].write.partitionBy("event_date").parquet(f"{tmp_path}/currency")
    found = Tables.in_folder(spark, str(tmp_path))["currency"]
    assert rows(found.select(SCHEMAS["currency"].names)) == rows(t["currency"])
    spark.createDataFrame([("u", "exp", "null", "2024-07-02 10:00:00", "2024-07-02"), ("v", "exp", "1", "2024-07-02 10:00:00", "2024-07-02")],
                          "user_id string, experiment_id string, Variation_ID string, timestamp_assigned string, event_date string"
                          ).createOrReplaceTempView("raw_assignment")
    loaded = Tables.in_catalog(spark, {"assignment": "raw_assignment"})["assignment"]
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in SCHEMAS["assignment"]]
    assert sorted((r.user_id, r.variation_id, r.event_date) for r in loaded.collect()) == [("u", None, day(2)), ("v", 1, day(2))]


def broken(report):
    """The report with rows that fail when they are computed, after others were written."""
    return report.withColumn("value", F.when(F.col("variation") == 1, F.raise_error("lost").cast("double")).otherwise(F.col("value")))


@pytest.mark.parametrize("write", [
    lambda frame, root: publish.publish(frame, root, "metric", "a"),
    lambda frame, root: publish.publish_tags(frame.withColumn("tag", F.lit("a")), root, "metric", ["a", "b"]),
    lambda frame, root: publish.publish_days(frame, root, "metric", "a"),
    lambda frame, root: catalog.store(frame, f"{root}/metric")])
def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, report, write):
    root = str(tmp_path)
    write(report, root)
    before = sorted(p.name for p in (tmp_path / "metric").iterdir())
    with pytest.raises(Exception, match="lost"):
        write(broken(report), root)
    assert rows(snapshots.read(spark, f"{root}/metric").select(report.columns)) == rows(report)
    assert sorted(p.name for p in (tmp_path / "metric").iterdir()) == before


def test_a_crash_before_the_manifest_changes_nothing(spark, tmp_path, report, monkeypatch):
    root = str(tmp_path)
    publish.publish(report, root, "metric", "a")
    with monkeypatch.context() as m:
        m.setattr(snapshots.Files, "create", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            publish.publish(report.limit(0), root, "metric", "a")
    (tmp_path / "metric" / "_manifests" / "000000000002.json").write_text('{"schema": ')  # half a manifest
    assert rows(publish.published(spark, root, "metric", "a")) == rows(report)
    publish.publish(report.limit(1), root, "metric", "a")
    assert publish.published(spark, root, "metric", "a").count() == 1


def test_readers_that_have_begun_end(spark, tmp_path, report):
    root = str(tmp_path)
    publish.publish(report, root, "metric", "a")
    begun = publish.published(spark, root, "metric", "a")
    publish.publish(report.limit(0), root, "metric", "a")
    assert rows(begun) == rows(report)
    for _ in range(3):
        publish.publish(report, root, "metric", "a")
    assert len([p for p in (tmp_path / "metric").iterdir() if p.name.startswith("data-")]) == 2
    with pytest.raises(FileNotFoundError):
        publish.published(spark, root, "metric", "unknown")


def test_writers_at_a_time(spark, tmp_path, report):
    """Both commits count, though both were begun on the same manifest."""
    tags = [f"t{i}" for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda tag: publish.publish(report, str(tmp_path), "metric", tag), tags))
    assert {r.tag for r in publish.published(spark, str(tmp_path), "metric").collect()} == set(tags)


def test_one_day_is_replaced(spark, tmp_path):
    root = str(tmp_path)

    def of(*days, value=1.0):
        return spark.createDataFrame([(day(n), v, value) for n in days for v in (0, 1)], "event_date date, variation int, value double")

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "metric").rglob("*.parquet")}

    publish.publish_days(of(2, 3, 4), root, "metric", "a")
    publish.publish(of(3), root, "metric", "b")
    before = files()
    publish.publish_days(of(2, 3, 4, value=2.0), root, "metric", "a", days=[day(3)])
    after = files()
    assert {p: t for p, t in after.items() if p in before} == before and len(after) == len(before) + 1
    assert rows(publish.published(spark, root, "metric", "a")) == rows(of(2, 4).union(of(3, value=2.0)))
    publish.publish_days(of(), root, "metric", "a", days=[day(2), day(9)])
    assert {r.event_date for r in publish.published(spark, root, "metric", "a").collect()} == {day(3), day(4)}
    assert publish.published(spark, root, "metric", "b").count() == 2
    with pytest.raises(ValueError):
        publish.publish_days(of(3), root, "metric", "b", days=[day(3)])
    publish.publish_days(of(), root, "metric", "a")
    assert publish.published(spark, root, "metric", "a").count() == 0


def test_one_day_of_a_catalog_table_is_replaced(spark, tmp_path, report):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub_days LOCATION '{tmp_path}/pub'")
    three = report.union(spark.createDataFrame([(day(3), 0, 7.0)], report.schema))
    for frame, tag, days in ((three, "a", ()), (three, "b", ()), (report.withColumn("value", F.lit(9.0)), "a", ()), (report.limit(0), "b", [day(3)])):
        publish.publish_table(frame, "pub_days.metric", tag, day="event_date", days=days)
    found = spark.table("pub_days.metric")
    assert rows(found.filter("tag = 'a'").select("event_date", "variation", "value")) == [(day(2), 0, 9.0), (day(2), 1, 9.0), (day(3), 0, 7.0)]
    assert rows(found.filter("tag = 'b'").select("event_date", "variation", "value")) == rows(report)
    spark.sql("DROP DATABASE pub_days CASCADE")
