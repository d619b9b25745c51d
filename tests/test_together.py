"""Reports of many experiments made in one pass."""

import re
from datetime import datetime, timedelta

import pytest
from build import JULY, day, given, got, tables
from pyspark.sql import functions as F

from trialmetrics import Experiment, Tables, registry
from trialmetrics.experiment import Experiments
from trialmetrics.operators import assignment, windows
from trialmetrics.plans import ads, business, recharge, retention
from trialmetrics.publish import published
from trialmetrics.sources.fixtures import PHASE, fixture_tables

FOLDER = "/root/testdata/sf0.001"
SEVERAL = [
    PHASE,
    Experiment("exp_a", "late", datetime(2024, 1, 10), datetime(2024, 1, 20, 12)),
    Experiment("exp_b", "other", datetime(2024, 1, 5, 8), datetime(2024, 2, 20, 20)),
    Experiment("exp_a", "one_day", datetime(2024, 1, 15, 8), datetime(2024, 1, 15, 20)),
    Experiment("exp_b", "two_days", datetime(2024, 1, 30), datetime(2024, 1, 31, 23)),
    Experiment("exp_c", "nobody", datetime(2024, 1, 2), datetime(2024, 1, 9)),
]
BASES = [name for name, job in registry.REPORTS.items() if not isinstance(job, registry.Derived)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The fixtures with a second experiment, written as tables."""
    root, plain = str(tmp_path_factory.mktemp("tables")), fixture_tables(spark, FOLDER, hard=True)
    given_ = plain["assignment"]
    late = given_.withColumns({"experiment_id": F.lit("exp_b"), "variation_id": (2 - F.col("variation_id")).cast("int"),
                               "timestamp_assigned": F.expr("timestamp_assigned + INTERVAL 3 DAYS"), "event_date": F.date_add("event_date", 3)})
    names = ["first_visit", "active", "subscribe", "currency", "all_purchase", "ads_impression", "ads_end", "session", "geo", "chat", "bot_view",
             "show_card", "follow", "reset", "image", "google", "apple", "business_user", "daily_revenue", "app_event"]
    given_.unionByName(late).repartition(2).write.parquet(f"{root}/assignment")
    for name in names:
        plain[name].repartition(2).write.parquet(f"{root}/{name}")
    return Tables(spark, lambda name: spark.read.parquet(f"{root}/{name}"))


def by_tag(frame):
    names = sorted(frame.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (row[name] for name in names)) for row in frame.collect()), key=str)


def one_at_a_time(t, job, experiments):
    frames = [job(t, exp).withColumn("tag", F.lit(exp.tag)) for exp in experiments]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@pytest.mark.parametrize("name", BASES)
def test_together_as_one_at_a_time(stored, name):
    job = registry.REPORTS[name]
    found = by_tag(job(stored, Experiments(SEVERAL)))
    assert found == by_tag(one_at_a_time(stored, job, SEVERAL)) and found


VARIANTS = {
    "strict bounds": lambda t, exp: retention.new_user_retention(t, exp, strict_bounds=True),
    "strict bounds of active users": lambda t, exp: retention.active_user_retention(t, exp, strict_bounds=True),
    "raw totals": lambda t, exp: retention.country_retention(t, exp, distinct_totals=False),
    "parts": lambda t, exp: retention.new_user_retention(t, exp, parts=5),
    "ads of the phase": lambda t, exp: ads.ads(t, exp, date_filter=True),
    "strict recharge": lambda t, exp: recharge.recharge(t, exp, strict_bounds=True),
    "as published": lambda t, exp: business.payment_ratio(t, exp, as_published=True),
    "same day": lambda t, exp: business.cancellation_rate(t, exp, same_day_only=True),
}


@pytest.mark.parametrize("name", VARIANTS)
def test_variants_together(stored, name):
    found = by_tag(VARIANTS[name](stored, Experiments(SEVERAL)))
    assert found == by_tag(one_at_a_time(stored, VARIANTS[name], SEVERAL)) and found


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sorted(re.findall(r"InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*/(\w+)", plan))


@pytest.mark.parametrize("name", BASES)
def test_many_tags_scan_a_source_as_often_as_one(spark, stored, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    many = [Experiment("exp_a", f"tag_{i}", PHASE.phase_start + timedelta(days=i % 5), PHASE.phase_end) for i in range(20)]
    job = registry.REPORTS[name]
    read = scans(job(stored, Experiments(many)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert read and read == scans(job(stored, PHASE))


def test_days_of_each(spark):
    """Days of different experiments, an empty one among them."""
    days = windows.inner(Experiments(SEVERAL))
    rows = spark.createDataFrame([(e.tag,) for e in SEVERAL], "tag string")
    found = {}
    for row in days.spread(rows, "day").collect():
        found.setdefault(row.tag, []).append(row.day)
    assert found == {e.tag: [e.day(i) for i in range(1, e.span_days)] for e in SEVERAL if e.span_days > 1}
    every = windows.whole(Experiments(SEVERAL)).spread(rows, "day")
    assert days.narrowed(every, "day").count() == sum(map(len, found.values()))
    assert (days.first, days.last) == (PHASE.day(1), SEVERAL[2].day(SEVERAL[2].span_days - 1))


def test_a_user_of_two_experiments(spark):
    """Events count in both, each with its own variation and days."""
    other = Experiment("exp2", "second", datetime(2024, 7, 4), datetime(2024, 7, 6))
    t = tables(spark, assignment=[given("u", 0, 2), given("u", 1, 3, experiment="exp2"), given("v", 1, 3)],
               currency=[{"event_id": f"{u}{n}", "user_id": u, "event_date": day(n), "revenue": float(n), "is_first_flux": 0}
                         for u in "uv" for n in (1, 2, 5, 9)])
    found = got(business.order_value(t, Experiments([JULY, other])), "tag", "event_date", "variation_id")
    assert {k: (r.total_revenue, r.total_order_cnt) for k, r in found.items()} == {
        **{("tag", day(n), v): (float(n), 1) for n in (2, 5, 9) for v in (0, 1)}, ("second", day(5), 1): (5.0, 1)}
    users = assignment.resolve(t, Experiments([JULY, other]), "user_first")
    assert {(r.tag, r.user_id): r.variation_id for r in users.collect()} == {("tag", "u"): 0, ("second", "u"): 1, ("tag", "v"): 1}


def test_tags_have_to_differ():
    with pytest.raises(ValueError):
        Experiments([PHASE, PHASE])
    with pytest.raises(ValueError):
        Experiments([])


NAMES = ["order_value", "retention_new", "retention_new_overall", "recharge_evaluation"]


def test_run_of_many_tags(spark, stored, tmp_path):
    for folder, together in (("together", True), ("one", False)):
        run = registry.run_all(stored, SEVERAL, f"{tmp_path}/{folder}", NAMES, together=together)
        assert set(run.seconds) == {(e.tag, name) for e in SEVERAL for name in [*NAMES, "recharge"]}
    for name in [*NAMES, "recharge"]:
        a, b = (published(spark, f"{tmp_path}/{folder}", name) for folder in ("together", "one"))
        assert by_tag(a) == by_tag(b) and a.columns == b.columns
    assert published(spark, f"{tmp_path}/together", "order_value", "nobody").count() == 0


def test_one_experiment_that_fails_does_not_fail_the_others(spark, stored, tmp_path, monkeypatch):
    def job(t, exp):
        if any(e.tag == "late" for e in (exp if isinstance(exp, Experiments) else [exp])):
            raise RuntimeError("no")
        return business.order_value(t, exp)

    monkeypatch.setitem(registry.REPORTS, "order_value", job)
    with pytest.raises(registry.RunFailed) as failed:
        registry.run_all(stored, SEVERAL, str(tmp_path), ["order_value"])
    assert set(failed.value.run.failures) == {("late", "order_value")}
    assert {r.tag for r in published(spark, str(tmp_path), "order_value").select("tag").distinct().collect()} == {"demo", "other"}


def test_a_run_that_is_started_again(spark, stored, tmp_path, monkeypatch):
    """What was made is skipped; what failed is made, and so is what depends on it."""
    root, two, calls = str(tmp_path), SEVERAL[:2], []

    def job(t, exp):
        tags = {e.tag for e in (exp if isinstance(exp, Experiments) else [exp])}
        calls.append(tags)
        if "late" in tags and broken:
            raise RuntimeError("no")
        return retention.new_user_retention(t, exp)

    monkeypatch.setitem(registry.REPORTS, "retention_new", job)
    names, broken = ["order_value", "retention_new_overall"], True
    with pytest.raises(registry.RunFailed):
        registry.run_all(stored, two, root, names, version="monday")
    broken = False
    calls.clear()
    run = registry.run_all(stored, two, root, names, version="monday")
    assert calls == [{"late"}] and set(run.seconds) == {("late", "retention_new"), ("late", "retention_new_overall")}
    assert run.skipped == {("demo", "retention_new"), ("demo", "retention_new_overall"), ("demo", "order_value"), ("late", "order_value")}
    assert registry.run_all(stored, two, root, names, version="monday").seconds == {}
    assert len(registry.run_all(stored, two, root, names, version="tuesday").seconds) == 6
    assert len(registry.run_all(stored, two, root, names).seconds) == 6
