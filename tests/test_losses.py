"""Input that cannot be read in full, and runs that fail in part, are told instead of passed over."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from build import JULY, at, day, given, tables
from test_publish import sample_tables
from trialmetrics import Tables, registry
from trialmetrics.functions import means, ranks, resampling, special
from trialmetrics.operators import assignment
from trialmetrics.plans import catalog
from trialmetrics.publish import publish, published
from trialmetrics.sources.documents import read_experiment_documents
from trialmetrics.sources.schemas import SCHEMAS
from trialmetrics.sources.tables import conformed, read_csv

PAGE = {"offset": 0, "experiments": [{"name": "x", "tags": [" a "], "variations": [{"key": "0", "name": "n"}],
                                      "phases": [{"dateStarted": "2024-07-01T06:00:00.5Z", "dateEnded": "2024-07-10T18:00:00.5Z"}]}]}


@pytest.mark.parametrize("one_per_file", [True, False])
def test_a_page_that_is_cut_short_is_an_error(spark, tmp_path, one_per_file):
    (tmp_path / "a.json").write_text(json.dumps(PAGE))
    assert read_experiment_documents(spark, str(tmp_path), one_per_file).count() == 1
    (tmp_path / "b.json").write_text(json.dumps(PAGE)[:-40])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_experiment_documents(spark, str(tmp_path), one_per_file).collect()


def test_a_cell_that_does_not_fit_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id,revenue\nu,1.5\nv,much\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path), T.StructType().add("user_id", "string").add("revenue", "double")).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_value_that_does_not_cast_is_an_error(spark, ansi):
    def loaded(revenue, date="2024-07-02"):
        df = spark.createDataFrame([("u", date, revenue, "gift")], "user_id string, event_date string, revenue string, type string")
        return conformed(df, SCHEMAS["all_purchase"]).collect()

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert loaded("1.5")[0].revenue == 1.5 and loaded(None)[0].revenue is None
        for values in (("much",), ("1", "some day")):
            with pytest.raises(Exception, match="not a (double|date)"):
                loaded(*values)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="revenue"):
        conformed(spark.createDataFrame([("u",)], "user_id string"), SCHEMAS["all_purchase"])


def test_tables_in_folders_keep_the_types_of_their_files(spark, tmp_path):
    rows = [(1, "exp", "null", "2024-07-02 10:00:00"), (2, "exp", "1", "2024-07-03 10:00:00")]
    df = spark.createDataFrame(rows, "user_id bigint, experiment_id string, variation_id string, moment string")
    df.select("user_id", "experiment_id", "variation_id", F.to_timestamp("moment").alias("timestamp_assigned"),
              F.to_date("moment").alias("event_date")).write.parquet(str(tmp_path / "assignment"))
    found = Tables.in_folder(spark, str(tmp_path))["assignment"]
    assert dict(found.dtypes)["user_id"] == "bigint" and dict(found.dtypes)["timestamp_assigned"] == "timestamp_ntz"
    assert sorted((r.user_id, r.variation_id, r.event_date) for r in found.collect()) == [(1, None, day(2)), (2, 1, day(3))]


def sample(spark, values, parts=1):
    rows = [(f"u{i}", i % 2, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "user_id string, variation_id int, user_aov double").repartition(parts)


def test_bootstrap_leaves_out_what_is_no_number(spark):
    values = [10.0 + (i * 7 % 5) for i in range(20)]
    values[4] = math.nan
    found = {parts: resampling.bootstrap_mean_difference(sample(spark, values, parts), resamples=300).collect()[0]
             for parts in (1, 4, 16)}
    without = sample(spark, values).filter(~F.isnan("user_aov"))
    clean = resampling.bootstrap_mean_difference(without, resamples=300).collect()[0]
    for row in found.values():
        assert tuple(row) == pytest.approx(tuple(clean), rel=1e-12) and not any(map(math.isnan, row))


def test_bootstrap_refuses_rows_without_a_key(spark):
    df = spark.createDataFrame([("u", 0, 1.0), (None, 1, 2.0)], "user_id string, variation_id int, user_aov double")
    with pytest.raises(Exception, match="has no user_id"):
        resampling.bootstrap_mean_difference(df, resamples=10).collect()


def test_limits_of_draws_rise_and_end_with_the_hash():
    limits = [int(x) for x in resampling._LIMITS]
    assert limits == sorted(set(limits)) and limits[-1] < 2**64 and len(limits) == 20
    draws = resampling.poisson_draws(np.array([2**64 - 1, 0], np.uint64), 100, seed=0)
    assert draws.shape == (2, 100)


def test_tests_of_means_and_ranks_leave_out_what_is_no_number(spark):
    values = [1.0, 2.0, 3.5, 4.0, math.nan, math.nan, 7.0, 9.0, 2.0, 3.0]
    dirty, clean = sample(spark, values), sample(spark, values).filter(~F.isnan("user_aov"))
    for job in (means.group_moments, means.mean_tests, means.posterior_difference, means.linear_regression, ranks.rank_test):
        a, b = (sorted(map(tuple, job(df).collect()), key=repr) for df in (dirty, clean))
        assert a == b and not any(isinstance(x, float) and math.isnan(x) for row in a for x in row)


def test_a_fraction_that_does_not_converge_is_an_error(monkeypatch):
    monkeypatch.setattr(special.np, "sqrt", lambda _: -9.9)
    with pytest.raises(ArithmeticError):
        special.incomplete_beta(5e7, 5e7, np.array([0.5]))


def failing(t, *names):
    def opener(name):
        if name in names:
            raise FileNotFoundError(name)
        return t[name]
    return Tables(t.spark, opener)


def test_a_derived_report_fails_with_its_base(spark, tmp_path):
    root, t = str(tmp_path), sample_tables(spark)
    registry.run_all(t, [JULY], root, ["recharge", "recharge_evaluation"])
    before = published(spark, root, "recharge_evaluation", "tag").collect()
    written = list((tmp_path / "recharge_evaluation/tag=tag").glob("part-*"))
    with pytest.raises(registry.RunFailed) as failed:
        registry.run_all(failing(t, "currency"), [JULY], root, ["recharge", "recharge_evaluation", "ads"])
    assert set(failed.value.run.failures) == {("tag", "recharge"), ("tag", "recharge_evaluation")}
    assert isinstance(failed.value.run.failures["tag", "recharge_evaluation"], registry.BaseFailed)
    assert list((tmp_path / "recharge_evaluation/tag=tag").glob("part-*")) == written and before


def test_a_base_that_was_not_asked_for_is_run(spark, tmp_path):
    run = registry.run_all(sample_tables(spark), [JULY], str(tmp_path), ["ads_evaluation"])
    assert list(run.seconds) == [("tag", "ads"), ("tag", "ads_evaluation")]


def test_a_run_resolves_each_assignment_once_and_cleans_up(spark, tmp_path, monkeypatch):
    t, opened, released = sample_tables(spark), [], []
    counting = Tables(spark, lambda name: opened.append(name) or t[name])
    plain = assignment.assignments
    calls = []
    monkeypatch.setattr(assignment, "assignments", lambda tables, exp: calls.append(1) or plain(tables, exp))
    shared = counting.sharing()
    monkeypatch.setattr(Tables, "sharing", lambda self: shared)
    release = shared.release
    monkeypatch.setattr(shared, "release", lambda: released.append(list(shared._shared)) or release())
    names = ["revenue_per_user", "edits", "follows", "conversation_resets", "continues"]
    registry.run_all(counting, [JULY], str(tmp_path), names)
    assert opened.count("assignment") == 1 and len(calls) < len(names) and len(calls) == len(released[0])
    assert not shared._shared


def test_tags_of_digits_stay_text(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    for tag in ("0123", "07"):
        publish(df, str(tmp_path), "m", tag)
    assert {r.tag for r in published(spark, str(tmp_path), "m").collect()} == {"0123", "07"}


def test_an_assignment_without_a_day_loses_to_one_with_a_day(spark):
    undated = {**given("u", 1, 3), "event_date": None}
    t = tables(spark, assignment=[undated, given("u", 0, 2)])
    assert assignment.resolve(t, JULY, "user_latest_day").collect()[0].variation_id == 0


def test_from_documents_to_reports(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text(json.dumps({**PAGE, "experiments": [{**PAGE["experiments"][0], "name": "exp"}]}))
    documents = read_experiment_documents(spark, str(tmp_path / "docs"))
    root = str(tmp_path / "out")
    run = registry.run_documents(sample_tables(spark), documents, at(20), root, names=["follows", "ads"])
    assert set(run.seconds) == {("a", "follows"), ("a", "ads")}
    stored = catalog.stored(spark, f"{root}/experiments")
    assert [e.tag for e in catalog.experiments(stored)] == ["a"] and catalog.experiment_for(stored, " a ").name == "exp"
    assert published(spark, root, "ads", "a").count() > 0


def test_a_document_has_each_tag_once(spark):
    page = spark.createDataFrame([(1, "x", [" a", "a ", "b"], [], [])],
                                 "position int, name string, tags array<string>, variations array<struct<key:string,name:string>>, "
                                 "phases array<struct<dateStarted:string,dateEnded:string>>")
    assert sorted(r.tag for r in catalog.by_tag(page).collect()) == ["a", "b"]
    assert sorted(r.tag for r in catalog.latest_by_tag(page).collect()) == ["a", "b"]
