"""The experiment table, on documents written here."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trialmetrics.plans import catalog
from trialmetrics.sources.documents import read_experiment_documents

AS_OF = datetime(2024, 8, 1, 12)


def text(moment):
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def document(name, tags, start, end=None, variations=2, phases=1):
    phase = {"dateStarted": text(start) if isinstance(start, datetime) else start,
             "dateEnded": text(end) if isinstance(end, datetime) else end}
    early = {"dateStarted": "2020-01-01T00:00:00.0Z", "dateEnded": "2020-01-02T00:00:00.0Z"}
    return {"name": name, "tags": tags, "variations": [{"key": str(i), "name": f"v{i}"} for i in range(variations)],
            "phases": ([early] * (phases - 1) + [phase]) if phases else []}


def ago(**units):
    return AS_OF - timedelta(**units)


@pytest.fixture
def table(spark, tmp_path):
    def build(*pages, **options):
        for i, page in enumerate(pages):
            (tmp_path / f"page{i}.json").write_text(json.dumps({"experiments": page, "limit": 100}, indent=1))
        return catalog.experiment_table(read_experiment_documents(spark, str(tmp_path)), AS_OF, **options)
    return build


def names(df):
    return {r.tag: r.experiment_name for r in df.collect()}


def test_latest_experiment_of_a_tag(table):
    found = table([document("old", ["a"], ago(days=20)), document("new", ["a", "b"], ago(days=10), phases=3)],
                  [document("same start", ["b"], ago(days=10)), document("unknown start", ["a"], "soon")])
    assert names(found) == {"a": "new", "b": "new"}
    row = found.filter("tag = 'b'").first()
    assert (row.tags, row.number_of_variations, row.control_group_key) == ("a_b", 2, "0")
    assert (row.phase_start_time, row.phase_end_time) == (ago(days=10), AS_OF)


def test_ineligible_experiments_hide_older_ones(table):
    assert names(table([document("old", ["a"], ago(days=20)), document("young", ["a"], ago(days=1, hours=23))])) == {}


@pytest.mark.parametrize("start, end, kept", [
    (ago(days=2), None, True), (ago(days=2) + timedelta(seconds=1), None, False),
    (ago(days=95), ago(days=5), True), (ago(days=95), ago(days=4, hours=1), True), (ago(days=95), ago(days=4), False),
    (ago(days=91), None, False), (ago(days=90, hours=23), None, True), ("2024-07-01", None, False), (None, None, False)])
def test_eligibility(table, start, end, kept):
    assert names(table([document("x", ["a"], start, end)])) == ({"a": "x"} if kept else {})


def test_no_phases_and_no_variations(table):
    found = table([document("bare", ["a"], ago(days=5), phases=0), document("single", ["b"], ago(days=5), variations=0)])
    row = found.first()
    assert names(found) == {"b": "single"} and (row.number_of_variations, row.control_group_key) == (0, None)


def test_fractions_of_a_second_are_dropped(table):
    row = table([document("x", ["a"], "2024-07-01T10:20:30.999Z", "2024-07-20T01:02:03.5Z")]).first()
    assert row.phase_start_time == datetime(2024, 7, 1, 10, 20, 30) and row.phase_end_time == datetime(2024, 7, 20, 1, 2, 3)


def test_an_end_that_is_no_time_is_an_error(table):
    with pytest.raises(Exception, match="not a phase end"):
        table([document("x", ["a"], ago(days=5), "later")]).collect()


def test_overrides_come_last(spark, table):
    rows = [("a", "x", "a", ago(days=9), ago(days=1), 3, "0"), ("a", "by hand", "a", ago(days=9), ago(days=1), 2, "0"),
            ("c", "by hand", "c", ago(days=9), ago(days=1), 2, "0")]
    overrides = spark.createDataFrame(rows, "tag string, experiment_name string, tags string, phase_start_time timestamp_ntz, "
                                      "phase_end_time timestamp_ntz, number_of_variations int, control_group_key string")
    found = {(r.tag, r.experiment_name): r for r in table([document("x", ["a"], ago(days=5))], overrides=overrides).collect()}
    assert set(found) == {("a", "x"), ("a", "by hand"), ("c", "by hand")}
    assert found["a", "x"].number_of_variations == 2


def test_as_published_has_one_row_per_name_and_tags(table):
    found = table([document("x", ["a", " b c"], ago(days=5))], as_published=True).collect()
    assert [(r.experiment_name, r.tags) for r in found] == [("x", "a_bc")] and "tag" not in found[0].asDict()


def test_tags_and_lookup(table):
    found = table([document("x", [" a "], ago(days=5)), document("y", ["b"], ago(days=6), ago(days=3))])
    assert {r.tag for r in catalog.tags(found).collect()} == {"a", "b"}
    exp = catalog.experiment_for(found, "b")
    assert (exp.name, exp.first_day, exp.last_day, exp.control) == ("y", ago(days=6).date(), ago(days=3).date(), 0)
    with pytest.raises(LookupError):
        catalog.experiment_for(found, "unknown")


def test_a_bad_end_of_a_superseded_document_is_harmless(table):
    """Only the document that stands for a tag is judged."""
    good, bad = document("new", ["a"], ago(days=10)), document("old", ["a"], ago(days=20), "yesterday")
    assert names(table([bad, good])) == {"a": "new"}
    with pytest.raises(Exception, match="not a phase end"):
        names(table([document("old", ["a"], ago(days=20)), document("new", ["a"], ago(days=10), "yesterday")]))


def test_the_experiment_in_force_of_each_tag(spark, table):
    found = table([document("x", ["a"], ago(days=9)), document("y", ["b"], ago(days=20))])
    both = found.union(found.withColumn("experiment_name", F.concat(F.lit("older "), "experiment_name")).withColumn(
        "phase_start_time", F.expr("phase_start_time - INTERVAL 1 DAY"))).union(found.withColumn("tag", F.lit(None).cast("string")))
    assert names(catalog.in_force(both)) == {"a": "x", "b": "y"} and catalog.in_force(both).columns == both.columns
    assert [e.tag for e in catalog.experiments(both)] == ["a", "b"]
