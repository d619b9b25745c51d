"""Cases the test tables do not have."""

from datetime import datetime

import pytest
from build import JULY, at, day, given, got, tables

from trialmetrics import Experiment
from trialmetrics.operators import assignment, windows
from trialmetrics.plans import ads, business, chat, engagement, recharge, retention, subscription


def test_identical_timestamps_go_to_the_lowest_variation(spark):
    t = tables(spark, assignment=[given("u", 1, 2), given("u", 0, 2)])
    for policy in ("user_first", "user_latest_day", "user_first_day", "daily_first", "daily_lowest"):
        assert [r.variation_id for r in assignment.resolve(t, JULY, policy).collect()] == [0]


def test_other_experiments_are_ignored(spark):
    t = tables(spark, assignment=[given("u", 1, 3), given("u", 0, 2, experiment="other"), given("v", 1, 2, experiment="other")])
    assert [(r.user_id, r.variation_id) for r in assignment.resolve(t, JULY, "user_first").collect()] == [("u", 1)]


def test_repeating_assignment_rows_changes_nothing(spark):
    rows = [given("u", 1, 3), given("u", 0, 4, 9), given("u", 1, 4), given("v", 0, 2), given("v", 1, 2, 13)]
    once, twice = tables(spark, assignment=rows), tables(spark, assignment=rows + rows)
    for policy in assignment.POLICIES:
        results = [sorted(map(tuple, assignment.resolve(t, JULY, policy).collect())) for t in (once, twice)]
        assert results[0] == results[1]


def test_policies_differ_where_they_should(spark):
    t = tables(spark, assignment=[given("u", 1, 3, 8), given("u", 0, 3, 9), given("u", 1, 5, 9), given("u", 0, 5, 10)])

    def result(policy, **scope):
        rows = assignment.resolve(t, JULY, policy, **scope).collect()
        return sorted((getattr(r, "event_date", None), r.variation_id) for r in rows)

    assert result("user_first") == [(None, 1)]
    assert result("user_first", between=(at(3, 9), at(9))) == [(None, 0)]
    assert result("user_latest_day") == [(None, 1)]
    assert result("daily_first") == [(day(3), 1), (day(5), 1)]
    assert result("daily_lowest") == [(day(3), 0), (day(5), 0)]
    assert result("any") == [(None, 0), (None, 1)]
    assert len(result("any_daily")) == 4


def test_null_variation_sorts_first(spark):
    t = tables(spark, assignment=[given("u", 1, 3), given("u", None, 3, 13)])
    assert assignment.resolve(t, JULY, "daily_lowest").first().variation_id is None
    assert assignment.resolve(t, JULY, "daily_first").first().variation_id == 1


@pytest.mark.parametrize("hours, expected", [(20, (1, 1)), (60, (2, 2))])
def test_short_phases(hours, expected):
    start = datetime(2024, 7, 1, 1)
    exp = Experiment("exp", "tag", start, datetime.fromtimestamp(start.timestamp() + hours * 3600))
    follow = windows.inner_if_long(exp)
    assert (follow.first.day, follow.last.day) == expected
    assert len(windows.inner(exp)) == max(0, exp.span_days - 1)


def test_phase_of_two_days_has_no_inner_days(spark):
    exp = Experiment("exp", "tag", at(1), at(2))
    t = tables(spark, assignment=[given("u", 0, 1)], currency=[{"user_id": "u", "event_date": day(1), "revenue": 5.0}])
    assert business.revenue_per_paying_user(t, exp).count() == 0
    assert engagement.regenerations(t, exp).count() == 0
    assert chat.click_rate(t, exp).count() == 0
    assert chat.explore_click_rate(t, exp).count() == 0


def test_times_as_bounds():
    assert windows.between_times(JULY).first == day(1)
    assert windows.between_times(JULY, strict=True).first == day(2)
    midnight = Experiment("exp", "tag", at(1, 0), at(10))
    assert windows.between_times(midnight, strict=True).first == day(1)


def test_everything_is_empty_for_empty_tables(spark):
    from trialmetrics.registry import REPORTS, Derived

    t = tables(spark)
    for name, job in REPORTS.items():
        report = job.build(REPORTS[job.base](t, JULY), JULY) if isinstance(job, Derived) else job(t, JULY)
        assert report.count() == 0, name


def long(spark, *rows):
    return spark.createDataFrame(rows, "dt date, variation int, new_users long, d1 long, d3 long, d7 long, d15 long, total_assigned long")


def test_rates_at_the_borders(spark):
    wide = long(spark, (day(1), 0, 0, 0, 0, 0, 0, 0), (day(1), 1, 4, 4, 0, 2, 1, 9))
    rates = got(retention.retention_rates(wide), "variation", "day")
    assert set(rates) == {(1, n) for n in (1, 3, 7, 15)}
    assert (rates[1, 1].retention_rate, rates[1, 1].ci_lower, rates[1, 1].ci_upper) == (1.0, 1.0, 1.0)
    assert (rates[1, 3].retention_rate, rates[1, 3].ci_lower, rates[1, 3].ci_upper) == (0.0, 0.0, 0.0)
    assert rates[1, 7].ci_lower == pytest.approx(0.5 - 1.96 * 0.25)


@pytest.mark.parametrize("dates, kept", [([1], [1]), ([1, 2], [1, 2]), ([1, 2, 3], [2])])
def test_trimming_needs_more_than_two_dates(spark, dates, kept):
    wide = long(spark, *[(day(n), v, 9, 3, 2, 1, 0, 9) for n in dates for v in (0, 1)])
    assert sorted(r.dt.day for r in retention.daily_report(wide, JULY, evaluate=False).collect()) == kept
    assert sorted(r.dt.day for r in retention.daily_report(wide, JULY, trim=False, evaluate=False).collect()) == dates


def test_report_without_control(spark):
    wide = long(spark, *[(day(n), 1, 9, 3, 2, 1, 0, 9) for n in (1, 2)])
    for row in retention.daily_report(wide, JULY).collect():
        assert row.control_users is None and row.uplift is None and row.chance_to_win is None
        assert row.uplift_ci_lower is None and row.exp_users == 9
    assert retention.overall_report(wide, JULY, filter_by_cutoff=False).count() == 0
    sums = spark.createDataFrame([(1, 10, 5.0, 0.5, 0.2, 1.0)], "variation int, total_active_users long, "
                                 "total_recharge_revenue double, recharge_ARPU double, recharge_conversion_rate double, recharge_frequency double")
    assert recharge.recharge_evaluation(sums, JULY).count() == 0


def test_cutoff_leaves_out_young_cohorts(spark):
    wide = long(spark, *[(day(n), v, 10, 5, 4, 3, 2, 9) for n in range(1, 11) for v in (0, 1, 2)])
    rows = got(retention.overall_report(wide, JULY), "day", "variation")
    assert set(rows) == {(n, v) for n in (1, 3, 7) for v in (1, 2)}
    assert rows[1, 1].exp_users == 80 and rows[3, 1].exp_users == 60 and rows[7, 2].exp_users == 20
    assert rows[1, 1].freq_uplift == 0 and rows[1, 1].overall_d3_uplift is None
    assert rows[1, 1].overall_chance_to_win == pytest.approx(0.5, abs=1e-6)
    uncut = got(retention.overall_report(wide, JULY, filter_by_cutoff=False), "day", "variation")
    assert uncut[15, 1].exp_users == 80


def test_retention_counts_exact_days(spark):
    seen = [("u", n) for n in (2, 3, 5, 9, 17)] + [("v", 2), ("v", 4)] + [("", 2)]
    t = tables(spark, assignment=[given("u", 0, 2), given("v", 0, 2), given("w", 1, 2)],
               first_visit=[{"user_id": u, "first_visit_date": day(2)} for u in "uvwx"],
               active=[{"user_id": u, "active_date": day(n), "keep_alive_flag": 1} for u, n in seen]
               + [{"user_id": "v", "active_date": day(3), "keep_alive_flag": 0}])
    new = got(retention.new_user_retention(t, JULY), "dt", "variation")
    assert tuple(new[day(2), 0])[2:] == (2, 1, 1, 1, 0, 2)  # the 15th day lies after the phase
    assert tuple(new[day(2), 1])[2:] == (1, 0, 0, 0, 0, 1)
    active = got(retention.active_user_retention(t, JULY), "dt", "variation")
    assert tuple(active[day(2), 0])[2:] == (2, 1, 1, 1, 1, 2)
    assert (day(2), 1) not in active and (day(17), 0) not in active


def test_retention_over_more_days_than_a_word_has_bits(spark):
    exp = Experiment("exp", "tag", datetime(2024, 1, 1), datetime(2024, 6, 30))
    from datetime import timedelta
    start = exp.first_day
    offsets = [0, 1, 62, 63, 64, 65, 70, 127, 128, 135]
    t = tables(spark, assignment=[{**given("u", 0, 1), "timestamp_assigned": datetime(2024, 1, 1, 5)}],
               active=[{"user_id": "u", "active_date": start + timedelta(n), "keep_alive_flag": 1} for n in offsets])
    rows = got(retention.active_user_retention(t, exp), "dt")
    found = {n: tuple(rows[(start + timedelta(n),)])[3:7] for n in offsets}
    assert found == {n: tuple(int(n + h in offsets) for h in (1, 3, 7, 15)) for n in offsets}


def test_merging_parts_equals_a_single_run(spark):
    rows = [given(f"u{i}", i % 2, 2 + i % 3) for i in range(40)]
    t = tables(spark, assignment=rows, first_visit=[{"user_id": f"u{i}", "first_visit_date": day(2 + i % 3)} for i in range(40)],
               active=[{"user_id": f"u{i}", "active_date": day(3 + i % 4), "keep_alive_flag": 1} for i in range(40)])
    parts = retention.new_user_retention(t, JULY, parts=7)
    assert parts.select("part").distinct().count() > 1
    whole = retention.new_user_retention(t, JULY)
    assert sorted(map(tuple, retention.merge_partials(parts).select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_country_totals(spark):
    t = tables(spark, assignment=[given("u", 0, 2), given("v", 0, 2), given("v", 0, 3)],
               active=[{"user_id": u, "active_date": day(3), "keep_alive_flag": 1} for u in "uv"],
               app_event=[{"user_id": "u", "geo": '{"country":"A"}'}, {"user_id": "u", "geo": '{"country":"B"}'},
                          {"user_id": "v", "geo": "{}"}, {"user_id": "v", "geo": "not json"}])
    rows = got(retention.country_retention(t, JULY, distinct_totals=False), "dt", "country")
    assert set(rows) == {(day(3), "B")} and rows[day(3), "B"].total_assigned == 1
    assert got(retention.country_retention(t, JULY), "dt", "country")[day(3), "B"].total_assigned == 0


def purchase(user, n, revenue, kind="currency"):
    return {"user_id": user, "event_date": day(n), "revenue": revenue, "type": kind}


def test_equal_prices_on_one_day(spark):
    t = tables(spark, assignment=[given("u", 0, 2), given("u", 0, 3), given("v", 0, 3)],
               all_purchase=[purchase("u", 3, 5.0), purchase("u", 3, 5.0), purchase("v", 3, 7.0, "gift")])
    row = business.payment_ratio(t, JULY).first()
    assert (row.revenue, row.paying_users, row.total_users, row.purchase_rate) == (10.0, 1, 2, 0.5)
    assert business.payment_ratio(t, JULY, as_published=True).first().revenue == 5.0


def test_no_payers_give_no_value(spark):
    t = tables(spark, assignment=[given("u", 0, 3)], all_purchase=[purchase("u", 3, 7.0, "gift")])
    row = business.payment_ratio(t, JULY).first()
    assert (row.paying_users, row.revenue, row.LTV7, row.purchase_rate) == (0, 0.0, None, 0.0)


def notice(user, n, kind, order="o"):
    return {"user_id": user, "order_id": order, "sub_date": day(n), "notification_type": kind}


@pytest.mark.parametrize("cancelled, within, same_day", [(4, 1, 1), (7, 1, 0), (8, 0, 0), (3, 0, 0)])
def test_cancellations(spark, cancelled, within, same_day):
    t = tables(spark, assignment=[given("u", 0, 4)], apple=[notice("u", 4, "SUBSCRIBED")],
               google=[notice("u", cancelled, "3"), notice("u", 4, "3", order="other")],
               geo=[{"user_id": "u", "event_date": day(n), "country": "A"} for n in range(1, 11)])
    assert business.cancellation_rate(t, JULY).first().unsub_in3d == within
    assert business.cancellation_rate(t, JULY, same_day_only=True).first().unsub_in3d == same_day


def test_cancellations_without_country_never_match(spark):
    t = tables(spark, assignment=[given("u", 0, 4)], apple=[notice("u", 4, "SUBSCRIBED"), notice("u", 5, "DID_CHANGE_RENEWAL_STATUS")])
    row = business.cancellation_rate(t, JULY).first()
    assert (row.country, row.total_subs, row.unsub_in3d) == (None, 1, 0)
    geo = [{"user_id": "u", "event_date": day(4), "country": "A"}, {"user_id": "u", "event_date": day(5), "country": "B"}]
    t = tables(spark, assignment=[given("u", 0, 4)], geo=geo,
               apple=[notice("u", 4, "SUBSCRIBED"), notice("u", 5, "DID_CHANGE_RENEWAL_STATUS")])
    assert business.cancellation_rate(t, JULY).first().unsub_in3d == 0


def test_fanout_multiplies_each_kind_by_the_other(spark):
    t = tables(spark, assignment=[given("u", 0, 3), given("v", 1, 3)],
               subscribe=[{"user_id": "u", "event_date": day(3), "new_subscription": x, "new_product_subscription": True} for x in (True, False)],
               currency=[{"user_id": u, "event_date": day(3), "is_first_flux": 0} for u in ("u", "u", "u", "v")])
    apart, joined = (got(subscription.subscription_orders(t, JULY, fanout=f), "variation_id") for f in (False, True))
    assert [(apart[v,].subscribe_orders, apart[v,].flux_orders) for v in (0, 1)] == [(2, 3), (0, 1)]
    assert [(joined[v,].subscribe_orders, joined[v,].flux_orders) for v in (0, 1)] == [(6, 6), (0, 1)]
    assert joined[0,].subscribe_repeat_orders == 3 and joined[0,].subscribe_repurchase_rate == 0.5


def test_null_variation_keeps_its_users_but_gets_no_events(spark):
    t = tables(spark, assignment=[given("u", None, 3)], currency=[{"user_id": "u", "event_date": day(3), "revenue": 5.0, "is_first_flux": 0}],
               session=[{"user_id": "u", "event_date": day(3), "duration": 1.0}],
               ads_impression=[{"user_id": "u", "event_date": day(3), "ad_revenue": 2.0}])
    row = business.revenue_per_user(t, JULY).first()
    assert (row.variation_id, row.active_users, row.total_revenue) == (None, 1, 0.0)
    row = recharge.recharge(t, JULY).first()
    assert (row.variation, row.total_active_users, row.total_recharge_revenue, row.recharge_frequency) == (None, 1, None, None)
    assert recharge.rolled_up(recharge.recharge(t, JULY)).count() == 0
    row = ads.ads(t, JULY).first()
    assert (row.total_ad_revenue, row.ad_exposure_count, row.ecpm, row.ad_exposure_per_user) == (0.0, 0, 0.0, 0.0)


def test_users_of_two_variations_count_in_both(spark):
    t = tables(spark, assignment=[given("u", 0, 2), given("u", 1, 3)],
               currency=[{"user_id": "u", "event_date": day(4), "revenue": 5.0}] * 2)
    rows = got(recharge.recharge(t, JULY), "variation")
    assert all(rows[v,].total_recharge_revenue == 10.0 and rows[v,].recharge_frequency == 2.0 for v in (0, 1))


def chat_row(event, user, n, **more):
    return {"event_id": event, "user_id": user, "event_date": day(n), "ingest_timestamp": at(n), "method": "edit", **more}


def test_events_delivered_twice_count_once(spark):
    t = tables(spark, assignment=[given("u", 0, 3)], chat=[chat_row("e", "u", 3), chat_row("e", "u", 3), chat_row("f", "u", 3)])
    row = engagement.edits(t, JULY).first()
    assert (row.total_edit, row.unique_edit_users, row.edit_ratio) == (2, 1, 2.0)


def test_shared_conversations_count_once_per_variation(spark):
    t = tables(spark, assignment=[given("u", 0, 3), given("v", 0, 3), given("v", 1, 3, 13)],
               chat=[chat_row(e, u, 3, conversation_id="c") for e, u in (("e", "u"), ("f", "v"))])
    rows = got(engagement.new_conversations(t, JULY), "variation")
    assert [(rows[v,].total_new_conversation, rows[v,].unique_new_conversation_users) for v in (0, 1)] == [(1, 2), (1, 1)]


def test_idle_variations_have_rows(spark):
    t = tables(spark, assignment=[given("u", 0, 3), given("v", 1, 3)], chat=[chat_row("e", "u", 4, method="regenerate")])
    rows = got(engagement.regenerations(t, JULY), "event_date", "variation")
    assert len(rows) == 8 * 2
    assert rows[day(4), 0].total_regen == 1 and rows[day(4), 1].total_regen == 0 and rows[day(5), 0].regen_ratio == 0.0
    rows = got(chat.click_rate(t, JULY), "event_date", "variation")
    assert len(rows) == 8 * 2 and rows[day(4), 1].showed_events is None and rows[day(4), 1].clicked_events == 0


def test_last_second_of_a_day_is_left_out(spark):
    late = chat_row("f", "u", 3, ingest_timestamp=datetime(2024, 7, 3, 23, 59, 59))
    t = tables(spark, assignment=[given("u", 0, 8)],
               chat=[chat_row("e", "u", 3, ingest_timestamp=datetime(2024, 7, 3, 23, 59, 58, 999999)), late,
                     chat_row("g", "u", 5), chat_row("h", "u", 11)])
    row = engagement.edits_of_phase(t, JULY).first()
    assert (row.total_edit, row.unique_edit_users, row.edit_ratio) == (2, 2, 1.0)


def test_chat_depth_numerators_differ(spark):
    rows = [chat_row("e", "u", 3, prompt_id="b"), chat_row("e", "u", 3, prompt_id="b"), chat_row("f", "v", 3, prompt_id="c"),
            chat_row("g", "v", 3, prompt_id="c", method=None), chat_row("h", "v", 3, prompt_id="c", method="generate")]
    t = tables(spark, assignment=[given("u", 0, 3), given("v", 0, 3)], chat=[{**r, "source": "tag:Explore"} for r in rows],
               first_visit=[{"user_id": "u", "first_visit_date": day(3)}])
    row = chat.chat_depth(t, JULY).first()
    assert (row.total_chat_rounds, row.unique_users, row.chat_bots) == (2, 2, 2)
    assert (row.chat_depth_user, row.chat_depth_user_new) == (1.0, 2.0)
    row = chat.explore_chat_depth(t, JULY).first()
    assert (row.total_chat_rounds, row.chat_depth_user, row.chat_depth_user_new) == (5, 2.0, 1.0)


def test_clicks_without_cards_do_not_count(spark):
    t = tables(spark, assignment=[given("u", 0, 3), given("v", 0, 3)],
               show_card=[{"event_id": "s", "user_id": "u", "event_date": day(3)}],
               bot_view=[{"event_id": e, "user_id": u, "event_date": day(3)} for e, u in (("a", "u"), ("b", "v"))])
    row = got(chat.click_rate(t, JULY), "event_date")[day(3),]
    assert (row.showed_events, row.clicked_events, row.click_ratio, row.new_user_click_ratio) == (1, 1, 1.0, None)
