"""Revenue per order, user and paying user; lifetime value; payment and cancellation rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.ratios import half_up, money, money_of, ratio, total, total_of
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.assignment import labelled, labelled_value
from trialmetrics.operators.events import USER_DAY, new_user_days, of, stacked
from trialmetrics.operators.windows import Days, EachDays
from trialmetrics.sources.tables import Tables

REPORT = ["event_date", "variation_id"]
PAID = "type IN ('subscription', 'currency')"


def _orders(t: Tables, days: Days | EachDays, *names: str) -> DataFrame:
    """Revenue and number of orders per user and day."""
    rows = stacked(**{name: t[name].filter(days.contain("event_date")).select(*USER_DAY, "revenue") for name in names})
    return rows.groupBy(*USER_DAY).agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))


def order_value(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """B1. Average order value per day."""
    days = windows.without_first(exp)
    orders = _orders(t, days, "currency", "subscribe")
    rows = days.narrowed(orders.join(assignment.resolve(t, exp, "user_first"), "user_id"))
    return (
        rows.groupBy(*exp.keys, *REPORT)
        .agg(money("revenue").alias("total_revenue"), F.sum("orders").alias("total_order_cnt"))
        .withColumn("aov", ratio("total_revenue", "total_order_cnt", 2))
    )


def _new_assigned(t: Tables, exp: Experiment | Experiments, days: Days | EachDays) -> DataFrame:
    """New users of a day with the variation they were given on that day."""
    new = new_user_days(t["first_visit"], days).drop("is_new")
    return assignment.resolve(t, exp, "daily_first", days).join(new, USER_DAY)


def new_user_order_value(t: Tables, exp: Experiment | Experiments, subscriptions_only: bool = False) -> DataFrame:
    """B2, and B3 for subscriptions only. Orders of new users up to 1 and up to 3 days after the first visit."""
    days = windows.whole(exp)
    names = ("subscribe",) if subscriptions_only else ("subscribe", "currency")
    orders = _orders(t, days.widened(after=3), *names).withColumnRenamed("event_date", "ordered_on")
    soon = F.col("ordered_on") <= F.date_add("event_date", 1)
    rows = _new_assigned(t, exp, days).join(orders, "user_id").filter(
        F.col("ordered_on").between(F.col("event_date"), F.date_add("event_date", 3)))
    revenue, count, mean = (("subscribe_revenue", "subscribe_order_cnt", "aov_subscribe") if subscriptions_only
                            else ("revenue", "order_cnt", "aov"))
    sums = rows.groupBy(*exp.keys, *REPORT).agg(
        money_of(soon, "revenue").alias(f"{revenue}_day1"), total_of(soon, "orders").alias(f"{count}_day1"),
        money("revenue").alias(f"{revenue}_day3"), F.sum("orders").alias(f"{count}_day3"))
    parts = [[f"{revenue}_day{n}", f"{count}_day{n}",
              ratio(f"{revenue}_day{n}", f"{count}_day{n}", 2).alias(f"{mean}_day{n}")] for n in (1, 3)]
    return sums.select(*exp.keys, *REPORT, *parts[0], *parts[1])


def _revenue_streams(t: Tables, days: Days | EachDays, **more: DataFrame) -> DataFrame:
    """Subscription, order and ad revenue per user and day, 0 where there is none.

    The streams are added up in one aggregation over their union: one shuffle instead of
    one per stream and a join for each.
    """
    def stream(name: str, value: str) -> DataFrame:
        return t[name].filter(days.contain("event_date")).select(*USER_DAY, F.col(value).alias(f"{name}_value"))

    rows = stacked(subscribe=stream("subscribe", "revenue"), currency=stream("currency", "revenue"),
                   ads_impression=stream("ads_impression", "ad_revenue"), **more)
    names = ("subscribe", "currency", "ads_impression")
    return rows.groupBy(*USER_DAY).agg(
        *[F.coalesce(F.sum(f"{name}_value"), F.lit(0.0)).alias(name) for name in names],
        F.max(of("subscribe") | of("currency")).alias("paid"), F.max(of("session")).alias("active"))


def revenue_per_user(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """B4. Revenue of all assigned users over those with a session that day."""
    days = windows.inner(exp)
    sessions = t["session"].filter(days.contain("event_date")).select(*USER_DAY)
    facts = _revenue_streams(t, days, session=sessions)
    sums = (
        assignment.resolve(t, exp, "daily_first", days).join(facts, USER_DAY, "left").groupBy(*exp.keys, *REPORT)
        .agg(total("active").alias("active_users"),
             *[F.coalesce(money(labelled_value(name)), F.lit(0.0)).alias(f"total_{label}_revenue") for name, label in
               (("subscribe", "subscribe"), ("currency", "order"), ("ads_impression", "ad"))])
        .filter("active_users > 0")
    )
    revenue = F.round(F.col("total_subscribe_revenue") + F.col("total_order_revenue") + F.col("total_ad_revenue"), 6)
    return sums.withColumn("total_revenue", revenue).withColumn("ARPU", ratio("total_revenue", "active_users", 4))


def revenue_per_paying_user(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """B5. Purchases plus the variation's whole ad revenue, over paying users."""
    days = windows.inner(exp)
    facts = _revenue_streams(t, days)
    sums = (
        days.narrowed(facts.join(assignment.resolve(t, exp, "user_latest_day"), "user_id")).groupBy(*exp.keys, *REPORT)
        .agg(money("subscribe").alias("total_subscribe_revenue"), money("currency").alias("total_order_revenue"),
             F.coalesce(money(labelled_value("ads_impression")), F.lit(0.0)).alias("ads"),
             total("paid").alias("paying_users"))
        .filter("paying_users > 0")
    )
    revenue = F.round(F.col("total_subscribe_revenue") + F.col("total_order_revenue") + F.col("ads"), 6)
    return sums.select(
        *exp.keys, *REPORT, "total_subscribe_revenue", "total_order_revenue", revenue.alias("total_revenue"), "paying_users",
        labelled_value("paying_users").alias("active_users"), ratio(revenue, "paying_users", 4).alias("arppu"))


def lifetime_value(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """B6. Revenue of users by first active day, within 7 days and within the phase's length.

    Both horizons are summed on one pass over the revenue.
    """
    days = windows.without_first(exp)
    users = (
        t["business_user"].filter(days.contain("first_active_date"))
        .select("user_id", F.col("first_active_date").alias("event_date")).distinct()
        .join(assignment.resolve(t, exp, "user_first").filter("variation_id IS NOT NULL"), "user_id")
    )
    cycle, horizon = F.lit(exp.span_days), F.lit(max(7, exp.span_days))
    if exp.keys:
        users = days.narrowed(users).join(exp.phases(t.spark).select("tag", "span_days"), "tag")
        cycle, horizon = F.col("span_days"), F.greatest(F.lit(7), "span_days")
    parts = [F.coalesce(name, F.lit(0.0)) for name in ("ad_revenue", "subscribe_revenue", "flux_revenue")]
    revenue = (
        t["daily_revenue"].filter(days.widened(after=max(7, exp.span_days)).contain("event_date"))
        .groupBy("user_id", F.col("event_date").alias("earned_on"))
        .agg(F.sum(parts[0] + parts[1] + parts[2]).alias("revenue"))
    )
    age = F.datediff("earned_on", "event_date")
    rows = users.alias("u").join(
        revenue.alias("r"), (F.col("u.user_id") == F.col("r.user_id"))
        & F.col("earned_on").between(F.col("event_date"), F.date_add("event_date", horizon)), "left")
    per_user = rows.groupBy("u.user_id", *exp.keys, *REPORT).agg(
        total_of(age <= 7, "revenue").alias("revenue_7d"), total_of(age <= cycle, "revenue").alias("revenue_cycle"))
    sums = per_user.groupBy(*exp.keys, *REPORT).agg(
        F.count("*").alias("register_users"), money("revenue_7d").alias("week"), money("revenue_cycle").alias("cycle"))
    return sums.select(
        *exp.keys, *REPORT, "register_users", half_up("week", 2).alias("revenue_7d"), half_up("cycle", 2).alias("revenue_cycle"),
        ratio("week", "register_users", 4).alias("ltv_7d"), ratio("cycle", "register_users", 4).alias("ltv_cycle"))


def _geo(t: Tables, days: Days | EachDays) -> DataFrame:
    """Countries of each user and day. One exchange, which the joins on user and day share; the array
    holds the countries of one user-day. A struct, since a set leaves out NULLs."""
    seen = t["geo"].filter(days.contain("event_date")).groupBy(*USER_DAY).agg(F.collect_set(F.struct("country")).alias("seen"))
    return seen.select(*USER_DAY, F.inline("seen"))


def payment_rate_by_country(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """B7. Of the assigned users with a session, by country, the share that paid that day."""
    days = windows.without_first(exp)
    flags = stacked(
        session=t["session"].filter(days.contain("event_date")).select(*USER_DAY),
        paid=t["all_purchase"].filter(days.contain("event_date")).filter(PAID).select(*USER_DAY),
    ).groupBy(*USER_DAY).agg(F.max(of("session")).alias("active"), F.max(of("paid")).alias("paid"))
    sums = (
        assignment.resolve(t, exp, "daily_first", days).join(flags.filter("active"), USER_DAY)
        .join(_geo(t, days), USER_DAY).groupBy(*exp.keys, "event_date", "country", "variation_id")
        .agg(F.count("*").alias("active_users"),
             total(labelled(F.col("paid") & F.col("country").isNotNull())).alias("paying_users"))
    )
    return sums.withColumn("purchase_rate", ratio("paying_users", "active_users", 4))


def new_user_payment_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """B8. New users by country, and how many paid up to 1 and up to 3 days after the first visit."""
    days = windows.whole(exp)
    new = _new_assigned(t, exp, days).filter("variation_id IS NOT NULL").join(_geo(t, days), USER_DAY, "left")
    paid = (t["all_purchase"].filter(days.widened(after=3).contain("event_date")).filter(PAID)
            .select("user_id", F.col("event_date").alias("paid_on")).distinct())
    age = F.datediff("paid_on", "event_date")
    rows = new.alias("n").join(
        paid.alias("p"), (F.col("n.user_id") == F.col("p.user_id"))
        & F.col("paid_on").between(F.col("event_date"), F.date_add("event_date", 3)), "left")
    keys = [*exp.keys, "event_date", "variation_id", F.coalesce("country", F.lit("unknown")).alias("country")]
    per_user = rows.groupBy("n.user_id", *keys).agg(
        F.max(age <= 1).alias("day1"), F.max(age <= 3).alias("day3"))
    sums = per_user.groupBy(*exp.keys, "event_date", "variation_id", "country").agg(
        F.count("*").alias("new_users"), total("day1").alias("pay_user_day1"),
        total("day3").alias("pay_user_day3"))
    return sums.select(
        *exp.keys, "event_date", "variation_id", "country", "new_users",
        "pay_user_day1", ratio("pay_user_day1", "new_users", 4).alias("pay_rate_day1"),
        "pay_user_day3", ratio("pay_user_day3", "new_users", 4).alias("pay_rate_day3"))


def payment_ratio(t: Tables, exp: Experiment | Experiments, as_published: bool = False) -> DataFrame:
    """B9. Of the assigned users with any purchase, those who bought a subscription or currency.

    ``as_published`` keeps two habits of the original report: purchases of one user and
    day at the same price count once, and every purchase counts as made on the user's
    first day, so that LTV7 equals LTV_experiment.
    """
    days = windows.without_first(exp)
    bought = t["all_purchase"].filter(days.contain("event_date"))
    if as_published:
        bought = bought.select(*USER_DAY, "revenue", F.expr(PAID).alias("paid")).distinct()
    else:
        bought = bought.select(*USER_DAY, "revenue", F.expr(PAID).alias("paid"))
    facts = bought.groupBy(*USER_DAY).agg(
        F.max("paid").alias("paid"), F.coalesce(F.sum(F.when(F.col("paid"), F.col("revenue"))), F.lit(0.0)).alias("revenue"))
    users = assignment.resolve(t, exp, "daily_first", windows.whole(exp))
    age = F.lit(0)
    if not as_published:
        first = F.min("event_date").over(Window.partitionBy(*exp.keys, "user_id", "variation_id"))
        users = users.withColumn("first_day", first)
        age = F.datediff("event_date", "first_day")
    sums = days.narrowed(users.join(facts, USER_DAY)).groupBy(*exp.keys, "variation_id", "event_date").agg(
        total(labelled(F.col("paid"))).alias("paying_users"),
        money_of(labelled(F.lit(True)), "revenue").alias("revenue"),
        money_of(labelled(age <= 7), "revenue").alias("week"), F.count("*").alias("total_users"))
    return sums.select(
        *exp.keys, "variation_id", "event_date", "paying_users", "revenue", ratio("week", "paying_users", 4).alias("LTV7"),
        ratio("revenue", "paying_users", 4).alias("LTV_experiment"), "total_users",
        ratio("paying_users", "total_users", 4).alias("purchase_rate"))


def cancellation_rate(t: Tables, exp: Experiment | Experiments, same_day_only: bool = False) -> DataFrame:
    """B10. Of the users who subscribed or renewed on a day, those who cancelled up to 3 days later.

    A cancellation belongs to a subscription of the same user, order and country.
    ``same_day_only`` reproduces the original report, where only cancellations of the day
    itself have a country and so can match.

    Subscriptions and cancellations of an order lie in one window ordered by day, where a
    range frame looks ahead; no self-join.
    """
    days = windows.whole(exp)
    kind = F.col("notification_type")

    def marked(name: str, subscribed: tuple[str, ...], cancelled: str) -> DataFrame:
        day = F.to_date("sub_date")
        rows = t[name].filter(days.widened(after=3).contain(day) & kind.isin(*subscribed, cancelled))
        return rows.select("user_id", "order_id", day.alias("event_date"),
                           kind.isin(*subscribed).alias("subscribed"), (kind == cancelled).alias("cancelled"))

    notices = stacked(
        apple=marked("apple", ("SUBSCRIBED", "DID_RENEW"), "DID_CHANGE_RENEWAL_STATUS"),
        google=marked("google", ("2", "4"), "3"),
    ).groupBy("user_id", "order_id", "event_date").agg(
        F.max("subscribed").alias("subscribed"), F.max("cancelled").alias("cancelled"))
    users = assignment.resolve(t, exp, "daily_first", days).filter("variation_id IS NOT NULL")
    located = notices.join(_geo(t, days.widened(after=3)), USER_DAY, "left")
    if not exp.keys:
        # Country and variation both hang on (user, day): one exchange of the notices serves both joins.
        located = located.join(users, USER_DAY, "left")
    ahead = (Window.partitionBy("user_id", "order_id", "country").orderBy(F.unix_date("event_date"))
             .rangeBetween(0, 0 if same_day_only else 3))
    known = F.col("country").isNotNull() & F.col("order_id").isNotNull()
    followed = located.withColumn("left", F.max("cancelled").over(ahead) & known).filter("subscribed")
    if exp.keys:  # looked ahead once for all of them
        followed = followed.join(users, USER_DAY)
    rows = (
        followed.filter("variation_id IS NOT NULL")
        .groupBy(*exp.keys, *USER_DAY, "country", "variation_id").agg(F.max("left").alias("left"))
    )
    sums = rows.groupBy(*exp.keys, "event_date", "country", "variation_id").agg(
        F.count("*").alias("total_subs"), total("left").alias("unsub_in3d"))
    return sums.withColumn("unsub_rate_day3", ratio("unsub_in3d", "total_subs", 4))
