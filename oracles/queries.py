"""Every query by name, over the test tables in a folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from trialmetrics import Experiment, Tables, registry
from trialmetrics.experiment import Experiments
from trialmetrics.functions import means, proportions, ranks, resampling
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.history import History
from trialmetrics.plans import ads, business, catalog, chat, engagement, recharge, retention, subscription
from trialmetrics.publish import export_csv, preview, publish, publish_days, published, typed, with_headings, EDIT_HEADINGS, RETENTION_HEADINGS
from trialmetrics.session import shared_folder
from trialmetrics.sources.documents import read_experiment_documents
from trialmetrics.sources.fixtures import PHASE, fixture_tables
from trialmetrics.sources.quarantine import Quarantine
from trialmetrics.sources.tables import numeric_sample, read_csv

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = datetime(2001, 8, 2, 8)


def own_folder(spark: SparkSession, name: str) -> str:
    """A shared folder of this call alone, so that two runs do not overwrite each other."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of doubles differ in the last bits with the order of addition."""
    return df.select(*[
        F.round(field.name, digits).alias(field.name) if isinstance(field.dataType, T.DoubleType) else field.name
        for field in df.schema])


def _report(job: Callable[[Tables, Experiment], DataFrame], hard: bool = False, **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(job(fixture_tables(spark, folder, hard), PHASE, **options))
    return query


def _after(base, job: Callable[..., DataFrame], hard: bool = False, **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(job(base(fixture_tables(spark, folder, hard), PHASE), PHASE, **options))
    return query


def _resolved(policy: str, **scope) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return assignment.resolve(fixture_tables(spark, folder), PHASE, policy, **scope)
    return query


def _sample(job: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(job(fixture_tables(spark, folder)["user_aov"], **options))
    return query


def _phase_days(spark: SparkSession, folder: str) -> DataFrame:
    sessions = fixture_tables(spark, folder)["session"]
    policies = {
        "w1_whole": windows.whole(PHASE), "w2_without_first": windows.without_first(PHASE),
        "w3_inner": windows.inner(PHASE), "w4_without_last": windows.without_last(PHASE),
        "w5_explore": windows.explore(PHASE), "w6_inner_if_long": windows.inner_if_long(PHASE),
        "w8_bounds_as_days": windows.between_times(PHASE), "w8_bounds_as_times": windows.between_times(PHASE, strict=True)}
    names = F.array_compact(F.array(*[F.when(days.contain("event_date"), name) for name, days in policies.items()]))
    return sessions.select("event_date", F.explode(names).alias("days")).groupBy("days").agg(
        F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"), F.count("*").alias("sessions"))


def _ingest_days(spark: SparkSession, folder: str) -> DataFrame:
    days, moment = windows.ingest_days(PHASE), F.col("ingest_timestamp")
    chats = fixture_tables(spark, folder)["chat"].filter(
        (moment >= windows.moment_of(days.first)) & (moment < windows.moment_of(days.widened(after=1).last))
        & windows.before_last_second(moment))
    return chats.groupBy(F.to_date(moment).alias("day")).agg(F.count("*").alias("chats"))


def _new_rates(spark: SparkSession, folder: str) -> DataFrame:
    return retention.retention_rates(retention.new_user_retention(fixture_tables(spark, folder), PHASE))


def _trimmed(spark: SparkSession, folder: str) -> DataFrame:
    return windows.trimmed(_new_rates(spark, folder)).select("dt", "variation", "day", "users", "retained")


def _matured(spark: SparkSession, folder: str) -> DataFrame:
    rates = _new_rates(spark, folder)
    latest = F.max("dt").over(Window.partitionBy("day"))
    return windows.matured(rates.withColumn("latest", latest), F.col("latest")).select(
        "dt", "variation", "day", "users", "retained")


def _merged_parts(spark: SparkSession, folder: str) -> DataFrame:
    return retention.merge_partials(retention.new_user_retention(fixture_tables(spark, folder), PHASE, parts=20))


def _payers(spark: SparkSession, folder: str) -> DataFrame:
    """Users per country and those who paid more than 40 at once."""
    users = spark.read.parquet(f"{folder}/events.parquet").groupBy("user_id").agg(
        F.max((F.col("event_type") == "purchase") & (F.col("value") > 40)).alias("paid"))
    countries = spark.read.parquet(f"{folder}/nation.parquet")
    return users.join(countries, F.col("n_nationkey") == F.col("user_id") % 25).groupBy(
        F.col("n_name").alias("country"), F.col("n_regionkey").alias("region")).agg(
        F.count("*").alias("users"), F.count(F.when(F.col("paid"), 1)).alias("payers"))


def _proportion(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(proportions.wald_interval(_payers(spark, folder).drop("region"), "payers", "users"))


def _beta(spark: SparkSession, folder: str) -> DataFrame:
    """T2. Each country against the first one of its region."""
    region = Window.partitionBy("region").orderBy("country").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = _payers(spark, folder).withColumns({
        "control_users": F.first("users").over(region), "control_payers": F.first("payers").over(region)})
    compared = proportions.beta_comparison(rows, "control_payers", "control_users", "payers", "users")
    return rounded(compared.select("country", "users", "payers", "control_users", "control_payers", "uplift", "chance_to_win"))


def _beta_interval(spark: SparkSession, folder: str) -> DataFrame:
    """T2. The ends of the interval of the uplift."""
    region = Window.partitionBy("region").orderBy("country").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = _payers(spark, folder).withColumns({
        "control_users": F.first("users").over(region), "control_payers": F.first("payers").over(region)})
    compared = proportions.beta_comparison(rows, "control_payers", "control_users", "payers", "users")
    return rounded(compared.select("country", "uplift_ci_lower", "uplift_ci_upper"))


def _normal(spark: SparkSession, folder: str) -> DataFrame:
    """T3. Mean amount of each country against the first one of its region."""
    region = Window.partitionBy("n_regionkey").orderBy("country").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    means_ = spark.read.parquet(f"{folder}/events.parquet").join(
        spark.read.parquet(f"{folder}/nation.parquet"), F.col("n_nationkey") == F.col("user_id") % 25).groupBy(
        "n_regionkey", F.col("n_name").alias("country")).agg(F.avg("value").alias("mean"))
    rows = means_.withColumn("control_mean", F.first("mean").over(region))
    return rounded(rows.select("country", "mean", "control_mean",
                               means.assumed_normal_win("control_mean", "mean").alias("chance_to_win")))


def _pooled(spark: SparkSession, folder: str, hard: bool = False) -> DataFrame:
    tables = fixture_tables(spark, folder, hard)
    overall = retention.overall_report(retention.active_user_retention(tables, PHASE), PHASE)
    return overall.groupBy("day").agg(
        F.sum("exp_retained").alias("pooled_retained"), F.sum("exp_users").alias("pooled_users"),
        F.max("freq_uplift").alias("freq_uplift"))


def _numeric(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("user_id") % 7 == 0, "n/a").when(F.col("user_id") % 11 == 0, None).otherwise(
        F.col("user_aov").cast("string"))
    raw = fixture_tables(spark, folder)["user_aov"].select(
        F.col("variation_id").cast("string").alias("variation_id"), text.alias("user_aov"))
    return rounded(numeric_sample(raw))


def _tied_ranks(spark: SparkSession, folder: str) -> DataFrame:
    sample = spark.read.parquet(f"{folder}/orders.parquet").select(
        (F.col("o_custkey") % 2).alias("variation_id"), F.round("o_totalprice", -3).alias("user_aov"))
    return rounded(ranks.rank_test(sample, p_value=False))


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Experiment documents, one per order: with and without start, end, variations and a second tag."""
    key = F.col("o_orderkey")
    tags = F.concat(F.array(F.concat(F.lit(" tag "), (F.col("o_custkey") % 97).cast("string"))),
                    F.when(key % 3 == 0, F.array(F.concat(F.lit("team_"), (key % 11).cast("string")))).otherwise(
                        F.array().cast("array<string>")))
    variations = F.transform(F.slice(F.array(*map(F.lit, range(4))), 1, (key % 4).cast("int")), lambda i: F.struct(
        i.cast("string").alias("key"), F.concat(F.lit("v"), i.cast("string")).alias("name")))
    start = F.when(key % 17 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'.5Z'"))
    end = F.date_add("o_orderdate", (key % 120).cast("int"))
    end = F.concat(F.date_format(end, "yyyy-MM-dd'T12:00:00.25Z'"))
    phase = F.struct(F.when(key % 13 != 0, start).alias("dateStarted"), F.when(key % 5 != 0, end).alias("dateEnded"))
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        key.alias("position"), F.concat(F.lit("exp_"), key.cast("string")).alias("name"), tags.alias("tags"),
        variations.alias("variations"), F.array(phase).alias("phases"))


def _catalog(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(order_documents(spark, folder))


def _overridden(spark: SparkSession, folder: str) -> DataFrame:
    overrides = spark.read.parquet(f"{folder}/region.parquet").select(
        F.lit("tag_by_hand").alias("tag"), F.concat(F.lit("exp_by_hand_"), F.col("r_regionkey").cast("string")).alias("experiment_name"),
        F.lit("tag_by_hand").alias("tags"), windows.moment(datetime(2000, 12, 1)).alias("phase_start_time"),
        windows.moment(datetime(2000, 12, 20)).alias("phase_end_time"), F.lit(2).alias("number_of_variations"),
        F.lit("0").alias("control_group_key"))
    return catalog.experiment_table(order_documents(spark, folder), AS_OF, overrides)


def _table(documents: DataFrame) -> DataFrame:
    return catalog.experiment_table(documents, AS_OF)


def _republished(spark: SparkSession, folder: str) -> DataFrame:
    """B1 written twice under one tag and read back: one copy."""
    report, root = business.order_value(fixture_tables(spark, folder), PHASE), own_folder(spark, "published")
    for _ in range(2):
        publish(report, root, "order_value", PHASE.tag)
    return rounded(published(spark, root, "order_value", PHASE.tag))


ORDER_VALUE = T.StructType([
    T.StructField("event_date", T.DateType()), T.StructField("variation_id", T.IntegerType()),
    T.StructField("total_revenue", T.DoubleType()), T.StructField("total_order_cnt", T.LongType()),
    T.StructField("aov", T.DoubleType())])


def _csv(spark: SparkSession, folder: str) -> DataFrame:
    path = own_folder(spark, "order_value_csv")
    export_csv(business.order_value(fixture_tables(spark, folder), PHASE), path)
    return rounded(read_csv(spark, path, ORDER_VALUE))


def _bad_records(spark: SparkSession, folder: str) -> DataFrame:
    """S4. Orders from lines of text of which every nineteenth has no amount: read and set apart, by day."""
    path, cell = own_folder(spark, "lines"), F.when(F.col("event_id") % 19 == 0, "n/a").otherwise(F.col("revenue").cast("string"))
    lines = fixture_tables(spark, folder)["currency"].withColumn("revenue", cell)
    lines.select("event_id", "user_id", "event_date", "revenue", "is_first_flux").write.csv(f"{path}/currency", header=True)
    quarantine = Quarantine(f"{path}/bad", at_most=1_000_000_000)
    read = Tables.in_folder(spark, path, "csv", quarantine=quarantine)["currency"].select("event_date", "revenue", F.lit(0).alias("bad"))
    day = F.to_date(F.get_json_object("record", "$.event_date")).alias("event_date")
    apart = quarantine.bad(spark, "currency").select(day, F.lit(None).cast("double").alias("revenue"), F.lit(1).alias("bad"))
    return read.union(apart).groupBy("event_date").agg(
        F.count(F.when(F.col("bad") == 0, 1)).alias("orders"), F.round(F.sum("revenue"), 6).alias("revenue"), F.sum("bad").alias("set_apart"))


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(typed(business.order_value(fixture_tables(spark, folder), PHASE), ORDER_VALUE))


def _preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(chat.click_rate(fixture_tables(spark, folder), PHASE), "event_date", "variation")


def _headed(spark: SparkSession, folder: str) -> DataFrame:
    wide = retention.new_user_retention(fixture_tables(spark, folder), PHASE)
    return with_headings(rounded(retention.daily_report(wide, PHASE, evaluate=False)), RETENTION_HEADINGS)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """M5 from documents exported as JSON in pages of 100 and read again."""
    path = own_folder(spark, "order_documents_json")
    documents = order_documents(spark, folder)
    page = F.floor(F.col("position") / 100) * 100
    entry = F.struct("position", "name", "tags", "variations", "phases")
    pages = documents.groupBy(page.alias("offset")).agg(F.sort_array(F.collect_list(entry)).alias("experiments"))
    pages.write.mode("overwrite").json(path)
    return _table(read_experiment_documents(spark, path, one_per_file=False))


def _looked_up(spark: SparkSession, folder: str) -> DataFrame:
    """M8 to M10. The experiment table stored, and the experiment of each of its tags."""
    table = catalog.store(_table(order_documents(spark, folder)), own_folder(spark, "experiments"))
    return catalog.in_force(table).select("tag", "experiment_name", "phase_start_time", "phase_end_time", "number_of_variations")


def _rolled_up(t: Tables, exp: Experiment) -> DataFrame:
    return recharge.rolled_up(recharge.recharge(t, exp))


def _wins(wide: DataFrame, exp: Experiment, trim: bool = True) -> DataFrame:
    """The columns of the evaluated report that have a closed form."""
    return retention.daily_report(wide, exp, trim).select("dt", "variation", "control_users", "exp_users", "uplift", "chance_to_win")


def _together(name: str) -> Query:
    """M11. A report of several experiments in one pass, by tag."""
    return lambda spark, folder: rounded(registry.REPORTS[name](fixture_tables(spark, folder), Experiments(SEVERAL)))


def _run_together(spark: SparkSession, folder: str) -> DataFrame:
    """M11 and S6. Reports of several experiments published by a run, and read back for all tags."""
    root = own_folder(spark, "run")
    registry.run_all(fixture_tables(spark, folder), SEVERAL, root, ["recharge", "order_value"])
    return rounded(published(spark, root, "order_value"))


def _days_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """S6 and S11. B1 published by day up to a day, without one day and with a wrong one; both are then replaced, and
    the days after are added."""
    report, root = business.order_value(fixture_tables(spark, folder), PHASE), own_folder(spark, "published")
    days, late, wrong = windows.whole(PHASE), PHASE.day(5), PHASE.day(9)
    early = report.filter((F.col("event_date") != F.lit(late)) & windows.Days(days.first, PHASE.day(20)).contain("event_date"))
    publish_days(early.withColumn("total_revenue", F.when(F.col("event_date") == F.lit(wrong), -1.0).otherwise(F.col("total_revenue"))),
                 root, "order_value", PHASE.tag)
    publish_days(report, root, "order_value", PHASE.tag, days=[late, wrong])
    publish_days(report, root, "order_value", PHASE.tag, days=[PHASE.day(i) for i in range(21, PHASE.span_days + 1)])
    return rounded(published(spark, root, "order_value", PHASE.tag))


def kept_tables(spark: SparkSession, folder: str) -> Tables:
    """The tables with a history kept in three steps, each of which adds the rows of its own days."""
    t, history = fixture_tables(spark, folder), History(spark, own_folder(spark, "history"))
    cuts = [date(1900, 1, 1), date(2024, 1, 10), date(2024, 1, 20), date(2200, 1, 1)]
    for i, days in enumerate(windows.Days(a, b).widened(after=-1) for a, b in zip(cuts, cuts[1:])):
        history.add(t["active"].filter(days.contain("active_date")), t["assignment"].filter(days.contain("event_date")),
                    t["app_event"].filter(F.pmod(F.xxhash64("user_id"), F.lit(3)) == i))
    return t.with_history(history)


def _kept(job: Callable[[Tables, Experiment], DataFrame], **options) -> Query:
    return lambda spark, folder: rounded(job(kept_tables(spark, folder), PHASE, **options))


def _kept_parts(spark: SparkSession, folder: str) -> DataFrame:
    """R4. Counters of parts of the users, from bits that three runs have added up."""
    return retention.merge_partials(retention.new_user_retention(kept_tables(spark, folder), PHASE, parts=20))


new, active = retention.new_user_retention, retention.active_user_retention
#: Phases of the same assignments: the usual one, one inside it, and one that begins and ends later.
SEVERAL = [PHASE, Experiment("exp_a", "inside", datetime(2024, 1, 10), datetime(2024, 1, 19, 12)),
           Experiment("exp_a", "later", datetime(2024, 1, 17, 9), datetime(2024, 2, 6, 21))]
TOGETHER = ["order_value", "revenue_per_user", "lifetime_value", "cancellation_rate", "click_rate", "chat_depth", "retention_new",
            "retention_active", "recharge", "edits_of_phase"]
IN_PHASE = (PHASE.phase_start, PHASE.phase_end)
ONE_DAY = windows.Days(date(2024, 1, 15), date(2024, 1, 15))


def queries() -> dict[str, Query]:
    return {
        "a1_first_in_phase": _resolved("user_first", between=IN_PHASE),
        "a2_first_ever": _resolved("user_first"),
        "a3_latest_day": _resolved("user_latest_day"),
        "a4_daily_in_phase": _resolved("daily_first", days=windows.whole(PHASE)),
        "a5_daily_first": _resolved("daily_first"),
        "a6_daily_lowest": _resolved("daily_lowest"),
        "a7_first_day": _resolved("user_first_day"),
        "a8_one_day": _resolved("daily_first", days=ONE_DAY),
        "a9_any_in_phase": _resolved("any", days=windows.whole(PHASE)),
        "a10_any_daily": _resolved("any_daily"),
        "w_phase_days": _phase_days,
        "w7_ingest_days": _ingest_days,
        "w9_trimmed_dates": _trimmed,
        "w10_matured_dates": _matured,
        "r1_new_user_retention": _report(new),
        "r1_new_user_retention_strict": _report(new, strict_bounds=True),
        "r2_active_user_retention": _report(active),
        "r3_country_retention": _report(retention.country_retention),
        "r3_country_retention_raw_totals": _report(retention.country_retention, distinct_totals=False),
        "r4_merged_parts": _merged_parts,
        "r5_retention_rates": lambda spark, folder: rounded(_new_rates(spark, folder)),
        "r6_new_user_report": _after(new, retention.daily_report),
        "r6_new_user_report_rates": _after(new, retention.daily_report, evaluate=False),
        "r6_new_user_report_wins": _after(new, _wins),
        "r7_active_user_report_wins": _after(active, _wins, trim=False),
        "r7_active_user_report": _after(active, retention.daily_report, trim=False),
        "r7_active_user_report_rates": _after(active, retention.daily_report, trim=False, evaluate=False),
        "r8_new_user_overall": _after(new, retention.overall_report),
        "r9_active_user_overall": _after(active, retention.overall_report),
        "r9_active_user_overall_uncut": _after(active, retention.overall_report, filter_by_cutoff=False),
        "r10_image_use_rate": _report(retention.image_use_rate),
        "b1_order_value": _report(business.order_value),
        "b2_new_user_order_value": _report(business.new_user_order_value),
        "b3_new_user_subscription_value": _report(business.new_user_order_value, subscriptions_only=True),
        "b4_revenue_per_user": _report(business.revenue_per_user),
        "b5_revenue_per_paying_user": _report(business.revenue_per_paying_user),
        "b6_lifetime_value": _report(business.lifetime_value),
        "b7_payment_rate_by_country": _report(business.payment_rate_by_country),
        "b8_new_user_payment_rate": _report(business.new_user_payment_rate),
        "b9_payment_ratio": _report(business.payment_ratio),
        "b9_payment_ratio_as_published": _report(business.payment_ratio, as_published=True),
        "b10_cancellation_rate": _report(business.cancellation_rate),
        "b10_cancellation_rate_same_day": _report(business.cancellation_rate, same_day_only=True),
        "u1_subscription_orders": _report(subscription.subscription_orders),
        "u1_subscription_orders_fanout": _report(subscription.subscription_orders, fanout=True),
        "u2_subscription_rate": _report(subscription.subscription_rate),
        "u3_first_subscription_rate": _report(subscription.first_subscription_rate),
        "g1_recharge": _report(recharge.recharge),
        "g2_recharge_rolled_up": _report(_rolled_up),
        "g3_recharge_evaluation": _after(_rolled_up, recharge.recharge_evaluation),
        "g3_recharge_uplift": _after(_rolled_up, recharge.recharge_evaluation, evaluate=False),
        "v1_ads": _report(ads.ads),
        "v1_ads_in_phase": _report(ads.ads, date_filter=True),
        "v2_ads_evaluation": _after(ads.ads, ads.ads_evaluation),
        "v2_ads_uplift": _after(ads.ads, ads.ads_evaluation, evaluate=False),
        "e1_continues": _report(engagement.continues),
        "e2_conversation_resets": _report(engagement.conversation_resets),
        "e3_edits": _report(engagement.edits),
        "e4_follows": _report(engagement.follows),
        "e5_new_conversations": _report(engagement.new_conversations),
        "e6_regenerations": _report(engagement.regenerations),
        "e7_edits_of_phase": _report(engagement.edits_of_phase),
        "c1_click_rate": _report(chat.click_rate),
        "c2_start_rate": _report(chat.start_rate),
        "c3_chat_depth": _report(chat.chat_depth),
        "c4_bots_viewed_per_user": _report(chat.bots_viewed_per_user),
        "c5_bots_chatted_per_user": _report(chat.bots_chatted_per_user),
        "c6_time_spent": _report(chat.time_spent),
        "c7_explore_click_rate": _report(chat.explore_click_rate),
        "c8_explore_start_rate": _report(chat.explore_start_rate),
        "c9_explore_chat_depth": _report(chat.explore_chat_depth),
        "c10_recall_impressions": _report(chat.recall_impressions),
        "t1_proportion_interval": _proportion,
        "t2_beta_comparison": _beta,
        "t2_beta_interval": _beta_interval,
        "t3_assumed_normal_win": _normal,
        "t4_t5_uplifts": _pooled,
        "t6_numeric_sample": _numeric,
        "t7_regression": _sample(means.linear_regression, p_values=False),
        "t7_regression_p_values": _sample(means.linear_regression),
        "t8_mean_tests": _sample(means.mean_tests, p_values=False),
        "t8_mean_tests_p_values": _sample(means.mean_tests),
        "t9_posterior_difference": _sample(means.posterior_difference, probability=False),
        "t9_posterior_difference_probability": _sample(means.posterior_difference),
        "t10_bootstrap": _sample(resampling.bootstrap_mean_difference),
        "t11_rank_test": _sample(ranks.rank_test, p_value=False),
        "t11_rank_test_p_value": _sample(ranks.rank_test),
        "t11_rank_test_tied": _tied_ranks,
        "t12_group_moments": _sample(means.group_moments),
        "t4_t5_uplifts_hard": partial(_pooled, hard=True),
        "r8_new_user_overall_hard": _after(new, retention.overall_report, hard=True),
        "g3_recharge_uplift_hard": _after(_rolled_up, recharge.recharge_evaluation, hard=True, evaluate=False),
        "v2_ads_uplift_hard": _after(ads.ads, ads.ads_evaluation, hard=True, evaluate=False),
        "c1_click_rate_hard": _report(chat.click_rate, hard=True),
        "c2_start_rate_hard": _report(chat.start_rate, hard=True),
        "c3_chat_depth_hard": _report(chat.chat_depth, hard=True),
        "e6_regenerations_hard": _report(engagement.regenerations, hard=True),
        "b8_new_user_payment_rate_hard": _report(business.new_user_payment_rate, hard=True),
        "r3_country_retention_hard": _report(retention.country_retention, hard=True),
        "m8_m10_stored_and_looked_up": _looked_up,
        **{f"m11_together_{name}": _together(name) for name in TOGETHER},
        "m11_run_together": _run_together,
        "s6_s11_days_replaced": _days_replaced,
        "s4_bad_records_set_apart": _bad_records,
        "a2_first_ever_kept": _kept(assignment.resolve, policy="user_first"),
        "a3_latest_day_kept": _kept(assignment.resolve, policy="user_latest_day"),
        "a7_first_day_kept": _kept(assignment.resolve, policy="user_first_day"),
        "r1_new_user_retention_kept": _kept(new),
        "r2_active_user_retention_kept": _kept(active),
        "r3_country_retention_kept": _kept(retention.country_retention),
        "r4_merged_parts_kept": _kept_parts,
        "m1_documents_by_tag": _catalog(lambda docs: catalog.by_tag(docs).select("name", "tag", "started")),
        "m3_latest_by_tag": _catalog(lambda docs: catalog.latest_by_tag(docs).select("tag", "name", "started")),
        "m4_eligible": _catalog(lambda docs: catalog.eligible(catalog.latest_by_tag(docs), AS_OF).select(
            "tag", "name", "started", "ended")),
        "m5_described": _catalog(_table),
        "m6_m7_with_overrides": _overridden,
        "m7_as_published": _catalog(lambda docs: catalog.experiment_table(docs, AS_OF, as_published=True)),
        "m9_tags": _catalog(lambda docs: catalog.tags(_table(docs))),
        "m10_lookup": _catalog(lambda docs: catalog.lookup(_table(docs), "team_3")),
        "s3_exported_documents": _documents,
        "s4_s5_csv_round_trip": _csv,
        "s6_published_twice": _republished,
        "s9_typed_report": _typed,
        "s13_preview": _preview,
        "s14_headings": _headed,
        "s14_edit_headings": lambda spark, folder: with_headings(
            rounded(engagement.edits(fixture_tables(spark, folder), PHASE)), EDIT_HEADINGS),
    }
