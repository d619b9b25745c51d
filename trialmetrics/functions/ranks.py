"""T11. Mann-Whitney U test, over any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from trialmetrics.functions.means import _two_sided_normal, number


def rank_test(sample: DataFrame, value: str = "user_aov", group: str = "variation_id",
              control: int = 0, treatment: int = 1, buckets: int | None = None, p_value: bool = True) -> DataFrame:
    """One row: U of the control, z with continuity and tie correction, two-sided p.

    U counts the pairs in which the control's value is the greater one, a tie as half.
    Rows are first counted per distinct value. The distinct values are cut into buckets of
    about equal size at approximate quantiles; the treatment's rows below a value are those
    in the buckets below and those before it in its bucket. No task ever sorts all the
    values: the only window over everything has one row per bucket. There are four buckets for
    each shuffle partition of the session, so that a larger cluster is busy with smaller ones.
    """
    buckets = buckets or 4 * int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        sample.filter(F.col(group).isin(control, treatment)).select(number(value).alias("v"), group)
        .filter(F.col("v").isNotNull()).groupBy("v")
        .agg(F.count(F.when(F.col(group) == control, 1)).alias("a"), F.count(F.when(F.col(group) != control, 1)).alias("b"))
    )
    cuts = counts.select(F.percentile_approx("v", [i / buckets for i in range(1, buckets)], 10_000)).scalar()
    # The bucket is never NULL. Said so, the join below adds no IS NOT NULL filter, which would
    # be pushed below the counting and look up the bucket of every row.
    bucket = F.coalesce(F.size(F.filter("cuts", lambda cut: cut < F.col("v"))), F.lit(0))
    placed = counts.withColumn("cuts", cuts).select("v", "a", "b", bucket.alias("bucket"))
    every = Window.partitionBy(F.lit(1))
    below = every.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Both sides of the join below use a and b, so that the counted values are shuffled once.
    offsets = placed.groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).select(
        "bucket", F.coalesce(F.sum("b").over(below), F.lit(0)).alias("before"),
        F.sum("a").over(every).cast("double").alias("n_a"), F.sum("b").over(every).cast("double").alias("n_b"))
    inside = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.col("before") + F.coalesce(F.sum("b").over(inside), F.lit(0)) + F.col("b") / 2
    ties = (F.col("a") + F.col("b")).cast("double")
    sums = placed.join(offsets, "bucket").withColumn("beaten", beaten).agg(
        F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"),
        F.sum(F.col("a") * F.col("beaten")).alias("u"), F.sum(ties * ties * ties - ties).alias("tie_term"))
    n_a, n_b, u = F.col("n_a"), F.col("n_b"), F.col("u")
    n = n_a + n_b
    spread = F.sqrt(n_a * n_b / 12 * (n + 1 - F.try_divide(F.col("tie_term"), n * (n - 1))))
    z = F.try_divide(F.greatest(u, n_a * n_b - u) - n_a * n_b / 2 - 0.5, spread)
    stats = sums.select(n_a.cast("bigint").alias("n_a"), n_b.cast("bigint").alias("n_b"),
                        u.alias("u_stat"), z.alias("z_stat"))
    if not p_value:
        return stats
    # Below the mean only by the continuity correction: the p-value is 1, not above it.
    return stats.withColumn("u_p", F.when(F.col("z_stat") <= 0, 1.0).otherwise(_two_sided_normal("z_stat")))
