"""Dataset statistics and before/after comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_dimension(frames: DataFrame, vectors: tuple[str, ...] = ("action", "state")) -> DataFrame:
    """Mean, deviation, least and largest value, and share of non-zero values, by feature and dimension."""
    long = None
    for name in vectors:
        part = frames.select(F.lit(name).alias("feature"), F.posexplode(name).alias("dim", "value"))
        long = part if long is None else long.unionByName(part)
    value = F.col("value")
    return long.groupBy("feature", "dim").agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg((value != 0).cast("double")).alias("non_zero"), F.count(value).alias("n")
    )


def dataset_summary(frames: DataFrame, fps: float = 50.0) -> DataFrame:
    """Episodes, frames, fps; counts of episodes are summed before frames meet."""
    each = frames.groupBy("episode_index").agg(F.count("*").alias("n"))
    return each.agg(F.count("*").alias("episodes"), F.sum("n").alias("frames")).withColumn("fps", F.lit(float(fps)))


def quality(frames: DataFrame, motion: DataFrame) -> DataFrame:
    """Episodes, deviation of lengths, mean jerk over episodes, mean of dimensions' deviations of actions."""
    lengths = motion.agg(F.count("*").alias("episodes"), F.stddev_pop("frames").alias("length_std"), F.avg("action_jerk").alias("jerk"))
    diversity = by_dimension(frames, ("action",)).agg(F.avg("std").alias("diversity"))
    return lengths.crossJoin(diversity)  # one row each


def action_sums(before: DataFrame, after: DataFrame) -> DataFrame:
    """Mean absolute action sum per frame in both datasets, and their ratio."""
    total = lambda df, n: df.agg(F.avg(F.aggregate("action", F.lit(0.0), lambda t, x: t + F.abs(x))).alias(n))
    return total(before, "before").crossJoin(total(after, "after")).withColumn("ratio", F.col("after") / F.col("before"))  # one row each


def joint_coverage(before: DataFrame, after: DataFrame) -> DataFrame:
    """Range of each action dimension after, relative to before."""
    span = lambda df, n: by_dimension(df, ("action",)).select("dim", (F.col("max") - F.col("min")).alias(n))
    return span(before, "before").join(span(after, "after"), "dim").withColumn("ratio", F.when(F.col("before") > 0, F.col("after") / F.col("before")))


def smoothness_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Relative change of the mean sparc between two score tables."""
    mean = lambda df, n: df.agg(F.avg("sparc").alias(n))
    return mean(before, "before").crossJoin(mean(after, "after")).withColumn("change", (F.col("after") - F.col("before")) / F.abs("before"))  # one row each
