"""Selecting episodes and frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_episodes(episodes: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Episodes in the order of a list, repeated ids repeatedly; adds list_pos.

    The list is what a user wrote, so it is small and goes to all tasks.
    """
    spark = episodes.sparkSession
    wanted = spark.createDataFrame([(int(k), i) for i, k in enumerate(ids)], "episode_index long, list_pos long")
    return episodes.join(F.broadcast(wanted), "episode_index")


def episode_slice(frames: DataFrame, ranges: DataFrame) -> DataFrame:
    """Frames whose running index lies in an episode's half-open range.

    Frames that know their episode join on it; others meet ranges by buckets of the index, so that no
    theta join is needed.
    """
    if "episode_index" in frames.columns:
        return frames.join(ranges, "episode_index", "left_semi")
    width = 4096
    cut = ranges.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("dataset_from_index") / width), F.floor((F.col("dataset_to_index") - 1) / width))))
    framed = frames.withColumn("bucket", F.floor(F.col("index") / width))
    return framed.join(cut, "bucket").where("index >= dataset_from_index and index < dataset_to_index").drop("bucket")


def strided(index: Column, n: int, offset: int = 0) -> Column:
    """Keep every n-th frame from an offset on."""
    if n < 1 or not 0 <= offset < n:
        raise ValueError("a stride is at least 1 and its offset below it")
    return F.pmod(index - offset, F.lit(n)) == 0


def decimated(index: Column, n: int) -> Column:
    """Leave out every n-th frame."""
    if n < 2:
        raise ValueError("frames are left out from every second on at most")
    return (index + 1) % n != 0


def evenly(frames: DataFrame, episodes: DataFrame, n: int = 50) -> DataFrame:
    """The first n frames at even steps of each episode; adds pool_index."""
    step = F.greatest(F.lit(1), F.floor(F.col("length") / n))
    both = frames.join(episodes.select("episode_index", step.alias("step")), "episode_index")
    place = F.floor(F.col("frame_index") / F.col("step"))
    return both.where((F.col("frame_index") % F.col("step") == 0) & (place < n)).withColumn("pool_index", place).drop("step")


def sampled(frames: DataFrame, n: int) -> DataFrame:
    """Every n-th frame of each episode, from its first; n below 1 keeps all."""
    return frames.where(F.col("frame_index") % max(1, n) == 0)
