"""The output plan: one row per output episode, decided before any frame is read.

All lengths have closed forms, so frames need no windows for selection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import between, integer

ORIGINALS = -1
#: Positions numbered as one block; totals of blocks are summed first.
BLOCK = 65_536


@dataclass(frozen=True)
class Temporal:
    """How frames of an output episode are chosen."""

    num_passes: int = 2
    include_originals: bool = False
    include_originals_decimated: bool = False
    keep_every_n: int | None = 1
    stride_cycle: tuple[int, ...] | None = None
    remove_every_n: int | None = None
    action_shift: int = 0
    tail_drop_max: int = 0
    jitter: float = 0.0
    seed: int = 42

    def __post_init__(self) -> None:
        if not 0.0 <= self.jitter <= 1.0:
            raise ValueError("jitter lies between 0 and 1")
        if any(n < 1 for n in self.stride_cycle or ()):
            raise ValueError("strides are at least 1")
        if self.remove_every_n is not None and self.remove_every_n < 2:
            raise ValueError("frames are left out from every second on at most")


def segments(t: Temporal) -> list[tuple[int, int, int, int]]:
    """(segment, stride, offset, remove) of the originals and each pass; 0 removes nothing."""
    out = []
    if t.include_originals:
        own = max(1, t.keep_every_n or 1) if t.include_originals_decimated else 1
        if t.include_originals_decimated and t.stride_cycle:
            own = t.stride_cycle[0]
        out.append((ORIGINALS, own, 0, 0))
    for k in range(t.num_passes):
        stride = t.stride_cycle[k % len(t.stride_cycle)] if t.stride_cycle else (t.keep_every_n or 1)
        stride = max(1, stride)
        out.append((k, stride, k % stride, 0 if stride > 1 else t.remove_every_n or 0))
    return out


def selected_length(length: Column, stride: Column, offset: Column, remove: Column) -> Column:
    """How many of ``length`` frames a stride or a decimation leaves."""
    by_stride = F.greatest(F.lit(0), F.floor((length - offset + stride - 1) / stride))
    by_remove = length - F.floor(length / F.greatest(remove, F.lit(2)))
    return F.when(stride > 1, by_stride).when(remove > 0, by_remove).otherwise(length).cast("long")


def source_frame(place: Column, stride: Column, offset: Column, remove: Column) -> Column:
    """The source frame at a place of the selected sequence."""
    by_remove = place + F.floor(place / F.greatest(remove - 1, F.lit(1)))
    return F.when(stride > 1, place * stride + offset).when(remove > 0, by_remove).otherwise(place).cast("long")


def effective_shift(shift: int, stride: Column) -> Column:
    """The label shift in selected frames, halves to even."""
    return F.bround(F.lit(float(max(0, shift))) / stride).cast("long")


def build_plan(episodes: DataFrame, t: Temporal) -> DataFrame:
    """Plan all output episodes of ``episodes`` (episode_index, length, optional list_pos).

    The order is segment, then list position (else episode_index).  Output episodes without frames are left
    out.  Adds output_order, without gaps, and base_index, the running number of each first frame.
    """
    spark = episodes.sparkSession
    if "list_pos" not in episodes.columns:
        episodes = episodes.withColumn("list_pos", F.col("episode_index"))
    passes = spark.createDataFrame(segments(t), "segment int, stride int, start_offset int, remove int")
    plan = episodes.select("episode_index", "length", "list_pos").crossJoin(F.broadcast(passes))  # as many rows as passes
    key = (str(t.seed), F.col("segment"), F.col("episode_index"), F.col("list_pos"))
    drop = integer(t.tail_drop_max, *key, "tail") if t.tail_drop_max > 0 else F.lit(0)
    plan = plan.withColumn("tail_drop", drop.cast("long"))
    length = F.greatest(F.lit(0), F.col("length") - F.col("tail_drop"))
    plan = plan.withColumn("n_selected", selected_length(length, F.col("stride"), F.col("start_offset"), F.col("remove")))
    jittered = (F.col("segment") != ORIGINALS) & (F.col("n_selected") > 1) if t.jitter > 0 else F.lit(False)
    scale = F.when(jittered, between(1.0 - t.jitter, 1.0 + t.jitter, *key, "speed") if t.jitter > 0 else F.lit(1.0)).otherwise(1.0)
    plan = plan.withColumn("speed_scale", scale)
    target = F.when(jittered, F.greatest(F.lit(2), F.bround(F.col("n_selected") * F.col("speed_scale")))).otherwise(F.col("n_selected")).cast("long")
    plan = plan.withColumn("target_len", target).withColumn("jittered", jittered).withColumn("effective_shift", effective_shift(t.action_shift, F.col("stride")))
    plan = plan.withColumn("usable_len", F.col("target_len") - F.col("effective_shift"))
    return numbered(plan.where((F.col("n_selected") > 0) & (F.col("usable_len") > 0)))


def numbered(plan: DataFrame) -> DataFrame:
    """Number output episodes and their frames in order, block by block.

    Blocks of positions are summed first, so only one row per block passes through a single task.
    """
    plan = plan.withColumn("block", F.floor(F.col("list_pos") / BLOCK))
    totals = plan.groupBy("segment", "block").agg(F.count("*").alias("n"), F.sum("usable_len").alias("frames"))
    before = Window.orderBy("segment", "block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("segment", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("frames").over(before), F.lit(0)).alias("f0"))
    inside = Window.partitionBy("segment", "block").orderBy("list_pos", "episode_index")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = plan.join(totals, ["segment", "block"])
    return out.withColumn("output_order", F.col("n0") + F.row_number().over(inside) - 1).withColumn("base_index", F.col("f0") + F.coalesce(F.sum("usable_len").over(earlier), F.lit(0))).drop("n0", "f0", "block")


def plan_totals(episodes: DataFrame, plan: DataFrame, t: Temporal) -> DataFrame:
    """Output episodes by segment: planned, written and frames."""
    spark = episodes.sparkSession
    passes = spark.createDataFrame([(s[0],) for s in segments(t)], "segment int")
    planned = episodes.agg(F.count("*").alias("planned")).crossJoin(passes)
    written = plan.groupBy("segment").agg(F.count("*").alias("written"), F.sum("usable_len").alias("frames"))
    return planned.join(written, "segment", "left").select("segment", "planned", F.coalesce("written", F.lit(0)).alias("written"), F.coalesce("frames", F.lit(0)).alias("frames"))


def positions(plan: DataFrame) -> DataFrame:
    """One row per output frame: out_idx, its position and, for the label, the shifted one, in selected frames."""
    spread = plan.withColumn("out_idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("usable_len") - 1)))

    def at(k: Column) -> Column:
        return F.when(F.col("jittered"), k * (F.col("n_selected") - 1) / (F.col("target_len") - 1)).otherwise(k.cast("double"))

    return spread.withColumn("pos", at(F.col("out_idx"))).withColumn("label_pos", at(F.col("out_idx") + F.col("effective_shift")))
