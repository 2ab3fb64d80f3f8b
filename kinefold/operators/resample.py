"""Output frames of a plan: nearest frames, as-of interpolation, labels."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .groups import whole_groups
from .planning import positions, source_frame


def _clamped(place: Column) -> Column:
    return F.greatest(F.lit(0), F.least(place, F.col("n_selected") - 1)).cast("long")


def nearest(pos: Column) -> Column:
    """The selected frame next to a position, halves to even."""
    return _clamped(F.bround(pos))


def future_actions(frames: DataFrame, shift: int) -> DataFrame:
    """Without resampling: each frame with the action ``shift`` frames later; the last ``shift`` vanish."""
    moved = frames.select("episode_index", (F.col("frame_index") - shift).alias("frame_index"), F.col("action").alias("label"))
    return frames.join(moved, ["episode_index", "frame_index"])


#: Source frames of an episode that are looked up together.
BLOCK = 1024


def _taken(column: pa.ChunkedArray, at: np.ndarray) -> pa.Array:
    """Elements at places, null at -1."""
    return column.combine_chunks().take(pa.array(np.maximum(at, 0), mask=at < 0))


def _interpolated(low: pa.Array, high: pa.Array, alpha: np.ndarray) -> pa.Array:
    """low * (1 - alpha) + high * alpha by row; where alpha vanishes or high is null, low."""
    mixed = np.flatnonzero((alpha > 1e-8) & low.is_valid().to_numpy(False) & high.is_valid().to_numpy(False))
    if not len(mixed):
        return low
    a, b = low.take(pa.array(mixed)), high.take(pa.array(mixed))
    sizes = np.maximum(pc.list_value_length(a).to_numpy(), pc.list_value_length(b).to_numpy())
    if a.flatten().null_count == b.flatten().null_count == 0 and (sizes == len(a.flatten()) / len(a)).all() and (sizes == len(b.flatten()) / len(b)).all():
        x, y, t = a.flatten().to_numpy(), b.flatten().to_numpy(), np.repeat(alpha[mixed], sizes)
        made = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(x * (1.0 - t) + y * t))
    else:  # vectors of several lengths: a missing or null element makes a null
        rows = []
        for x, y, t in zip(a.to_pylist(), b.to_pylist(), alpha[mixed].tolist(), strict=True):
            rows.append([None if v is None or w is None else v * (1.0 - t) + w * t for v, w in zip_longest(x, y)])
        made = pa.array(rows, low.type)
    place = np.arange(len(low))
    place[mixed] = len(low) + np.arange(len(mixed))
    return pa.concat_arrays([low, made.cast(low.type)]).take(pa.array(place))


def _merged(jitter: bool, task: bool):
    """A function over blocks of output positions (kind 1) and the frames that they can need (kind 0)."""

    def merge(group: np.ndarray, both: pa.Table) -> pa.Table:
        kind = both.column("kind").to_numpy()
        mine, theirs = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
        rows, frames = both.take(pa.array(mine)), both.take(pa.array(theirs))
        at = frames.column("at").to_numpy(zero_copy_only=False).astype(np.int64)
        span = int(max(at.max(initial=0), rows.column("label_high").to_numpy(zero_copy_only=False).max(initial=0), rows.column("state_high").to_numpy(zero_copy_only=False).max(initial=0))) + 1
        held = group[theirs] * span + at
        order = np.argsort(held, kind="stable")
        frames, held = frames.take(pa.array(order)), held[order]

        def number(name: str, kind: type = np.int64) -> np.ndarray:
            return rows.column(name).to_numpy(zero_copy_only=False).astype(kind)

        def places(name: str) -> np.ndarray:
            wanted = group[mine] * span + number(name)
            found = np.minimum(np.searchsorted(held, wanted), max(0, len(held) - 1))
            return np.where(held[found] == wanted, found, -1) if len(held) else np.full(len(wanted), -1)

        near = places("near")
        action, state = _taken(frames.column("action"), near), _taken(frames.column("state"), near)
        label = _taken(frames.column("action"), places("label_low"))
        if jitter:
            label = _interpolated(label, _taken(frames.column("action"), places("label_high")), number("label_part", float))
            own = _interpolated(_taken(frames.column("state"), places("state_low")), _taken(frames.column("state"), places("state_high")), number("state_part", float))
            state = pc.if_else(pc.and_(rows.column("jittered").combine_chunks(), own.is_valid()), own, state)
        action = pc.if_else(pc.greater(rows.column("effective_shift").combine_chunks(), 0), label, action)
        out = {c: rows.column(c) for c in _CARRIED} | {"src_frame": rows.column("near")}
        if task:
            out["task"] = _taken(frames.column("task"), near)
        return pa.table(out | {"action": action, "state": state})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, both in whole_groups(batches, ("episode_index", "block")):
            yield from merge(group, both).to_batches()

    return run


_CARRIED = ("segment", "list_pos", "episode_index", "output_order", "base_index", "usable_len", "out_idx")


def resample(frames: DataFrame, plan: DataFrame, jitter: bool, block: int = BLOCK) -> DataFrame:
    """Output frames of a plan: segment, list_pos, episode_index, out_idx, src_frame, task, action, state.

    The state is interpolated where time was resampled, else the nearest frame's.  The action is the label:
    interpolated at the shifted position if there is a shift, else the nearest frame's.  All else is nearest.

    Output positions go to the block of their nearest frame, on scalars, and frames to their own block and those before and after
    whose positions can reach them; a block is merged in one pass.  So frames and positions are exchanged once each, and an
    episode of any length is many groups.  Of frames that repeat an index one counts.
    """
    rows = positions(plan)
    place = lambda p: source_frame(_clamped(p), F.col("stride"), F.col("start_offset"), F.col("remove"))
    found = {"near": F.bround("pos"), "label_low": F.floor("label_pos"), "label_high": F.ceil("label_pos"), "state_low": F.floor("pos"), "state_high": F.ceil("pos")}
    parts = {"label_part": F.col("label_pos") - F.floor("label_pos"), "state_part": F.col("pos") - F.floor("pos")}
    rows = rows.select(*_CARRIED, "effective_shift", "jittered", *(place(p).alias(n) for n, p in found.items()), *(p.alias(n) for n, p in parts.items()))
    rows = rows.withColumn("block", F.floor(F.col("near") / block))
    # how far the farthest position of the plan reaches, in source frames: one row
    gap = F.greatest(F.col("stride"), F.lit(2))
    step = F.when(F.col("jittered") & (F.col("target_len") > 1), (F.col("n_selected") - 1) / (F.col("target_len") - 1)).otherwise(1.0)
    reach = plan.agg(F.max((F.ceil(F.col("effective_shift") * step) + 3) * gap).alias("ahead"), F.max(3 * gap).alias("back")).where("ahead is not null")
    at = F.col("frame_index").cast("long")
    blocks = F.sequence(F.greatest(F.floor((at - F.col("ahead")) / block), F.lit(0)), F.floor((at + F.col("back")) / block))
    task = ["task"] if "task" in frames.columns else []
    # the episode is named anew, as plans may come from the same frames
    dealt = frames.crossJoin(F.broadcast(reach)).where("frame_index >= 0").select(F.col("episode_index").alias("episode_index"), at.alias("at"), F.explode(blocks).alias("block"), *task, F.col("action").cast("array<double>").alias("action"), F.col("state").cast("array<double>").alias("state"))
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in _CARRIED), "src_frame long", *(f"{c} {dict(frames.dtypes)[c]}" for c in task), "action array<double>", "state array<double>"])
    both = rows.withColumn("kind", F.lit(1)).unionByName(dealt.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return both.repartition("episode_index", "block").sortWithinPartitions("episode_index", "block").mapInArrow(_merged(jitter, bool(task)), schema)


def renumbered(rows: DataFrame, fps: float = 50.0) -> DataFrame:
    """Regenerate the index columns: episodes without gaps, frames from 0, running index, time."""
    old = ["segment", "list_pos", "output_order", "base_index", "usable_len", "out_idx"]
    out = rows.withColumn("source_episode", F.col("episode_index")).withColumn("episode_index", F.col("output_order")).withColumn("frame_index", F.col("out_idx"))
    return out.withColumn("index", F.col("base_index") + F.col("out_idx")).withColumn("timestamp", F.col("out_idx") / fps).drop(*[c for c in old if c != "segment"])
