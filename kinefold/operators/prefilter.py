"""The episode gate: scores, verdicts and reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import rounded
from .metrics import measured
from .selection import sampled


@dataclass(frozen=True)
class Gate:
    """Limits of the gate; ``sparc_keep`` says on which side of its limit smooth motion is kept."""

    mode: str = "full"
    sample_every_n: int = 1
    sparc_threshold: float = -10.0
    saturation_limit: float = 7.0
    saturation_threshold: float = 0.15
    min_action_delta: float = 0.02
    max_action_jerk: float | None = None
    fps: float = 50.0
    dims: int | None = None
    sparc_keep: str = "below"

    def __post_init__(self) -> None:
        if self.mode not in ("fast", "full") or self.sparc_keep not in ("below", "above"):
            raise ValueError("mode is fast or full, sparc_keep is below or above")


def _text(form: str, name: str, digits: int) -> Column:
    return F.format_string(form, rounded(F.col(name), digits))


def _tests(gate: Gate) -> list[tuple[Column, Column]]:
    """(failing, reason) in the order of testing; of several the last one counts."""
    out = []
    if gate.mode == "full":
        limit = F.lit(gate.sparc_threshold)
        bad = F.col("sparc") > limit if gate.sparc_keep == "below" else F.col("sparc") < limit
        out.append((bad, _text("jerky_motion (sparc=%.2f)", "sparc", 2)))
        out.append((F.col("saturation") > gate.saturation_threshold, _text("saturation (frac=%.2f)", "saturation", 2)))
    out.append((F.col("action_delta") < gate.min_action_delta, _text("low_movement (delta=%.4f)", "action_delta", 4)))
    if gate.max_action_jerk is not None:
        out.append((F.col("action_jerk") > gate.max_action_jerk, _text("jerky_action (jerk=%.4f)", "action_jerk", 4)))
    return out


def scores(episodes: DataFrame, frames: DataFrame, gate: Gate) -> DataFrame:
    """One row per episode of ``episodes``: metrics rounded to six decimals, kept, reason, all reasons, mode.

    Episodes without frames appear with their reason.  A vector of another length than the episode's (or
    ``gate.dims``) rejects its episode and leaves the others alone.  Frames are exchanged once, by episode.
    """
    if gate.mode == "fast":
        frames = sampled(frames, gate.sample_every_n)
    full = gate.mode == "full"
    found = measured(frames, gate.saturation_limit if full else None, gate.fps if full else None)
    out = episodes.select("episode_index").join(found, "episode_index", "left").withColumn("dims", F.lit(gate.dims) if gate.dims else F.col("most"))
    if not full:
        out = out.withColumn("sparc", F.lit(None).cast("double")).withColumn("saturation", F.lit(None).cast("double"))
    none = F.coalesce("actions", F.lit(0))
    missing = F.when(none < 2, "insufficient sampled action data") if gate.mode == "fast" else F.when((none == 0) | (F.coalesce("states", F.lit(0)) == 0), "missing action/state")
    ragged = F.when((F.col("least") != F.col("dims")) | (F.col("most") != F.col("dims")), F.format_string("vectors of %d to %d elements", "least", "most"))
    bad = F.coalesce(missing, ragged)
    for c in ("sparc", "saturation", "action_delta", "action_jerk"):
        out = out.withColumn(c, F.when(bad.isNull(), rounded(F.col(c))))
    tests = _tests(gate)
    reason = F.lit(None).cast("string")
    for failing, text in tests:
        reason = F.when(failing, text).otherwise(reason)
    reasons = F.array_compact(F.array(bad, *[F.when(bad.isNull() & f, t) for f, t in tests]))
    reason = F.coalesce(bad, reason)
    return out.select(
        "episode_index", "sparc", "saturation", "action_delta", "action_jerk", reason.isNull().alias("kept"), reason.alias("reason"), reasons.alias("reasons"), F.lit(gate.mode).alias("mode"), F.lit(gate.sample_every_n).alias("sample_every_n")
    )


def kept_episodes(episodes: DataFrame, found: DataFrame) -> DataFrame:
    """Episodes that passed; repeats and list order stay."""
    return episodes.join(found.where("kept").select("episode_index"), "episode_index", "left_semi")


def rejected_episodes(episodes: DataFrame, found: DataFrame) -> DataFrame:
    return episodes.join(found.where("kept").select("episode_index"), "episode_index", "left_anti")


def summary(found: DataFrame) -> DataFrame:
    """Episodes by verdict and kind of reason."""
    kind = F.coalesce(F.regexp_extract("reason", r"^([^(]*?) *(\(|$)", 1), F.lit("kept"))
    return found.groupBy("kept", kind.alias("reason_kind")).agg(F.count("*").alias("episodes"))
