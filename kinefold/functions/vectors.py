"""Arithmetic of action and state vectors (arrays of doubles)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .draws import normal


@dataclass(frozen=True)
class MirrorSpec:
    """Signs by dimension, and the number of dimensions of an arm; None swaps nothing."""

    action_signs: tuple[float, ...]
    state_signs: tuple[float, ...]
    arm: int | None = None


# Signs of one arm's seven joints in the mirror image.
_ARM_SIGNS = (1.0, -1.0, 1.0, -1.0, 1.0, 1.0, 1.0)
TWO_ARMS = MirrorSpec(_ARM_SIGNS * 2, _ARM_SIGNS * 2, 7)


def mirror_spec(robot: MirrorSpec | None, action_signs: Sequence[float] | None, state_signs: Sequence[float] | None) -> MirrorSpec:
    """Masks given replace the robot's and keep its swap; without a robot both masks are needed and nothing is swapped."""
    if robot is None:
        if not action_signs or not state_signs:
            raise ValueError("a mirror needs a robot, or signs for both action and state")
        return MirrorSpec(tuple(action_signs), tuple(state_signs))
    return MirrorSpec(tuple(action_signs or robot.action_signs), tuple(state_signs or robot.state_signs), robot.arm)


def mirrored(vector: Column, signs: Sequence[float], arm: int | None) -> Column:
    """Change signs, then swap the arms; null stays null."""
    signed = F.zip_with(vector, F.array(*[F.lit(float(s)) for s in signs]), lambda x, s: x * s)
    if arm is None:
        return signed
    return F.concat(F.slice(signed, arm + 1, arm), F.slice(signed, 1, arm), F.slice(signed, 2 * arm + 1, max(1, len(signs))))


def lerp(low: Column, high: Column, alpha: Column) -> Column:
    """low * (1 - alpha) + high * alpha; where alpha vanishes or high is null, low."""
    mixed = F.zip_with(low, high, lambda a, b: a * (1.0 - alpha) + b * alpha)
    return F.when((alpha <= 1e-8) | high.isNull(), low).otherwise(mixed)


def noisy(vector: Column, std: float, *key: Column | str | int) -> Column:
    """Add normal noise to each element, drawn from the key and the element's place."""
    if std <= 0:
        return vector
    return F.transform(vector, lambda x, d: x + F.lit(float(std)) * normal(*key, d))


def distance_sum(a: Column, b: Column) -> Column:
    """Sum over dimensions of absolute differences."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda t, x: t + x)
