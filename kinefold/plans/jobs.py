"""End-to-end jobs.  Each takes and returns DataFrames; an action is run only to compose backgrounds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import mirrored, noisy
from ..operators import images as im, masks as mk
from ..operators.metrics import autocorrelation, chunk_length, motion
from ..operators.planning import ORIGINALS, build_plan
from ..operators.prefilter import kept_episodes, scores
from ..operators.resample import renumbered, resample
from ..operators.smoothing import smooth
from ..operators.statistics import by_dimension, dataset_summary, quality
from ..sources.datasets import episodes as of_frames
from .augmentations import REGISTRY, Context
from .recipes import OTHERS, Recipe


@dataclass(frozen=True)
class Augmented:
    plan: DataFrame
    frames: DataFrame


def prefilter_job(frames: DataFrame, recipe: Recipe, episodes: DataFrame | None = None) -> DataFrame:
    """The score report of all episodes."""
    return scores(episodes if episodes is not None else of_frames(frames), frames, recipe.gate())


def plan_job(frames: DataFrame, recipe: Recipe, episodes: DataFrame | None = None) -> DataFrame:
    """Output episodes and lengths; of the frames only keys, and vectors if the gate is on, are read."""
    chosen = episodes if episodes is not None else of_frames(frames)
    if recipe.prefilter:
        chosen = kept_episodes(chosen, prefilter_job(frames, recipe, chosen))
    return build_plan(chosen, recipe.temporal())


def augment_job(frames: DataFrame, recipe: Recipe, episodes: DataFrame | None = None, dims: int = 14) -> Augmented:
    """Vectors: tail drop, stride, resampling, label, smoothing, noise, mirror, in this order.

    Originals get tail drop, stride and label alone.
    """
    plan = plan_job(frames, recipe, episodes)
    rows = resample(frames, plan, recipe.temporal_jitter > 0)
    original = F.col("segment") == ORIGINALS
    if recipe.smoothing:
        plain = rows.withColumn("_plain", F.col("action"))
        rows = smooth(plain, recipe.smooth_window, recipe.smooth_order, recipe.excluded(), dims).withColumn("action", F.when(original, F.col("_plain")).otherwise(F.col("action"))).drop("_plain")
    if recipe.action_noise_std > 0:
        drawn = noisy(F.col("action"), recipe.action_noise_std, str(recipe.seed), F.col("segment"), F.col("episode_index"), F.col("list_pos"), F.col("out_idx"), "noise")
        rows = rows.withColumn("action", F.when(original, F.col("action")).otherwise(drawn))
    if spec := recipe.mirror():
        for name, signs in (("action", spec.action_signs), ("state", spec.state_signs)):
            rows = rows.withColumn(name, F.when(original, F.col(name)).otherwise(mirrored(F.col(name), signs, spec.arm)))
    return Augmented(plan, renumbered(rows))


@dataclass(frozen=True)
class AugmentedImages:
    """Images of a plan, with masks where backgrounds are composed, and then the masks' statistics by output episode."""

    images: DataFrame
    mask_statistics: DataFrame | None


def images_job(
    images: DataFrame, augmented: Augmented, recipe: Recipe, boxes: DataFrame | None = None, mask_fn: mk.MaskFn | Sequence[mk.MaskFn] = mk.brightness_mask, masks: DataFrame | None = None, plain: mk.MaskFn = mk.brightness_mask
) -> AugmentedImages:
    """The image branch of a plan: flip comes first, then the augmentations as listed; originals stay as they are.

    With ``background``, a column mask has 0 and 1 by pixel, zeros where none was predicted; the job then writes masks
    on the way, so it is not lazy.  Masks come from ``mask_fn``, a predictor or a chain of them, or from ``masks``, a
    table of masks of source images; where there is none, ``plain`` makes one.  :func:`masks.mask_rgb` makes images of masks.
    """
    keys = augmented.frames.select("segment", F.col("source_episode").alias("src_episode"), F.col("src_frame"), "episode_index", "frame_index")
    source = images.select(F.col("episode_index").alias("src_episode"), F.col("frame_index").alias("src_frame"), "camera", "h", "w", "c", "pixels")
    both = ["src_episode", "src_frame"]
    passes = keys.where(F.col("segment") != ORIGINALS)
    context = Context(recipe, augmented.plan, passes.join(source.drop("c", "pixels"), both), images, boxes, mask_fn, masks, plain)
    changed = passes.join(source, both).drop(*both)
    if "horizontal_flip" in recipe.augmentations:
        changed = im.flip(changed)
    for name in recipe.augmentations:
        if name not in OTHERS:
            changed = REGISTRY[name](changed, context)
    kept = keys.where(F.col("segment") == ORIGINALS).join(source, both)
    out = changed.unionByName(kept, allowMissingColumns=True)
    columns = ["segment", "episode_index", "frame_index", "camera", "h", "w", "c", "pixels"]
    if "background" in recipe.augmentations:
        columns.append(F.coalesce("mask", F.unhex(F.expr("repeat('00', h * w)"))).alias("mask"))
    return AugmentedImages(out.select(*columns), context.reports.get("masks"))


def augment_images_job(images: DataFrame, augmented: Augmented, recipe: Recipe, boxes: DataFrame | None = None, mask_fn: mk.MaskFn | Sequence[mk.MaskFn] = mk.brightness_mask) -> DataFrame:
    """The images alone of :func:`images_job`."""
    return images_job(images, augmented, recipe, boxes, mask_fn).images


def profile_job(frames: DataFrame, fps: float = 50.0) -> dict[str, DataFrame]:
    """Inspection of a dataset: summary, statistics by feature, the first episodes."""
    return {"summary": dataset_summary(frames, fps), "statistics": by_dimension(frames), "preview": of_frames(frames).orderBy("episode_index").limit(5)}


def quality_job(before: DataFrame, after: DataFrame, max_lag: int = 50) -> DataFrame:
    """Quality of two datasets side by side, with their suggested chunk lengths."""
    rows = None
    for name, frames in (("before", before), ("after", after)):
        one = quality(frames, motion(frames)).crossJoin(chunk_length(autocorrelation(frames, max_lag)))  # one row each
        one = one.withColumn("dataset", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows
