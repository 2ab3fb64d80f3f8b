"""The image augmentations by name.

An augmentation takes images keyed by output episode and frame, and a :class:`Context`, and returns them with
other pixels.  As all draws have output keys, a repeated episode and a source frame used twice draw anew.
:func:`augmentation` adds others, which recipes may then list.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import background, images as im, masks as mk

if TYPE_CHECKING:
    from .recipes import Recipe

#: Frames of the previous episode that the backgrounds of the next start with.
POOL = 50


@dataclass(frozen=True)
class Context:
    """What an augmentation may look at.

    ``shown`` has the scalars of the images (segment, episode_index, frame_index, src_episode, src_frame, camera,
    h, w), ``images`` the source images, ``plan`` the output episodes.  ``mask_fn`` is a predictor of masks or a chain of
    them; ``masks``, if given, are masks of source images that take its place.  What an augmentation has to report
    beside pixels goes to ``reports``.
    """

    recipe: Recipe
    plan: DataFrame
    shown: DataFrame
    images: DataFrame
    boxes: DataFrame | None = None
    mask_fn: mk.MaskFn | Sequence[mk.MaskFn] = mk.brightness_mask
    masks: DataFrame | None = None
    plain: mk.MaskFn = mk.brightness_mask
    reports: dict[str, DataFrame] = field(default_factory=dict)


Augmentation = Callable[[DataFrame, Context], DataFrame]
REGISTRY: dict[str, Augmentation] = {}
RECTANGLE = ("rect_h", "rect_w", "rect_top", "rect_left")


def augmentation(name: str) -> Callable[[Augmentation], Augmentation]:
    def add(made: Augmentation) -> Augmentation:
        REGISTRY[name] = made
        return made

    return add


@augmentation("color_jitter")
def color_jitter(images: DataFrame, context: Context) -> DataFrame:
    r = context.recipe
    return im.color_jitter(images, r.brightness, r.contrast, r.saturation, r.hue, r.seed)


@augmentation("gaussian_blur")
def gaussian_blur(images: DataFrame, context: Context) -> DataFrame:
    return im.gaussian_blur(images, context.recipe.blur_size, context.recipe.blur_sigma, context.recipe.seed)


@augmentation("sharpness")
def sharpness(images: DataFrame, context: Context) -> DataFrame:
    return im.sharpen(images, context.recipe.sharpness_factor)


@augmentation("random_erasing")
def random_erasing(images: DataFrame, context: Context) -> DataFrame:
    r = context.recipe
    return im.erase(im.random_rectangles(images, r.erasing_p, r.erasing_scale, r.seed)).drop(*RECTANGLE)


@augmentation("static_erasing")
def static_erasing(images: DataFrame, context: Context) -> DataFrame:
    return im.erase(im.episode_rectangles(images, context.recipe.erasing_scale, context.recipe.seed)).drop(*RECTANGLE)


@augmentation("drifting_blob")
def drifting_blob(images: DataFrame, context: Context) -> DataFrame:
    r = context.recipe
    sizes = context.shown.groupBy("segment", "episode_index", "camera").agg(F.max("h").alias("h"), F.max("w").alias("w"), (F.max("frame_index") + 1).alias("usable_len"))
    path = im.blob_paths(sizes, None, None, r.blob_radius, r.blob_speed, r.seed)
    return im.paint_blob(images.join(path, ["segment", "episode_index", "camera", "frame_index"]), r.blob_radius, r.blob_softness, r.blob_opacity).drop("cy", "cx")


@augmentation("background")
def composed(images: DataFrame, context: Context) -> DataFrame:
    """Boxes drawn, or the foreground before an earlier image of the output episode; adds ``mask``.

    The pool of backgrounds holds the images as they come in here, and at first source frames of the pass's previous
    episode.  Masks and images are written once, as both foregrounds and backgrounds read them; so their statistics by
    output episode, reported as ``masks``, need no second pass over pixels.
    """
    r = context.recipe
    if r.box_overlay:
        if context.boxes is None:
            raise ValueError("box_overlay needs boxes")
        return im.boxed(images, _shown_boxes(context)).withColumn("mask", F.lit(None).cast("binary"))
    walked = mk.reused(images, context.mask_fn, r.mask_stride, context.plain, None if context.masks is None else _shown_masks(context))
    context.reports["masks"] = mk.statistics(walked)
    found = walked.drop("coverage", "kind", "mask_src", "reason")
    order = context.plan.select("segment", "list_pos", "output_order")
    before = background.previous_episodes(context.plan).join(order, ["segment", "list_pos"]).select("segment", F.col("output_order").alias("episode_index"), "prev_episode")
    lengths = context.plan.select("episode_index", "length").distinct()
    chosen = background.seeded_picks(found.select(*mk.KEY), lengths, before, r.background_history, POOL, r.seed).drop("segment")
    columns = (F.col("episode_index").alias("bg_episode"), F.col("frame_index").alias("bg_frame"), "camera", F.col("h").alias("bg_h"), F.col("w").alias("bg_w"), F.col("pixels").alias("bg_pixels"))
    behind = found.select(F.lit(True).alias("bg_own"), *columns).unionByName(context.images.select(F.lit(False).alias("bg_own"), *columns))
    rows = found.join(chosen, list(mk.KEY)).join(behind, ["bg_own", "bg_episode", "bg_frame", "camera"], "left")
    return background.composite(rows.drop("bg_own", "bg_episode", "bg_frame"), r.feather, linear=True)


def _shown_masks(context: Context) -> DataFrame:
    """The masks of source images for each image shown; mirrored with it."""
    source = context.masks.select(F.col("episode_index").alias("src_episode"), F.col("frame_index").alias("src_frame"), "camera", F.col("mask").alias("pixels"))
    rows = context.shown.select(*mk.KEY, "src_episode", "src_frame", "h", "w").join(source, ["src_episode", "src_frame", "camera"])
    if "horizontal_flip" in context.recipe.augmentations:
        fits = F.octet_length("pixels") == F.col("h") * F.col("w")
        rows = im.flip(rows.withColumn("c", F.lit(1)).where(fits))
    return rows.select(*mk.KEY, F.col("pixels").alias("mask"))


def _shown_boxes(context: Context) -> DataFrame:
    """The boxes of source images for each image shown; mirrored with it."""
    source = context.boxes.select(F.col("episode_index").alias("src_episode"), F.col("frame_index").alias("src_frame"), "camera", "x0", "y0", "x1", "y1")
    rows = context.shown.select(*mk.KEY, "src_episode", "src_frame", "w").join(source, ["src_episode", "src_frame", "camera"])
    if "horizontal_flip" in context.recipe.augmentations:
        last = F.col("w") - 1
        rows = rows.withColumns({"x0": last - F.col("x1"), "x1": last - F.col("x0")})
    return rows.select(*mk.KEY, "x0", "y0", "x1", "y1")
