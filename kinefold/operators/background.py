"""Backgrounds: which earlier frame stands behind which, and compositing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import integer
from .images import resized, stacks
from .masks import KEY, feathered


def picks(frames: DataFrame, history: int = 24, seed: int = 42) -> DataFrame:
    """bg_frame: a uniformly drawn earlier frame of the same episode and camera, ``history`` back at most.

    The first frame has itself.  Indexes alone decide; pixels come by an equi-join.
    """
    i = F.col("frame_index")
    reach = F.least(i, F.lit(history))
    back = integer(reach - 1, str(seed), F.col("episode_index"), F.col("camera"), i, "background")
    return frames.select(*KEY, F.when(i > 0, i - 1 - back).otherwise(i).alias("bg_frame"))


def previous_episodes(plan: DataFrame) -> DataFrame:
    """The episode before in the same pass, in list order; of a plan, which has a row per output episode.

    Blocks of list positions bound what a task sorts; a block's first row asks the block before for its last.
    """
    rows = plan.select("segment", "list_pos", "episode_index").withColumn("block", F.floor(F.col("list_pos") / 65_536))
    inside = Window.partitionBy("segment", "block").orderBy("list_pos")
    ends = rows.groupBy("segment", "block").agg(F.max(F.struct("list_pos", "episode_index")).alias("last"))
    ends = ends.withColumn("carried", F.lag("last.episode_index").over(Window.partitionBy("segment").orderBy("block"))).select("segment", "block", "carried")
    return rows.join(ends, ["segment", "block"]).select("segment", "list_pos", "episode_index", F.coalesce(F.lag("episode_index").over(inside), "carried").alias("prev_episode"))


def seeded_picks(frames: DataFrame, episodes: DataFrame, previous: DataFrame, history: int = 24, pool: int = 50, seed: int = 42) -> DataFrame:
    """Like :func:`picks`, but the pool starts with even frames of the previous episode; the newest stay.

    Adds bg_episode, bg_frame and bg_own, whether it is one of the episode's own frames.  Pool entry k is the previous episode's k-th even frame, then come the
    episode's own frames; so an entry's frame is arithmetic, and a range join is never needed.
    """
    size = episodes.select(F.col("episode_index").alias("prev_episode"), F.greatest(F.lit(1), F.floor(F.col("length") / pool)).alias("prev_step"), F.col("length").alias("prev_length"))
    known = previous.join(size, "prev_episode", "left").select("segment", "episode_index", "prev_episode", "prev_step", F.when(F.col("prev_length").isNull(), 0).otherwise(F.least(F.ceil(F.col("prev_length") / F.col("prev_step")), F.lit(pool))).alias("seeds"))
    rows = frames.join(known, "episode_index")
    i, seeds = F.col("frame_index"), F.col("seeds")
    total = i + seeds
    reach = F.least(total, F.lit(history))
    entry = total - 1 - integer(reach - 1, str(seed), F.col("segment"), F.col("episode_index"), F.col("camera"), i, "seeded")
    own = entry >= seeds
    return rows.select(
        "segment", *KEY,
        F.when(total == 0, F.col("episode_index")).when(own, F.col("episode_index")).otherwise(F.col("prev_episode")).alias("bg_episode"),
        F.when(total == 0, i).when(own, entry - seeds).otherwise(entry * F.col("prev_step")).cast("long").alias("bg_frame"),
        ((total == 0) | own).alias("bg_own"),
    )


def fan_out(frames: DataFrame, pool_size: int, per_frame: int = 2, seed: int = 42) -> DataFrame:
    """Each frame with ``per_frame`` different pool entries (fewer if the pool is smaller): pick, bg_index."""
    many = min(per_frame, pool_size)
    key = (str(seed), F.col("episode_index"), F.col("camera"), F.col("frame_index"))
    first = integer(pool_size - 1, *key, "first")
    columns = [first]
    if many > 1:
        other = integer(pool_size - 2, *key, "second")
        columns.append(F.when(other >= first, other + 1).otherwise(other))
    return frames.select(*KEY, F.posexplode(F.array(*columns)).alias("pick", "bg_index"))


def composite(rows: DataFrame, feather: int = 10, linear: bool = False) -> DataFrame:
    """Blend pixels over bg_pixels by the feathered mask.

    A background of another size is resized bilinearly if ``linear``, as jobs do it, else to the nearest pixel.

    Rows with null pixels, mask or background stay; all columns but those of the background are kept.
    """
    names = [c for c in rows.columns if c not in ("bg_pixels", "bg_h", "bg_w")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            out = pdf["pixels"].astype(object)
            full = pdf[pdf[["pixels", "mask", "bg_pixels"]].notna().all(axis=1)]
            for key, part in stacks(full, ["h", "w", "c", "bg_h", "bg_w"], lambda h, w, c, bh, bw: c * (h * w + int(bh) * int(bw))):
                h, w, c, bh, bw = map(int, key)
                take = lambda col, *s: np.frombuffer(b"".join(part[col]), np.uint8).reshape(len(part), *s)  # noqa: B023, E731
                fg, bg, mask = take("pixels", h, w, c).astype(float), take("bg_pixels", bh, bw, c), take("mask", h, w)
                if linear:
                    bg = resized(bg, h, w)
                elif (bh, bw) != (h, w):
                    bg = bg[:, np.arange(h) * bh // h][:, :, np.arange(w) * bw // w]
                alpha = feathered(mask, feather)[..., None]
                for i, x in zip(part.index, (alpha * fg + (1 - alpha) * bg).astype(np.uint8), strict=True):
                    out[i] = x.tobytes()
            yield pdf[names].assign(pixels=out)

    return rows.mapInPandas(run, rows.select(*names).schema)


def on_backgrounds(images: DataFrame, masks: DataFrame, chosen: DataFrame, feather: int = 10) -> DataFrame:
    """Join each image with its mask and its background frame, in this order, and composite.

    ``chosen`` has bg_frame and optionally bg_episode.
    """
    chosen = chosen if "bg_episode" in chosen.columns else chosen.withColumn("bg_episode", F.col("episode_index"))
    back = images.select(F.col("episode_index").alias("bg_episode"), F.col("frame_index").alias("bg_frame"), "camera", F.col("h").alias("bg_h"), F.col("w").alias("bg_w"), F.col("pixels").alias("bg_pixels"))
    rows = images.join(masks.select(*KEY, "mask"), list(KEY)).join(chosen, list(KEY)).join(back, ["bg_episode", "bg_frame", "camera"])
    return composite(rows, feather).select(*KEY, "h", "w", "c", "pixels")
