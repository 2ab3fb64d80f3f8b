"""Image operators on raw pixels (height x width x channels, one byte each).

Parameters are drawn as columns from hashes; numpy helpers work on stacks of images of
one shape, of ``STACK_BYTES`` at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import between, integer, uniform

Fn = Callable[[np.ndarray, pd.DataFrame], np.ndarray]
#: Of pixels as bytes; helpers need some ten times as much for their numbers.
STACK_BYTES = 8 << 20


def stacks(pdf: pd.DataFrame, shape: list[str], size: Callable[..., int]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Rows of one shape, in parts of at most STACK_BYTES (at least a row); ``size`` tells a row's bytes from its shape."""
    for key, rows in pdf.groupby(shape, sort=False):
        step = max(1, STACK_BYTES // max(1, size(*key)))
        for k in range(0, len(rows), step):
            yield key, rows.iloc[k : k + step]


def per_shape(pdf: pd.DataFrame, fn: Fn, column: str = "pixels") -> pd.Series:
    """Apply ``fn`` to stacks (n, h, w, c) of rows of one shape; null pixels stay null."""
    out = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
    full = pdf[pdf[column].notna()]
    for (h, w, c), rows in stacks(full, ["h", "w", "c"], lambda h, w, c: h * w * c):
        stack = np.frombuffer(b"".join(rows[column]), np.uint8).reshape(len(rows), h, w, c)
        for i, x in zip(rows.index, fn(stack, rows), strict=True):
            out[i] = np.ascontiguousarray(x).astype(np.uint8).tobytes()
    return out


def apply(df: DataFrame, fn: Fn, column: str = "pixels") -> DataFrame:
    """Replace a pixel column by ``fn`` of it; all columns may serve as parameters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{column: per_shape(pdf, fn, column)})

    return df.mapInPandas(run, df.schema)


def to_unit(x: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) / 255.0


def from_unit(x: np.ndarray) -> np.ndarray:
    """Clip to [0, 1] and truncate to bytes; one channel becomes three."""
    out = (np.clip(x, 0.0, 1.0) * 255.0).astype(np.uint8)
    return np.repeat(out, 3, -1) if out.shape[-1] == 1 else out


def _between(size: int, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each wanted pixel the two source pixels between whose centres it lies, and the weight of the second."""
    at = np.clip((np.arange(wanted) + 0.5) * size / wanted - 0.5, 0, size - 1)
    low = np.floor(at).astype(int)
    return low, np.minimum(low + 1, size - 1), at - low


def resized(stack: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear resize of a stack (n, h, w, c) of bytes, one axis after the other; pixel centres are aligned."""
    if stack.shape[1:3] == (h, w):
        return stack
    top, bottom, down = _between(stack.shape[1], h)
    left, right, along = _between(stack.shape[2], w)
    x = stack[:, top] * (1 - down)[:, None, None] + stack[:, bottom] * down[:, None, None]
    x = x[:, :, left] * (1 - along)[:, None] + x[:, :, right] * along[:, None]
    return np.floor(x + 0.5).astype(np.uint8)


def flip(df: DataFrame) -> DataFrame:
    """Mirror columns."""
    return apply(df, lambda x, _: x[:, :, ::-1])


def luma(x: np.ndarray) -> np.ndarray:
    return 0.2989 * x[..., 0] + 0.587 * x[..., 1] + 0.114 * x[..., 2]


def to_hsv(x: np.ndarray) -> np.ndarray:
    top, low = x.max(-1), x.min(-1)
    span = top - low
    safe = np.where(span > 0, span, 1.0)
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    hue = np.where(top == r, (g - b) / safe, np.where(top == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) / 6.0
    return np.stack([np.where(span > 0, hue % 1.0, 0.0), np.where(top > 0, span / np.where(top > 0, top, 1.0), 0.0), top], -1)


def from_hsv(x: np.ndarray) -> np.ndarray:
    h, s, v = x[..., 0], x[..., 1], x[..., 2]
    channel = lambda n: v - v * s * np.clip(np.minimum((n + h * 6) % 6, 4 - (n + h * 6) % 6), 0, 1)
    return np.stack([channel(5), channel(3), channel(1)], -1)


def color_jitter(df: DataFrame, brightness=(0.8, 1.2), contrast=(0.8, 1.2), saturation=(0.5, 1.5), hue=(-0.05, 0.05), seed: int = 42) -> DataFrame:
    """Brightness, contrast, saturation and hue, drawn anew for each image."""
    ranges = {"_b": brightness, "_c": contrast, "_s": saturation, "_h": hue}
    drawn = df.withColumns({k: between(*r, str(seed), *image_key(df), k) for k, r in ranges.items()})

    def run(x: np.ndarray, p: pd.DataFrame) -> np.ndarray:
        v = {k: p[k].to_numpy()[:, None, None, None] for k in ranges}
        y = np.clip(to_unit(x) * v["_b"], 0, 1)
        mean = luma(y).mean((1, 2))[:, None, None, None]
        y = np.clip(v["_c"] * y + (1 - v["_c"]) * mean, 0, 1)
        y = np.clip(v["_s"] * y + (1 - v["_s"]) * luma(y)[..., None], 0, 1)
        hsv = to_hsv(y)
        hsv[..., 0] = (hsv[..., 0] + v["_h"][..., 0]) % 1.0
        return from_unit(from_hsv(hsv))

    return apply(drawn, run).drop(*ranges)


def image_key(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in ("segment", "episode_index", "frame_index", "camera") if c in df.columns]


def kernel(size: int, sigma: np.ndarray) -> np.ndarray:
    """Normalised Gaussian weights, a row for each sigma."""
    at = np.arange(size) - size // 2
    w = np.exp(-0.5 * (at / np.asarray(sigma, float)[:, None]) ** 2)
    return w / w.sum(1, keepdims=True)


def convolved(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Separable convolution of stacks (n, h, w, c) with reflected borders; weights (n, k)."""
    r = weights.shape[1] // 2
    for axis in (1, 2):
        mode = "reflect" if x.shape[axis] > r else "edge"
        pad = [(0, 0)] * 4
        pad[axis] = (r, r)
        wide = np.pad(x, pad, mode=mode)
        n = x.shape[axis]
        x = sum(weights[:, k, None, None, None] * np.take(wide, range(k, k + n), axis) for k in range(2 * r + 1))
    return x


def gaussian_blur(df: DataFrame, size: int = 5, sigma=(0.1, 2.0), seed: int = 42) -> DataFrame:
    drawn = df.withColumn("_sigma", between(*sigma, str(seed), *image_key(df), "sigma"))
    return apply(drawn, lambda x, p: np.rint(convolved(x.astype(float), kernel(size, p["_sigma"].to_numpy())))).drop("_sigma")


def sharpen(df: DataFrame, factor: float = 2.0) -> DataFrame:
    """Move away from a smoothed image; borders stay."""

    def run(x: np.ndarray, _: pd.DataFrame) -> np.ndarray:
        y = x.astype(float)
        if min(x.shape[1:3]) < 3:
            return x
        h, w = x.shape[1:3]
        soft = sum((5.0 if (i, j) == (1, 1) else 1.0) * y[:, i : h - 2 + i, j : w - 2 + j] for i in range(3) for j in range(3)) / 13.0
        y[:, 1:-1, 1:-1] = factor * y[:, 1:-1, 1:-1] + (1 - factor) * np.rint(soft)
        return np.clip(y, 0, 255)

    return apply(df, run)


def rectangle(h: Column, w: Column, scale: tuple[float, float], aspect: tuple[float, float], *key) -> dict[str, Column]:
    """Height, width, top and left of a random rectangle: area and aspect uniform, corner uniform."""
    area = h * w * between(*scale, *key, "area")
    ratio = between(*aspect, *key, "aspect")
    rh = F.least(F.bround(F.sqrt(area * ratio)).cast("long"), h.cast("long"))
    rw = F.least(F.bround(F.sqrt(area / ratio)).cast("long"), w.cast("long"))
    return {"rect_h": rh, "rect_w": rw, "rect_top": integer(h - rh, *key, "top"), "rect_left": integer(w - rw, *key, "left")}


def static_rectangles(plan: DataFrame, h: int, w: int, scale=(0.02, 0.15), seed: int = 42) -> DataFrame:
    """One rectangle per output episode, to be joined to its frames."""
    key = (str(seed), F.col("segment"), F.col("episode_index"), "static")
    return plan.withColumns(rectangle(F.lit(h), F.lit(w), scale, (0.5, 2.0), *key))


def episode_rectangles(images: DataFrame, scale=(0.02, 0.15), seed: int = 42) -> DataFrame:
    """The rectangles of :func:`static_rectangles` for images of any size; a hash of the episode draws, so nothing is joined."""
    key = (str(seed), F.col("segment"), F.col("episode_index"), "static")
    return images.withColumns(rectangle(F.col("h"), F.col("w"), scale, (0.5, 2.0), *key))


def random_rectangles(images: DataFrame, p: float = 0.5, scale=(0.02, 0.15), seed: int = 42) -> DataFrame:
    """A rectangle for about a share ``p`` of the images; the others get one without height."""
    key = (str(seed), *image_key(images), "erase")
    found = images.withColumns(rectangle(F.col("h"), F.col("w"), scale, (0.3, 3.3), *key))
    return found.withColumn("rect_h", F.when(uniform(*key, "p") < p, F.col("rect_h")).otherwise(0))


def erase(df: DataFrame, value: int = 0) -> DataFrame:
    """Fill each row's rectangle."""

    def run(x: np.ndarray, p: pd.DataFrame) -> np.ndarray:
        y, (h, w) = x.copy(), x.shape[1:3]
        top, left, rh, rw = (p[c].to_numpy()[:, None] for c in ("rect_top", "rect_left", "rect_h", "rect_w"))
        rows = (np.arange(h) >= top) & (np.arange(h) < top + rh)
        columns = (np.arange(w) >= left) & (np.arange(w) < left + rw)
        y[rows[:, :, None] & columns[:, None, :]] = value
        return y

    return apply(df, run)


def boxed(images: DataFrame, boxes: DataFrame, width: int = 3, color=(0, 255, 0)) -> DataFrame:
    """Draw the outlines of all boxes of an image; images without boxes stay."""
    key = ["episode_index", "frame_index", "camera"]
    lists = boxes.groupBy(*key).agg(F.sort_array(F.collect_list(F.array("x0", "y0", "x1", "y1"))).alias("_boxes"))

    def run(x: np.ndarray, p: pd.DataFrame) -> np.ndarray:
        y, (h, w) = x.copy(), x.shape[1:3]
        for image, found in zip(y, p["_boxes"], strict=True):
            for x0, y0, x1, y1 in found if found is not None else ():
                a, b, c, d = max(0, int(x0)), max(0, int(y0)), min(w - 1, int(x1)), min(h - 1, int(y1))
                inside = image[b : d + 1, a : c + 1]
                edge = np.ones(inside.shape[:2], bool)
                edge[width:-width, width:-width] = False
                inside[edge] = color
        return y

    return apply(images.join(lists, key, "left"), run).drop("_boxes")


def blob_paths(lengths: DataFrame, h: int | None, w: int | None, radius: int = 30, speed: float = 2.0, seed: int = 42) -> DataFrame:
    """Centre of the drifting blob for each frame: a reflected walk with a capped speed.

    ``lengths`` has segment, episode_index, camera and usable_len, and h and w where these are None.  The walk is sequential, so a helper steps
    through scalars alone; each sequence is a row and needs no grouping.
    """

    all_h, all_w = h, w

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                h, w = (r.h, r.w) if all_h is None else (all_h, all_w)
                rng = np.random.default_rng([seed, r.segment + 2, r.episode_index, *r.camera.encode()])
                r_y, r_x = min(radius, h / 2), min(radius, w / 2)
                at = np.array([rng.uniform(r_y, h - r_y), rng.uniform(r_x, w - r_x)])
                angle = rng.uniform(0, 2 * np.pi)
                move = speed * np.array([np.sin(angle), np.cos(angle)])
                path = []
                for _ in range(r.usable_len):
                    path.append(at.copy())
                    at = at + move
                    for k, (limit, edge) in enumerate(((h, r_y), (w, r_x))):
                        if not edge <= at[k] <= limit - edge:
                            move[k], at[k] = -move[k], min(max(at[k], edge), limit - edge)
                    move = move + rng.normal(0, speed * 0.1, 2)
                    size = np.hypot(*move)
                    if size > 2 * speed:
                        move *= 2 * speed / size
                yield pd.DataFrame({"segment": r.segment, "episode_index": r.episode_index, "camera": r.camera, "frame_index": range(len(path)), "cy": [p[0] for p in path], "cx": [p[1] for p in path]})

    return lengths.mapInPandas(walk, "segment int, episode_index long, camera string, frame_index long, cy double, cx double")


def paint_blob(df: DataFrame, radius: int = 30, softness: float = 0.6, opacity: float = 0.5) -> DataFrame:
    """Blend a soft disc around (cy, cx) towards its weighted mean colour."""

    def run(x: np.ndarray, p: pd.DataFrame) -> np.ndarray:
        h, w = x.shape[1:3]
        dy = np.arange(h)[None, :, None] - np.rint(p["cy"].to_numpy())[:, None, None]
        dx = np.arange(w)[None, None, :] - np.rint(p["cx"].to_numpy())[:, None, None]
        far = dy**2 + dx**2
        mask = np.where(far > radius**2, 0.0, np.exp(-far / (2 * (radius * max(softness, 0.05)) ** 2)))
        total = mask.sum((1, 2))
        y = x.astype(float)
        mean = (y * mask[..., None]).sum((1, 2)) / np.where(total > 0, total, 1.0)[:, None]
        alpha = mask[..., None] * opacity
        return y * (1 - alpha) + mean[:, None, None, :] * alpha

    return apply(df, run)


def pixels_long(df: DataFrame, channels: int = 3, column: str = "pixels") -> DataFrame:
    """One row per pixel and channel; for small images and checks."""
    n = F.length(column)
    spread = df.withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
    level = F.conv(F.hex(F.substring(column, F.col("_i") + 1, F.lit(1))), 16, 10).cast("long")
    i, w = F.col("_i"), F.col("w")
    return spread.withColumns({"y": F.floor(i / (w * channels)), "x": F.floor(i / channels) % w, "ch": (i % channels).cast("long"), "level": level}).drop("_i", column)
