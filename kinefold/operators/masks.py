"""Foreground masks: prediction, reuse, union, statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import published
from .images import convolved, kernel, stacks

KEY = ("episode_index", "frame_index", "camera")
SEQUENCE = ("episode_index", "camera", "h", "w")
LEAST, MOST = 0.01, 0.80
#: Frames of a block of a sequence, rounded up to the stride.
BLOCK = 256
#: So many blocks of a plan are broadcast at most (about 60 bytes each).
FEW_BLOCKS = 200_000

MaskFn = Callable[[np.ndarray], np.ndarray | Sequence | None]


def _ellipse() -> np.ndarray:
    """The 5 x 5 ellipse of the usual morphology libraries."""
    out = np.ones((5, 5), bool)
    out[[0, 4]] = False
    out[[0, 4], 2] = True
    return out


def _morph(mask: np.ndarray, grow: bool) -> np.ndarray:
    wide = np.pad(mask, ((0, 0), (2, 2), (2, 2)), constant_values=not grow)
    h, w = mask.shape[1:]
    parts = [wide[:, i : i + h, j : j + w] for i in range(5) for j in range(5) if _ellipse()[i, j]]
    return np.logical_or.reduce(parts) if grow else np.logical_and.reduce(parts)


def brightness_mask(stack: np.ndarray, threshold: float = 100.0, use_luma: bool = False, clean: bool = True) -> np.ndarray:
    """Pixels brighter than a threshold, then opened and closed; stacks (n, h, w, c) to (n, h, w)."""
    x = stack.astype(float)
    gray = x @ np.array([0.299, 0.587, 0.114]) if use_luma and x.shape[-1] == 3 else x.mean(-1)
    mask = gray > threshold
    if clean:
        mask = _morph(_morph(mask, False), True)
        mask = _morph(_morph(mask, True), False)
    return mask.astype(np.uint8)


def predict(images: DataFrame, mask_fn: Callable[[np.ndarray], np.ndarray] = brightness_mask) -> DataFrame:
    """A mask and its coverage for each image, by any function from stacks of images to stacks of 0 and 1.

    A model comes in here: the function runs on stacks of bounded size.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            mask, cover = [None] * len(pdf), [None] * len(pdf)
            pdf = pdf.reset_index(drop=True)
            for (h, w, c), rows in stacks(pdf[pdf["pixels"].notna()], ["h", "w", "c"], lambda h, w, c: h * w * c):
                found = mask_fn(np.frombuffer(b"".join(rows["pixels"]), np.uint8).reshape(len(rows), h, w, c))
                for i, m in zip(rows.index, found, strict=True):
                    mask[i], cover[i] = m.astype(np.uint8).tobytes(), float(m.mean())
            yield pdf[["episode_index", "frame_index", "camera", "h", "w"]].assign(mask=mask, coverage=cover)

    return images.mapInPandas(run, "episode_index long, frame_index long, camera string, h int, w int, mask binary, coverage double")


def _tried(predictor: MaskFn, stack: np.ndarray) -> list[np.ndarray | str]:
    """For each image a mask, or why there is none; an image that fails doesn't spoil the others of its stack."""
    alone = len(stack) == 1
    try:
        made = predictor(stack)
        made = [None] * len(stack) if made is None else list(made)
        fault = None if len(made) == len(stack) else f"{len(made)} masks for {len(stack)} images"
    except Exception as e:  # whatever a model raises is this image's reason
        made, fault = [], f"{type(e).__name__}: {e}"
    if fault:
        return [fault] if alone else [x for k in range(len(stack)) for x in _tried(predictor, stack[k : k + 1])]
    out: list[np.ndarray | str] = []
    for m in made:
        shape = None if m is None else np.shape(m)
        out.append("no mask" if m is None else np.asarray(m).astype(np.uint8) if shape == stack.shape[1:3] else f"mask of shape {shape}")
    return out


def outcomes(chain: Sequence[MaskFn], stack: np.ndarray) -> list[tuple[np.ndarray | None, str | None]]:
    """The first mask that a chain of predictors has for each image; without one, what each of them said."""
    found: list[np.ndarray | None] = [None] * len(stack)
    said: list[list[str]] = [[] for _ in stack]
    for predictor in chain:
        left = [k for k, m in enumerate(found) if m is None]
        for k, m in zip(left, _tried(predictor, stack[left]) if left else [], strict=True):
            if isinstance(m, str):
                said[k].append(m)
            else:
                found[k] = m
    return [(m, None if m is not None else "; ".join(s) or "no predictor") for m, s in zip(found, said, strict=True)]


def _walk(chain: Sequence[MaskFn], plain: MaskFn, stride: int, size: int, ahead: int):
    """A function over images sorted by block and frame: each row's mask by the rule of reuse, as far as its block tells.

    A block starts with its phase, the frames until the next prediction, and with nothing in hand: rows that depend on
    an earlier block's mask have no mask_src, and ``own`` tells those whose mask is the heuristic's anyway.  ``next`` is
    the frame from which the following prediction is due.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = kept = None
        ask = 0
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            keys = list(zip(*(pdf[c] for c in (*SEQUENCE, "block", "phase")), strict=True))
            frames, pixels = pdf["frame_index"].tolist(), pdf["pixels"].tolist()
            shapes = list(zip(pdf["h"], pdf["w"], pdf["c"], strict=True))
            stored = pdf["stored"].tolist() if "stored" in pdf else None
            known: dict[int, tuple[np.ndarray | None, str | None]] = {}
            out: list[tuple] = []

            def predicted(k: int) -> tuple[np.ndarray | None, str | None]:
                h, w, c = shapes[k]
                if stored is not None:
                    m = stored[k]
                    return (np.frombuffer(m, np.uint8).reshape(h, w), None) if m is not None and len(m) == h * w else (None, "no mask stored" if m is None else f"stored mask of {len(m)} bytes")
                if k not in known:
                    rows, due = [k], frames[k] + stride
                    for j in range(k + 1, len(keys)):
                        if len(rows) >= ahead or keys[j] != keys[k] or shapes[j] != shapes[k]:
                            break
                        if pixels[j] is not None and frames[j] >= due and j not in known:
                            rows.append(j)
                            due = frames[j] + stride
                    stack = np.frombuffer(b"".join(pixels[j] for j in rows), np.uint8).reshape(len(rows), h, w, c)
                    known.update(zip(rows, outcomes(chain, stack), strict=True))
                return known.pop(k)

            for k, frame in enumerate(frames):
                if keys[k] != at:
                    at, kept, ask = keys[k], None, keys[k][4] * size + keys[k][5]
                if pixels[k] is None:
                    out.append((None, None, "fallback", None, True, "no pixels", None))
                    continue
                if frame < ask:
                    out.append((*(kept[1:] if kept else (None, None)), "cached", kept and kept[0], False, None, None))
                    continue
                mask, reason = predicted(k)
                cover = None if mask is None else float(mask.mean())
                if mask is not None and LEAST <= cover <= MOST:
                    kept, ask = (frame, mask.tobytes(), cover), frame + stride
                    out.append((kept[1], cover, "predicted", frame, False, None, ask))
                    continue
                ask = frame + 1
                reason = reason or f"coverage {cover:.4f}"
                if mask is not None and kept:
                    out.append((kept[1], kept[2], "fallback", kept[0], False, reason, ask))
                else:
                    h, w, c = shapes[k]
                    simple = np.asarray(plain(np.frombuffer(pixels[k], np.uint8).reshape(1, h, w, c))[0]).astype(np.uint8)
                    out.append((simple.tobytes(), float(simple.mean()), "fallback", None, mask is None, reason, ask))
            names = ("mask", "coverage", "kind", "mask_src", "own", "reason", "next")
            columns = dict(zip(names, zip(*out, strict=True), strict=True)) if out else {n: () for n in names}
            kinds = {"coverage": "Float64", "mask_src": "Int64", "next": "Int64", "own": bool}
            yield pdf.drop(columns="stored", errors="ignore").assign(**{n: pd.Series(list(v), pdf.index, kinds.get(n, object)) for n, v in columns.items()})

    return run


def _chained(size: int):
    """A function over the blocks of one sequence, scalars all: which phase each block has and the last good frame before it.

    Where a block wasn't walked in the phase that the blocks before lead to, it and all later blocks are asked for in
    that phase, which stays the same as long as predictions are good.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        table = {(int(b), int(p)): (n, g) for b, p, n, g in zip(pdf["block"], pdf["phase"], pdf["next"], pdf["good"], strict=True)}
        blocks, ask, last, out = sorted({b for b, _ in table}), 0, None, []
        for k, block in enumerate(blocks):
            phase = max(0, ask - block * size)
            if (block, phase) not in table:
                out += [(b, phase, None, True) for b in blocks[k:] if (b, phase) not in table]
                break
            out.append((block, phase, last, False))
            after, good = table[block, phase]
            ask = ask if pd.isna(after) else int(after)
            last = last if pd.isna(good) else int(good)
        first = pdf.iloc[0]
        made = pd.DataFrame(out, columns=["block", "phase", "before", "need"])
        return made.assign(before=made["before"].astype("Int64"), **{c: first[c] for c in SEQUENCE})

    return run


def reused(images: DataFrame, mask_fn: MaskFn | Sequence[MaskFn] = brightness_mask, stride: int = 5, plain: MaskFn = brightness_mask, stored: DataFrame | None = None, ahead: int = 1, block: int = BLOCK) -> DataFrame:
    """Images with mask, coverage, kind, mask_src and reason by the rule of :func:`sources`, predicted only where it asks.

    ``mask_fn`` is a predictor or a chain of them, of which the first that gives a mask counts; ``stored``, a table of
    masks by episode, frame and camera, takes their place.  A predictor that raises, has no mask or one of another shape
    leaves this image to the heuristic ``plain``, as does a bad mask where there is no good one before; reason says why.
    ``ahead`` asked images go to a predictor as one stack, on the guess that all are good.  Null pixels have a null mask.

    A sequence (episode, camera and size) is cut into blocks of frames, which are walked by different tasks, first on the
    guess that a prediction is due at each start.  What a block's walk says of the next prediction and the last good
    mask is combined over the blocks of a sequence, on scalars; blocks that begin otherwise are walked again, in at
    most ``stride`` rounds.  Rows that need a mask from before their block get it by a join.
    Walked blocks are written, so this isn't lazy.
    """
    chain = [mask_fn] if callable(mask_fn) else list(mask_fn)
    size = -(-max(block, stride) // stride) * stride
    kept = images.columns
    if stored is not None:
        images = images.join(stored.select(*KEY, F.col("mask").alias("stored")), list(KEY), "left")
    dealt = images.withColumn("block", F.floor(F.col("frame_index") / size))
    made = T.StructType([f for f in images.schema.fields if f.name != "stored"])
    for name, kind in (("block", "long"), ("phase", "long"), ("mask", "binary"), ("coverage", "double"), ("kind", "string"), ("mask_src", "long"), ("own", "boolean"), ("reason", "string"), ("next", "long")):
        made = made.add(name, kind)
    keys = [*SEQUENCE, "block"]

    def walked(rows: DataFrame) -> DataFrame:
        order = rows.select(*[c for c in rows.columns if c not in ("block", "phase")], F.col("block").cast("long").alias("block"), F.col("phase").cast("long").alias("phase"))
        spread = order.repartition("episode_index", "camera", "block", "phase").sortWithinPartitions(*keys, "phase", "frame_index")
        return published(spread.mapInPandas(_walk(chain, plain, stride, size, ahead), made), "mask-walk")

    def ends(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, "phase").agg(F.max("next").alias("next"), F.max(F.when(F.col("kind") == "predicted", F.col("frame_index"))).alias("good"))

    rows = walked(dealt.withColumn("phase", F.lit(0)))
    told = ends(rows)
    while True:
        plan = published(told.groupBy(*SEQUENCE).applyInPandas(_chained(size), "block long, phase long, before long, need boolean, episode_index long, camera string, h int, w int"), "mask-plan")
        need = plan.where("need").select(*keys, "phase")
        if not need.limit(1).count():
            break
        again = walked(dealt.join(need, keys))
        rows, told = rows.unionByName(again), told.unionByName(ends(again))
    # scalars of blocks, broadcast where they are few
    chosen = plan.select(*keys, "phase", "before")
    rows = rows.join(F.broadcast(chosen) if plan.count() <= FEW_BLOCKS else chosen, [*keys, "phase"])
    waits = F.col("mask_src").isNull() & ~F.col("own") & F.col("before").isNotNull()
    good = rows.where("kind = 'predicted'").select(*SEQUENCE, F.col("frame_index").alias("before"), F.col("mask").alias("_mask"), F.col("coverage").alias("_coverage"))
    late = rows.where(waits).drop("mask", "coverage", "mask_src").join(good, [*SEQUENCE, "before"])
    names = [*kept, "mask", "coverage", "kind", "mask_src", "reason"]
    late = late.withColumnsRenamed({"_mask": "mask", "_coverage": "coverage"}).withColumn("mask_src", F.col("before"))
    return rows.where(~waits).select(*names).unionByName(late.select(*names))


def bad(coverage: Column) -> Column:
    return coverage.isNull() | (coverage < LEAST) | (coverage > MOST)


def sources(coverages: DataFrame, stride: int = 5) -> DataFrame:
    """Which frame's mask each frame uses: a good one is reused for ``stride`` frames, else predicted anew.

    A bad prediction falls back to the last good mask, or to the heuristic (mask_src null) if there is none, and
    the next frame predicts again.  The rule is sequential, so a helper steps through (frame, coverage) of one
    episode and camera; no pixels are in its input.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame_index")
        last, src, call = None, [], []
        for i, c in zip(pdf["frame_index"], pdf["coverage"], strict=True):
            fresh = last is None or i - last >= stride
            good = c is not None and LEAST <= c <= MOST
            if fresh and good:
                last = i
            src.append(last)
            call.append("predicted" if fresh and good else "fallback" if fresh else "cached")
        return pd.DataFrame({"episode_index": pdf["episode_index"], "frame_index": pdf["frame_index"], "camera": pdf["camera"], "mask_src": pd.array(src, "Int64"), "kind": call})

    schema = "episode_index long, frame_index long, camera string, mask_src long, kind string"
    return coverages.select(*KEY, "coverage").groupBy("episode_index", "camera").applyInPandas(run, schema)


def statistics(masks: DataFrame) -> DataFrame:
    """Frames, predictions, cache hits, fallbacks and mean coverage per episode; needs kind and coverage."""
    count = lambda k: F.sum((F.col("kind") == k).cast("long"))
    return masks.groupBy("episode_index").agg(F.count("*").alias("frames"), count("predicted").alias("calls"), count("cached").alias("cache_hits"), count("fallback").alias("fallbacks"), F.avg("coverage").alias("avg_coverage"))


def top_regions(regions: DataFrame, k: int = 4, min_iou: float = 0.75) -> DataFrame:
    """Of each image the k largest regions, then those sure enough; a missing sureness counts as 1."""
    by_area = Window.partitionBy(*KEY).orderBy(F.desc("area"), "region_id")
    ranked = regions.withColumn("_k", F.row_number().over(by_area)).where(F.col("_k") <= k)
    return ranked.where(F.coalesce("predicted_iou", F.lit(1.0)) >= min_iou).drop("_k")


def union(regions: DataFrame) -> DataFrame:
    """Pixelwise OR of an image's regions; images without any have no row.

    Masks (bytes 0 and 1) become words of 64 pixels, whose OR is aggregated before and after the shuffle, so regions of one
    image need not meet in a task.  Masks of one image have one size; a shorter one counts as zero beyond its end.
    """
    bits = regions.where("pixels is not null").select(*KEY, F.octet_length("pixels").alias("n"), F.regexp_replace(F.hex("pixels"), "0([01])", "$1").alias("bits"))
    words = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / 64) - 1, F.lit(0)).cast("int")), lambda k: F.conv(F.rpad(F.substring("bits", k * 64 + 1, F.lit(64)), 64, "0"), 2, -10).cast("long"))
    merged = bits.select(*KEY, "n", F.posexplode(words).alias("at", "word")).groupBy(*KEY, "at").agg(F.bit_or("word").alias("word"), F.max("n").alias("n"))
    whole = merged.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"), F.sum(F.bit_count("word")).alias("ones"), F.max("n").alias("n"))
    text = F.concat_ws("", F.transform("words", lambda x: F.lpad(F.bin(x["word"]), 64, "0")))
    return whole.select(*KEY, F.unhex(F.regexp_replace(F.substring(text, F.lit(1), F.col("n")), "([01])", "0$1")).alias("mask"), (F.col("ones") / F.greatest("n", F.lit(1))).alias("coverage"))


def feathered(masks: np.ndarray, radius: int = 10) -> np.ndarray:
    """Soft masks: a Gaussian of 2 r + 1 points with the usual automatic sigma."""
    x = masks.astype(float)
    if radius <= 0:
        return x
    size = 2 * radius + 1
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    return np.clip(convolved(x[..., None], kernel(size, np.full(len(x), sigma)))[..., 0], 0, 1)


def mask_rgb(masks: DataFrame) -> DataFrame:
    """Masks as images of three equal channels, 0 or 255."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [None if m is None else np.repeat(np.frombuffer(m, np.uint8) * np.uint8(255), 3).tobytes() for m in pdf["mask"]]
            yield pdf.drop(columns="mask").assign(c=3, pixels=made)

    return masks.select(*KEY, "h", "w", "mask").mapInPandas(run, "episode_index long, frame_index long, camera string, h int, w int, c int, pixels binary")


def with_declared(images: DataFrame, masks: DataFrame) -> DataFrame:
    """A mask image for every image; those without a mask get zeros of their size."""
    both = images.select(*KEY, "h", "w").join(masks.select(*KEY, F.col("pixels").alias("_m")), list(KEY), "left")
    zeros = F.unhex(F.expr("repeat('00', h * w * 3)"))
    return both.select(*KEY, "h", "w", F.lit(3).alias("c"), F.coalesce("_m", zeros).alias("pixels"))
