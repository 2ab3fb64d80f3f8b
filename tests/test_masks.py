"""Mask prediction that may fail, reuse over blocks, stored masks, resizing, declared features."""

import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kinefold.operators import background, images as im, masks as mk
from kinefold.plans import export, jobs
from kinefold.plans.recipes import resolve
from kinefold.sources import datasets

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # predictors defined here reach workers as code
SIZE = 4
GOOD, BAD, NONE, RAISES, SHAPE, NULL = range(6)


def picture(kind, k):
    x = np.zeros((SIZE, SIZE, 1), np.uint8)
    x[0, 0, 0], x[0, 1, 0], x[0, 2, 0] = kind, k % 251, 200
    return x


def mask_of(k):
    """A mask of its own for each frame, never bad."""
    m = np.zeros((SIZE, SIZE), np.uint8)
    m[0, 0] = 1
    m.ravel()[1:9] = [(k >> b) & 1 for b in range(8)]
    return m


def fickle(x):
    out = []
    for one in x:
        kind, k = one[0, 0, 0], int(one[0, 1, 0])
        if kind == RAISES:
            raise ValueError(f"frame {k}")
        out.append({GOOD: mask_of(k), BAD: np.ones((SIZE, SIZE)), NONE: None, SHAPE: np.ones((2, 2))}[kind])
    return out


def by_rule(kinds, stride):
    """(kind, frame of the mask or None) by walking one frame after the other."""
    last, out = None, []
    for i, kind in enumerate(kinds):
        if kind == NULL:
            out.append(("fallback", None))
        elif last is not None and i - last < stride:
            out.append(("cached", last))
        elif kind == GOOD:
            last = i
            out.append(("predicted", i))
        else:
            out.append(("fallback", last if kind == BAD else None))
    return out


def shots(spark, kinds, episode=0, camera="top"):
    rows = [(episode, i, camera, SIZE, SIZE, 1, None if k == NULL else picture(k, i).tobytes()) for i, k in enumerate(kinds)]
    frame = pd.DataFrame(rows, columns=["episode_index", "frame_index", "camera", "h", "w", "c", "pixels"])
    return spark.createDataFrame(frame, datasets.IMAGES)


def expected(kinds, stride, k, shown):
    kind, src = shown
    if kinds[k] == NULL:
        return kind, None, None
    mask = mask_of(src % 251) if src is not None else mk.brightness_mask(picture(kinds[k], k)[None])[0]
    return kind, src, mask.astype(np.uint8).tobytes()


@pytest.mark.parametrize(("seed", "ahead"), [(1, 1), (2, 4)])
def test_blocks_give_the_sequential_rule(spark, seed, ahead):
    rnd = random.Random(seed)
    weights = [60, 6, 2, 2, 1, 2] if seed == 1 else [4, 6, 1, 1, 1, 1]
    kinds = rnd.choices(range(6), weights, k=3000) + [BAD] * 100 + [GOOD] * 40
    df = shots(spark, kinds).unionByName(shots(spark, kinds[:90], 1)).unionByName(shots(spark, [BAD] * 70, 1, "side")).repartition(3)
    found = mk.reused(df, fickle, 5, ahead=ahead, block=32)
    got = {(r["episode_index"], r["camera"], r["frame_index"]): (r["kind"], r["mask_src"], r["mask"]) for r in found.collect()}
    for episode, camera, part in ((0, "top", kinds), (1, "top", kinds[:90]), (1, "side", [BAD] * 70)):
        for k, shown in enumerate(by_rule(part, 5)):
            assert got.pop((episode, camera, k)) == expected(part, 5, k, shown), (episode, camera, k)
    assert not got
    total = mk.statistics(found).where("episode_index = 0").first()
    want = [k for k, _ in by_rule(kinds, 5)]
    assert (total["frames"], total["calls"], total["cache_hits"], total["fallbacks"]) == (len(kinds), want.count("predicted"), want.count("cached"), want.count("fallback"))


def test_blocks_of_one_sequence_are_many_tasks(spark):
    kinds = [GOOD] * 1000
    rows = mk.reused(shots(spark, kinds), fickle, 5, block=50)
    assert rows.where("kind = 'predicted'").count() == 200 and rows.where("kind = 'cached' and mask_src = frame_index - frame_index % 5").count() == 800
    assert mk.reused(shots(spark, []), fickle).count() == 0


def test_failures_have_reasons_and_spare_their_neighbours(spark):
    kinds = [RAISES, NONE, SHAPE, BAD, GOOD, NULL, GOOD]
    got = [tuple(r) for r in mk.reused(shots(spark, kinds), fickle, 1, ahead=8).orderBy("frame_index").select("kind", "reason").collect()]
    assert got == [("fallback", "ValueError: frame 0"), ("fallback", "no mask"), ("fallback", "mask of shape (2, 2)"), ("fallback", "coverage 1.0000"), ("predicted", None), ("fallback", "no pixels"), ("predicted", None)]


def test_chain_of_predictors(spark):
    kinds = [GOOD, RAISES, NONE, GOOD]
    second = lambda x: [None if one[0, 0, 0] == NONE else mask_of(77) for one in x]
    got = mk.reused(shots(spark, kinds), [fickle, second], 1).orderBy("frame_index").collect()
    assert [r["kind"] for r in got] == ["predicted", "predicted", "fallback", "predicted"]
    assert got[1]["mask"] == mask_of(77).tobytes() and got[2]["reason"] == "no mask; no mask"


def test_stored_masks_take_the_predictors_place(spark):
    stored = spark.createDataFrame([(0, i, "top", bytearray(m)) for i, m in ((0, mask_of(9).tobytes()), (1, b"\x01"), (4, mask_of(5).tobytes()))], "episode_index long, frame_index long, camera string, mask binary")
    got = mk.reused(shots(spark, [GOOD] * 6), fickle, 2, stored=stored).orderBy("frame_index").collect()
    assert [(r["kind"], r["mask_src"]) for r in got] == [("predicted", 0), ("cached", 0), ("fallback", None), ("fallback", None), ("predicted", 4), ("cached", 4)]
    assert got[1]["mask"] == mask_of(9).tobytes() and got[2]["reason"] == "no mask stored"


def test_union_by_words(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for frame, n in ((0, 64), (1, 100), (2, 7), (3, 3000)):
        made = [rng.integers(0, 2, n).astype(np.uint8) for _ in range(5)]
        want[frame] = np.bitwise_or.reduce(made)
        rows += [(0, frame, "top", bytearray(m.tobytes())) for m in made]
    df = spark.createDataFrame([*rows, (0, 9, "top", None)], "episode_index long, frame_index long, camera string, pixels binary").repartition(5)
    got = {r["frame_index"]: r for r in mk.union(df).collect()}
    assert {k: bytes(r["mask"]) for k, r in got.items()} == {k: m.tobytes() for k, m in want.items()}
    assert all(got[k]["coverage"] == pytest.approx(m.mean()) for k, m in want.items())


def bilinear(x, h, w):
    """Pixel by pixel."""
    out = np.zeros((h, w, x.shape[2]))
    for i in range(h):
        for j in range(w):
            y, z = (min(max((k + 0.5) * size / wanted - 0.5, 0), size - 1) for k, size, wanted in ((i, x.shape[0], h), (j, x.shape[1], w)))
            a, b = int(y), int(z)
            c, d = min(a + 1, x.shape[0] - 1), min(b + 1, x.shape[1] - 1)
            top = x[a, b] * (1 - (z - b)) + x[a, d] * (z - b)
            low = x[c, b] * (1 - (z - b)) + x[c, d] * (z - b)
            out[i, j] = np.floor(top * (1 - (y - a)) + low * (y - a) + 0.5)
    return out


@pytest.mark.parametrize(("h", "w"), [(9, 4), (3, 13), (6, 7)])
def test_backgrounds_of_other_sizes_are_interpolated(spark, h, w):
    rng = np.random.default_rng(h)
    bg, fg = rng.integers(0, 256, (6, 7, 3)), rng.integers(0, 256, (h, w, 3))
    mask = (rng.random((h, w)) < 0.5).astype(np.uint8)
    as_bytes = lambda x: bytearray(x.astype(np.uint8).tobytes())
    row = (0, 0, "top", h, w, 3, as_bytes(fg), as_bytes(mask), 6, 7, as_bytes(bg))
    df = spark.createDataFrame([row], "episode_index long, frame_index long, camera string, h int, w int, c int, pixels binary, mask binary, bg_h int, bg_w int, bg_pixels binary")
    got = np.frombuffer(background.composite(df, 0, linear=True).first()["pixels"], np.uint8).reshape(h, w, 3)
    assert (got == np.where(mask[..., None] == 1, fg, bilinear(bg, h, w))).all()
    assert (im.resized(bg[None].astype(np.uint8), 6, 7)[0] == bg).all()


def dataset(spark, h=480, w=640):
    """Three episodes of two frames by two cameras, of real size; the first camera sees a bright square."""
    rng = np.random.default_rng(8)
    frames, shown = [], []
    for e in range(3):
        for k in range(2):
            frames.append((e, k, e * 2 + k, k / 50, None, [float(e + k)] * 14, [float(e)] * 14))
            for camera in ("view.top", "side"):
                x = rng.integers(0, 60, (h, w, 3)).astype(np.uint8)
                if camera == "view.top":
                    x[100:200, 50 : 200 + 10 * k] = 220
                shown.append((e, k, camera, h, w, 3, bytearray(x.tobytes())))
    return spark.createDataFrame(frames, datasets.FRAMES), spark.createDataFrame(shown, datasets.IMAGES)


def test_composed_dataset_of_real_size_is_written_under_its_features(spark, tmp_path):
    frames, shown = dataset(spark)
    recipe = resolve(augmentations=("background", "horizontal_flip"), prefilter=False, num_passes=1, include_originals=True, two_arms=True, temporal_jitter=0.0, action_shift=0, tail_drop_max=0, smoothing=False, action_noise_std=0.0, mask_stride=2)
    made = jobs.augment_job(frames, recipe)
    out = jobs.images_job(shown, made, recipe)
    path = str(tmp_path / "out")
    schema = export.export_job(made, out, path)
    assert [f.name for f in schema][-2:] == ["mask_side", "mask_top"] and schema["mask_top"].metadata == {"dtype": "video", "shape": [480, 640, 3], "names": ["height", "width", "channel"]}
    back, pictures = export.read_dataset(spark, path)
    assert back.schema["mask_top"].metadata["shape"] == [480, 640, 3] and [f.name for f in back.schema] == [f.name for f in schema]
    rows = back.orderBy("episode_index", "frame_index").select("episode_index", "frame_index", *(F.octet_length(c).alias(f"{c}_n") for c in ("mask_top", "mask_side")), F.col("mask_top")).collect()
    assert len(rows) == 12 and all(r["mask_top_n"] == r["mask_side_n"] == 480 * 640 * 3 for r in rows)
    for r in rows:
        mask = np.frombuffer(r["mask_top"], np.uint8).reshape(480, 640, 3)
        if r["episode_index"] < 3:
            assert not mask.any()  # originals have none
        else:
            assert mask.max() == 255 and mask[150, 639 - 100].all() and not mask[300].any()
    assert pictures.count() == 24 and set(pictures.select("episode_index").distinct().toPandas()["episode_index"]) == set(range(6))
    told = {r["episode_index"]: r for r in out.mask_statistics.collect()}
    assert set(told) == {3, 4, 5} and all((r["frames"], r["calls"], r["cache_hits"], r["fallbacks"]) == (4, 1, 1, 2) for r in told.values())
    with pytest.raises(Exception, match="exist"):
        export.export_job(made, out, path)


def test_stored_masks_in_the_job_are_mirrored(spark):
    frames, shown = dataset(spark, 6, 8)
    mask = np.zeros((6, 8), np.uint8)
    mask[2:4, :3] = 1
    stored = spark.createDataFrame([(e, k, c, bytearray(mask.tobytes())) for e in range(3) for k in range(2) for c in ("view.top", "side")], "episode_index long, frame_index long, camera string, mask binary")
    recipe = resolve(augmentations=("background", "horizontal_flip"), prefilter=False, num_passes=1, include_originals=False, two_arms=True, temporal_jitter=0.0, action_shift=0, tail_drop_max=0, smoothing=False, action_noise_std=0.0)
    out = jobs.images_job(shown, jobs.augment_job(frames, recipe), recipe, masks=stored)
    got = out.images.collect()
    assert len(got) == 12 and {r["mask"] for r in got} == {mask[:, ::-1].tobytes()}


def test_loose_files_are_never_dropped(spark, tmp_path):
    for name, n in (("1_2_top.raw", 12), ("1_3_top.raw", 11), ("notes.txt", 3)):
        (tmp_path / name).write_bytes(bytes(n))
    got = {r["reason"] and r["reason"].split(" ")[0]: r for r in datasets.loose_images(spark, str(tmp_path), 2, 2).collect()}
    assert len(got) == 3 and got[None]["pixels"] == bytes(12) and (got["11"]["frame_index"], got["11"]["pixels"]) == (3, None) and got["not"]["camera"] is None
