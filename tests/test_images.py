"""Unit tests of image, mask and background operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinefold.operators import background, images as im, masks as mk, selection
from kinefold.plans import augmentations, jobs
from kinefold.plans.recipes import resolve
from kinefold.sources import datasets


def shots(spark, *arrays):
    rows = [(0, i, "top", *x.shape, x.astype(np.uint8).tobytes()) for i, x in enumerate(arrays)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, camera string, h int, w int, c int, pixels binary")


def arrays(df):
    return [np.frombuffer(r["pixels"], np.uint8).reshape(r["h"], r["w"], r["c"]) for r in df.orderBy("frame_index").collect()]


def picture(seed, h=6, w=8):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def test_flip_and_shapes(spark):
    a, b = picture(1), picture(2, 4, 5)
    got = arrays(im.flip(shots(spark, a, b)))
    assert (got[0] == a[:, ::-1]).all() and (got[1] == b[:, ::-1]).all()


def test_colour_conversion():
    x = np.random.default_rng(3).random((2, 5, 5, 3))
    assert np.allclose(im.from_hsv(im.to_hsv(x)), x)
    assert im.from_unit(np.array([[[[1.5], [-1.0], [0.5]]]])).tolist() == [[[[255] * 3, [0] * 3, [127] * 3]]]


def test_flat_images_stay(spark):
    flat = np.full((6, 8, 3), 90, np.uint8)
    for fn in (im.gaussian_blur, im.sharpen):
        assert (arrays(fn(shots(spark, flat)))[0] == flat).all()
    same = im.color_jitter(shots(spark, flat), (1, 1), (1, 1), (1, 1), (0, 0))
    assert np.abs(arrays(same)[0].astype(int) - 90).max() <= 1


def test_erasing_and_boxes(spark):
    a = picture(4)
    found = im.random_rectangles(shots(spark, a, a), p=1.0)
    rects = found.orderBy("frame_index").collect()
    for r, x in zip(rects, arrays(im.erase(found)), strict=True):
        want = a.copy()
        want[r["rect_top"] : r["rect_top"] + r["rect_h"], r["rect_left"] : r["rect_left"] + r["rect_w"]] = 0
        assert (x == want).all()
    boxes = spark.createDataFrame([(0, 0, "top", 1.0, 1.0, 5.0, 4.0)], "episode_index long, frame_index long, camera string, x0 double, y0 double, x1 double, y1 double")
    drawn, plain = arrays(im.boxed(shots(spark, a, a), boxes, 1))
    assert (plain == a).all() and (drawn[1, 1:6] == (0, 255, 0)).all() and (drawn[2, 2] == a[2, 2]).all()


def test_mask_reuse(spark):
    def run(coverages, stride=5):
        rows = [(0, i, "top", c) for i, c in enumerate(coverages)]
        df = spark.createDataFrame(rows, "episode_index long, frame_index long, camera string, coverage double")
        return [(r["mask_src"], r["kind"]) for r in mk.sources(df, stride).orderBy("frame_index").collect()]

    assert [s for s, _ in run([0.3] * 7)] == [0, 0, 0, 0, 0, 5, 5]
    bad_first = run([0.9] + [0.3] * 6)
    assert bad_first[0] == (None, "fallback") and [s for s, _ in bad_first[1:]] == [1, 1, 1, 1, 1, 6]
    late = run([0.3] * 5 + [0.001, 0.3])
    assert late[5] == (0, "fallback") and late[6] == (6, "predicted")


def test_heuristic_and_feather():
    x = np.zeros((1, 20, 20, 3), np.uint8)
    x[0, 5:15, 5:15] = 200
    x[0, 0, 0] = 255
    mask = mk.brightness_mask(x)
    assert mask[0, 10, 10] == 1 and mask[0, 0, 0] == 0
    soft = mk.feathered(mask, 3)
    assert 0 < soft[0, 4, 10] < 1 and soft[0, 10, 10] > 0.9 and (mk.feathered(mask, 0) == mask).all()


def test_composite(spark):
    fg, bg = picture(6), picture(7, 3, 4)
    mask = (np.arange(48) % 2).astype(np.uint8)
    rows = [(0, 0, "top", 6, 8, 3, fg.tobytes(), mask.tobytes(), 3, 4, bg.tobytes())]
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, camera string, h int, w int, c int, pixels binary, mask binary, bg_h int, bg_w int, bg_pixels binary")
    got = arrays(background.composite(df, 0))[0]
    big = bg[np.arange(6) * 3 // 6][:, np.arange(8) * 4 // 8]
    assert (got == np.where(mask.reshape(6, 8, 1) == 1, fg, big)).all()


def test_blob(spark):
    lengths = spark.createDataFrame([(0, 5, "top", 300)], "segment int, episode_index long, camera string, usable_len int")
    path = im.blob_paths(lengths, 100, 120, 10, 2.0).orderBy("frame_index").collect()
    assert len(path) == 300 and all(10 <= r["cy"] <= 90 and 10 <= r["cx"] <= 110 for r in path)
    assert max(np.hypot(b["cy"] - a["cy"], b["cx"] - a["cx"]) for a, b in zip(path, path[1:], strict=False)) <= 4.0 + 1e-9
    again = im.blob_paths(lengths.repartition(3), 100, 120, 10, 2.0).orderBy("frame_index").collect()
    assert path == again


def test_union_and_regions(spark):
    rows = [(0, 0, "top", 0, 3, 0.9, bytes([1, 1, 1, 0])), (0, 0, "top", 1, 2, None, bytes([0, 0, 1, 1])), (0, 0, "top", 2, 1, 0.9, bytes([0, 0, 0, 1])), (0, 1, "top", 0, 4, 0.1, bytes([1] * 4))]
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, camera string, region_id int, area long, predicted_iou double, pixels binary")
    got = mk.union(mk.top_regions(df, 2, 0.75)).collect()
    assert len(got) == 1 and bytes(got[0]["mask"]) == bytes([1, 1, 1, 1]) and got[0]["coverage"] == 1.0


def test_declared_masks(spark):
    df = shots(spark, picture(8), picture(9))
    found = mk.predict(df.where("frame_index = 0"))
    full = arrays(mk.with_declared(df, mk.mask_rgb(found)))
    assert full[1].sum() == 0 and set(np.unique(full[0])) <= {0, 255}


def test_background_picks(spark):
    df = shots(spark, *[picture(k) for k in range(12)])
    got = background.picks(df, 3).orderBy("frame_index").collect()
    assert got[0]["bg_frame"] == 0 and all(max(0, r["frame_index"] - 3) <= r["bg_frame"] < r["frame_index"] for r in got[1:])
    pairs = background.fan_out(df, 5).groupBy("frame_index").pivot("pick", [0, 1]).sum("bg_index").collect()
    assert all(r["0"] != r["1"] and 0 <= r["0"] < 5 and 0 <= r["1"] < 5 for r in pairs)
    assert background.fan_out(df, 1).count() == 12


def test_rows_survive_null_pixels(spark):
    df = shots(spark, picture(1)).unionByName(spark.createDataFrame([(0, 1, "top", 6, 8, 3, None)], "episode_index long, frame_index long, camera string, h int, w int, c int, pixels binary"))
    assert im.flip(df).where("pixels is null").count() == 1
    with pytest.raises(Exception, match="."):
        im.flip(df.withColumn("h", df["h"] * 2)).collect()


def footage(spark, lengths, h=6, w=8):
    """Frames and random images of episodes of these lengths."""
    frames = [(e, i, "t", [float(e + i)] * 14, [float(i)] * 14) for e, n in lengths.items() for i in range(n)]
    shown = [(e, i, "top", h, w, 3, picture(100 * e + i, h, w).tobytes()) for e, n in lengths.items() for i in range(n)]
    return (
        spark.createDataFrame(frames, "episode_index long, frame_index long, task string, action array<double>, state array<double>"),
        spark.createDataFrame(shown, "episode_index long, frame_index long, camera string, h int, w int, c int, pixels binary"),
    )


def collected(df):
    return {(r["episode_index"], r["frame_index"]): np.frombuffer(r["pixels"], np.uint8).reshape(r["h"], r["w"], r["c"]) for r in df.collect()}


PLAIN = dict(two_arms=True, num_passes=1, prefilter=False)


def test_repeated_episodes_get_their_own_images(spark):
    frames, shown = footage(spark, {1: 9, 3: 12})
    episodes = selection.select_episodes(datasets.episodes(frames), [3, 1, 3])
    for names in (("drifting_blob",), ("static_erasing",), ("color_jitter", "random_erasing")):
        recipe = resolve(augmentations=names, blob_radius=2, erasing_p=1.0, **PLAIN)
        out = jobs.augment_images_job(shown, jobs.augment_job(frames, recipe, episodes), recipe)
        got = collected(out)
        assert out.count() == 33 and set(got) == {(e, i) for e, n in enumerate((12, 9, 12)) for i in range(n)}
        assert any((got[0, i] != got[2, i]).any() for i in range(12))


def test_background_in_listed_order(spark):
    """Flip, sharpen, then composing over earlier images of the episode as they were, or over source frames of the one before."""
    frames, shown = footage(spark, {0: 3, 1: 4})
    recipe = resolve(augmentations=("horizontal_flip", "sharpness", "background"), feather=0, background_history=100, mask_stride=2, include_originals=True, **PLAIN)
    half = lambda x: np.repeat((np.arange(x.shape[2]) < 3)[None, None], x.shape[1], 1).repeat(len(x), 0)
    made = jobs.augment_job(frames, recipe)
    rows = jobs.augment_images_job(shown, made, recipe, mask_fn=half).collect()
    source = collected(shown)
    where = {r["episode_index"]: (r["segment"], r["source_episode"]) for r in made.frames.collect()}
    sharp = {k: x for k, x in zip(source, arrays_of(im.sharpen(im.flip(shown)), source), strict=True)}
    assert len(rows) == 14
    for r in rows:
        segment, episode = where[r["episode_index"]]
        got = np.frombuffer(r["pixels"], np.uint8).reshape(6, 8, 3)
        mask = np.frombuffer(r["mask"], np.uint8).reshape(6, 8)
        i = r["frame_index"]
        if segment < 0:
            assert (got == source[episode, i]).all() and not mask.any()
            continue
        assert mask[:, :3].all() and not mask[:, 3:].any() and (got[:, :3] == sharp[episode, i][:, :3]).all()
        pool = [sharp[episode, k] for k in range(i)] + ([source[0, k] for k in range(3)] if episode == 1 else [])
        assert any((got[:, 3:] == b[:, 3:]).all() for b in pool or [sharp[episode, i]])


def arrays_of(df, keys):
    found = collected(df)
    return [found[k] for k in keys]


def test_predictor_is_asked_by_the_stride(spark):
    df = shots(spark, *[picture(k) for k in range(12)])
    calls, bad = spark.sparkContext.accumulator(0), int(picture(5)[0, 0, 0])

    def counted(x):
        calls.add(len(x))
        mask = np.zeros(x.shape[:3], np.uint8)
        mask[:, :3] = x[0, 0, 0, 0] != bad  # the prediction for frame 5 is bad
        return mask

    got = sorted(mk.reused(df, counted, 5).collect(), key=lambda r: r["frame_index"])
    assert [r["kind"][0] for r in got] == list("pccccfpccccp") and calls.value == 4
    assert got[5]["mask"] == got[0]["mask"]
    plain = mk.reused(shots(spark, picture(5)), counted, 5).first()
    assert plain["kind"] == "fallback" and np.frombuffer(plain["mask"], np.uint8).tolist() == mk.brightness_mask(picture(5)[None])[0].ravel().tolist()


def test_boxes_mirror_and_registry(spark):
    frames, shown = footage(spark, {0: 2})
    boxes = spark.createDataFrame([(0, 1, "top", 1.0, 1.0, 3.0, 4.0)], "episode_index long, frame_index long, camera string, x0 double, y0 double, x1 double, y1 double")
    recipe = resolve(augmentations=("horizontal_flip", "background"), box_overlay=True, **PLAIN)
    made = jobs.augment_job(frames, recipe)
    with pytest.raises(ValueError, match="boxes"):
        jobs.augment_images_job(shown, made, recipe)
    got, source = collected(jobs.augment_images_job(shown, made, recipe, boxes)), collected(shown)
    assert (got[0, 0] == source[0, 0][:, ::-1]).all() and (got[0, 1][1:5, 4:7] == (0, 255, 0)).all() and (got[0, 1][:, 7] == source[0, 1][:, 0]).all()
    for wrong in (dict(), dict(action_signs=(1.0,) * 14)):
        with pytest.raises(ValueError):
            resolve(augmentations=("horizontal_flip",), **wrong)
    assert resolve(augmentations=("horizontal_flip",), action_signs=(-1.0,) * 14, state_signs=(1.0,) * 14).mirror().arm is None
    augmentations.augmentation("black")(lambda images, context: images.withColumn("pixels", F.unhex(F.expr("repeat('00', h * w * c)"))))
    try:
        recipe = resolve(augmentations=("black",), **PLAIN)
        assert not any(x.any() for x in collected(jobs.augment_images_job(shown, jobs.augment_job(frames, recipe), recipe)).values())
    finally:
        del augmentations.REGISTRY["black"]


def test_images_are_written_in_order(spark, tmp_path):
    _, shown = footage(spark, {0: 2, 1: 3})
    path = str(tmp_path / "out")
    datasets.write_images(shown, path)
    assert sorted(collected(spark.read.parquet(path))) == sorted(collected(shown))
    with pytest.raises(Exception, match="exist"):
        datasets.write_images(shown, path)


def test_pixel_maths_by_hand(spark):
    """Blur, sharpness and blob on random images, pixel by pixel; jitter by its steps."""
    x = picture(11, 7, 9)
    one = shots(spark, x)
    sigma = one.select(im.between(1.0, 2.0, "42", *im.image_key(one), "sigma").alias("s")).first()["s"]
    at = np.arange(-2, 3)
    weight = np.exp(-(at**2) / (2 * sigma**2))
    weight = np.outer(weight, weight) / weight.sum() ** 2
    wide = np.pad(x.astype(float), ((2, 2), (2, 2), (0, 0)), mode="reflect")
    want = np.array([[(wide[i : i + 5, j : j + 5] * weight[..., None]).sum((0, 1)) for j in range(9)] for i in range(7)])
    assert np.abs(arrays(im.gaussian_blur(one, 5, (1.0, 2.0)))[0] - want).max() <= 0.5 + 1e-9

    soft = np.array([[1, 1, 1], [1, 5, 1], [1, 1, 1]]) / 13
    want = x.astype(float)
    for i in range(1, 6):
        for j in range(1, 8):
            smooth = np.rint((x[i - 1 : i + 2, j - 1 : j + 2] * soft[..., None]).sum((0, 1)))
            want[i, j] = 1.5 * x[i, j] - 0.5 * smooth
    assert np.abs(arrays(im.sharpen(one, 1.5))[0] - np.clip(want, 0, 255)).max() < 1

    placed = one.selectExpr("*", "3.2D AS cy", "4.7D AS cx")
    got = arrays(im.paint_blob(placed, 3, 0.6, 0.5))[0]
    disc = np.array([[np.exp(-((i - 3) ** 2 + (j - 5) ** 2) / (2 * 1.8**2)) if (i - 3) ** 2 + (j - 5) ** 2 <= 9 else 0 for j in range(9)] for i in range(7)])
    mean = (x * disc[..., None]).sum((0, 1)) / disc.sum()
    alpha = 0.5 * disc[..., None]
    assert np.abs(got - (x * (1 - alpha) + mean * alpha)).max() < 1

    bright = np.clip(x / 255 * 1.1, 0, 1)
    gray = lambda y: y @ np.array([0.2989, 0.587, 0.114])
    wanted = np.clip(0.9 * bright + 0.1 * gray(bright).mean(), 0, 1)
    wanted = np.clip(1.3 * wanted - 0.3 * gray(wanted)[..., None], 0, 1)
    assert np.abs(arrays(im.color_jitter(one, (1.1, 1.1), (0.9, 0.9), (1.3, 1.3), (0, 0)))[0] - wanted * 255).max() <= 1.2
