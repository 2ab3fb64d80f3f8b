"""Queries on images, masks and backgrounds, over the small images of the vector frames."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.draws import between_sql, integer_sql, rounded, rounded_sql, uniform_sql
from ..operators import background, images as im, masks as mk, planning, selection
from ..plans import export, jobs
from ..plans.recipes import resolve
from ..sources import datasets
from ..sources.fixtures import IMAGE_SIZE, IMAGES, VECTOR_FRAMES, images, vector_frames
from ..sources.scratch import scratch_path
from . import sql

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
THRESHOLD = 140
HARD = 185


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, text)
        return f

    return add


def mean_mask(threshold: float):
    return lambda x: mk.brightness_mask(x, threshold, clean=False)


def checksums(df: DataFrame, channels: int = 3, *more: str) -> DataFrame:
    """A weighted sum of each image's bytes."""
    rows = im.pixels_long(df, channels)
    weight = F.col("y") * 24 + F.col("x") * 3 + F.col("ch") + 1
    return rows.groupBy("episode_index", "frame_index", *more).agg(F.sum(F.col("level") * weight).alias("checksum"), F.sum("level").alias("total"))


SUMS = "sum(level*(y*24 + x*3 + ch + 1))::BIGINT AS checksum, sum(level)::BIGINT AS total"
BASE = f"WITH {IMAGES}"


def mask_sql(threshold: int, name: str = "bright") -> str:
    return f"{name} AS (SELECT episode_index, frame_index, y, x, CASE WHEN sum(level)/3.0::DOUBLE > {threshold} THEN 1 ELSE 0 END AS m FROM pixels GROUP BY 1, 2, 3, 4)"


def covers_sql(name: str = "bright") -> str:
    return f"covers AS (SELECT episode_index, frame_index, avg(m::DOUBLE) AS coverage FROM {name} GROUP BY 1, 2)"


def _sums(level: str, tables: str = "pixels", where: str = "") -> str:
    return f"SELECT episode_index, frame_index, {SUMS} FROM (SELECT episode_index, frame_index, y, x, ch, ({level})::BIGINT AS level FROM {tables} {where}) GROUP BY 1, 2"


@query(BASE + " " + _sums("level"))
def a2_load_images(spark, sf_dir):
    path = scratch_path(spark, "images")
    images(spark, sf_dir).write.parquet(path)
    return checksums(datasets.read_images(spark, path))


@query(BASE + f" SELECT episode_index, frame_index, {SUMS} FROM (SELECT episode_index, frame_index, y, 7 - x AS x, ch, level FROM pixels) GROUP BY 1, 2")
def h6_image_flip(spark, sf_dir):
    return checksums(im.flip(images(spark, sf_dir)))


@query()
def h7_color_jitter(spark, sf_dir):
    return checksums(im.color_jitter(images(spark, sf_dir)))


@query()
def h8_gaussian_blur(spark, sf_dir):
    return checksums(im.gaussian_blur(images(spark, sf_dir)))


@query()
def h9_sharpness(spark, sf_dir):
    return checksums(im.sharpen(images(spark, sf_dir)))


def _rect(scale: tuple, aspect: tuple, *key: str) -> str:
    area, ratio = f"64*{between_sql(*scale, *key, "'area'")}", between_sql(*aspect, *key, "'aspect'")
    return f"least(round_even(sqrt(({area})*({ratio})), 0)::BIGINT, 8) AS rect_h, least(round_even(sqrt(({area})/({ratio})), 0)::BIGINT, 8) AS rect_w"


def _corner(*key: str) -> str:
    return f"{integer_sql('(8 - rect_h)', *key, "'top'")} AS rect_top, {integer_sql('(8 - rect_w)', *key, "'left'")} AS rect_left"


_ERASE = ("'42'", "episode_index", "frame_index", "'top'", "'erase'")
_RANDOM = f"sized AS (SELECT episode_index, frame_index, {_rect((0.02, 0.15), (0.3, 3.3), *_ERASE)} FROM vectors), placed AS (SELECT *, {_corner(*_ERASE)}, CASE WHEN {uniform_sql(*_ERASE, "'p'")} < 0.5 THEN rect_h ELSE 0 END AS used_h FROM sized)"


@query(BASE + f", {_RANDOM} " + _sums("CASE WHEN y >= rect_top AND y < rect_top + used_h AND x >= rect_left AND x < rect_left + rect_w THEN 0 ELSE level END", "pixels JOIN placed USING (episode_index, frame_index)"))
def h10_random_erasing(spark, sf_dir):
    return checksums(im.erase(im.random_rectangles(images(spark, sf_dir))))


_STATIC = ("'42'", "segment", "episode_index", "'static'")


@query(
    f"WITH {VECTOR_FRAMES}, plan AS (SELECT DISTINCT episode_index, p AS segment FROM vectors, (SELECT unnest(range(3)) AS p) ps), sized AS (SELECT *, {_rect((0.02, 0.15), (0.5, 2.0), *_STATIC)} FROM plan)"
    + f" SELECT segment::BIGINT AS segment, episode_index, rect_h, rect_w, {_corner(*_STATIC)} FROM sized"
)
def h11_static_erasing(spark, sf_dir):
    plan = planning.build_plan(datasets.episodes(vector_frames(spark, sf_dir)), planning.Temporal(num_passes=3))
    return im.static_rectangles(plan, IMAGE_SIZE, IMAGE_SIZE).select(F.col("segment").cast("long").alias("segment"), "episode_index", "rect_h", "rect_w", "rect_top", "rect_left")


def _lengths(spark, sf_dir) -> DataFrame:
    every = datasets.episodes(vector_frames(spark, sf_dir))
    return every.select(F.lit(0).alias("segment"), "episode_index", F.lit("top").alias("camera"), F.col("length").cast("int").alias("usable_len"))


@query()
def e7_blob_path(spark, sf_dir):
    return im.blob_paths(_lengths(spark, sf_dir), IMAGE_SIZE, IMAGE_SIZE, 3, 0.5)


@query()
def h12_blob_painting(spark, sf_dir):
    path = im.blob_paths(_lengths(spark, sf_dir), IMAGE_SIZE, IMAGE_SIZE, 3, 0.5)
    return checksums(im.paint_blob(images(spark, sf_dir).join(path, ["episode_index", "frame_index", "camera"]), 3))


def _mask_pixels(found: DataFrame) -> DataFrame:
    return found.select("episode_index", "frame_index", "w", F.col("mask").alias("pixels"))


@query(BASE + f", {mask_sql(THRESHOLD)} SELECT episode_index, frame_index, sum(m)::BIGINT AS bright, sum(m*(y*24 + x*3 + 1))::BIGINT AS checksum FROM bright GROUP BY 1, 2")
def h13_brightness_mask(spark, sf_dir):
    found = mk.predict(images(spark, sf_dir), mean_mask(THRESHOLD))
    return checksums(_mask_pixels(found), 1).select("episode_index", "frame_index", F.col("total").alias("bright"), "checksum")


@query(BASE + f", {mask_sql(HARD)}, {covers_sql()} SELECT episode_index, frame_index, {rounded_sql('coverage')} AS coverage, coverage < 0.01::DOUBLE OR coverage > 0.80::DOUBLE AS bad FROM covers")
def h14_mask_coverage(spark, sf_dir):
    found = mk.predict(images(spark, sf_dir), mean_mask(HARD))
    return found.select("episode_index", "frame_index", rounded(F.col("coverage")).alias("coverage"), mk.bad(F.col("coverage")).alias("bad"))


@query()
def h15_feathered_mask(spark, sf_dir):
    def soft(x: np.ndarray) -> np.ndarray:
        return np.rint(mk.feathered(mk.brightness_mask(x, THRESHOLD), 2) * 255)

    return checksums(_mask_pixels(mk.predict(images(spark, sf_dir), soft)), 1)


_PICKS = f"picks AS (SELECT episode_index, frame_index, CASE WHEN frame_index > 0 THEN frame_index - 1 - {integer_sql('(least(frame_index, 24) - 1)', "'42'", 'episode_index', "'top'", 'frame_index', "'background'")} ELSE frame_index END AS bg_frame FROM vectors)"


@query(f"WITH {VECTOR_FRAMES}, {_PICKS} SELECT episode_index, frame_index, bg_frame FROM picks")
def c8_background_pick(spark, sf_dir):
    return background.picks(images(spark, sf_dir)).select("episode_index", "frame_index", "bg_frame")


_ENTRY = f"""
seeded AS (
  SELECT v.episode_index, v.frame_index, p.segment, p.prev_episode, q.step AS prev_step, CASE WHEN q.length IS NULL THEN 0 ELSE least(ceil(q.length/q.step::DOUBLE)::BIGINT, 20) END AS seeds
  FROM vectors v JOIN (SELECT segment, episode_index, lag(episode_index) OVER (PARTITION BY segment ORDER BY episode_index) AS prev_episode FROM (SELECT DISTINCT episode_index FROM vectors), (SELECT unnest(range(2)) AS segment) s) p USING (episode_index)
  LEFT JOIN (SELECT episode_index AS prev_episode, count(*) AS length, greatest(1, count(*) // 20) AS step FROM vectors GROUP BY 1) q USING (prev_episode)),
entries AS (SELECT *, frame_index + seeds AS total, frame_index + seeds - 1 - {integer_sql("(least(frame_index + seeds, 24) - 1)", "'42'", "segment", "episode_index", "'top'", "frame_index", "'seeded'")} AS entry FROM seeded)"""


@query(
    f"WITH {VECTOR_FRAMES}, {_ENTRY} SELECT segment::BIGINT AS segment, episode_index, frame_index, CASE WHEN total = 0 OR entry >= seeds THEN episode_index ELSE prev_episode END AS bg_episode, (CASE WHEN total = 0 THEN frame_index WHEN entry >= seeds THEN entry - seeds ELSE entry*prev_step END)::BIGINT AS bg_frame FROM entries"
)
def c9_seeded_background(spark, sf_dir):
    every = datasets.episodes(vector_frames(spark, sf_dir))
    previous = background.previous_episodes(planning.build_plan(every, planning.Temporal(num_passes=2)))
    found = background.seeded_picks(images(spark, sf_dir), every, previous, 24, 20)
    return found.select(F.col("segment").cast("long").alias("segment"), "episode_index", "frame_index", "bg_episode", "bg_frame")


_FAN = ("'42'", "episode_index", "'top'", "frame_index")


@query(
    f"WITH {VECTOR_FRAMES}, drawn AS (SELECT episode_index, frame_index, {integer_sql(39, *_FAN, "'first'")} AS one, {integer_sql(38, *_FAN, "'second'")} AS two FROM vectors)"
    + " SELECT episode_index, frame_index, 0::BIGINT AS pick, one AS bg_index FROM drawn UNION ALL SELECT episode_index, frame_index, 1::BIGINT, CASE WHEN two >= one THEN two + 1 ELSE two END FROM drawn"
)
def c10_background_fan_out(spark, sf_dir):
    return background.fan_out(images(spark, sf_dir), 40).select("episode_index", "frame_index", F.col("pick").cast("long").alias("pick"), "bg_index")


@query(BASE + f", {mask_sql(THRESHOLD)}, {_PICKS} " + _sums("CASE WHEN m = 1 THEN p.level ELSE b.level END", "(SELECT p.episode_index, p.frame_index, p.y, p.x, p.ch, m, p.level, bg_frame FROM pixels p JOIN bright USING (episode_index, frame_index, y, x) JOIN picks USING (episode_index, frame_index)) p").replace("FROM (SELECT episode_index, frame_index, y, x, ch,", "FROM (SELECT p.episode_index, p.frame_index, p.y, p.x, p.ch,").replace(") p )", ") p JOIN pixels b ON b.episode_index = p.episode_index AND b.frame_index = p.bg_frame AND b.y = p.y AND b.x = p.x AND b.ch = p.ch)"))
def h16_composite(spark, sf_dir):
    shots = images(spark, sf_dir)
    return checksums(background.on_backgrounds(shots, mk.predict(shots, mean_mask(THRESHOLD)), background.picks(shots), feather=0))


@query(BASE + " " + _sums("floor(least(greatest(level/255.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE)*255.0::DOUBLE)"))
def h17_pixel_conversion(spark, sf_dir):
    return checksums(im.apply(images(spark, sf_dir), lambda x, _: im.from_unit(im.to_unit(x))))


@query(BASE + f", {mask_sql(THRESHOLD)} SELECT episode_index, frame_index, (CASE WHEN frame_index % 2 = 0 THEN sum(m)*3*255 ELSE 0 END)::BIGINT AS total, 192::BIGINT AS bytes FROM bright GROUP BY 1, 2")
def h18_mask_images(spark, sf_dir):
    shots = images(spark, sf_dir)
    masks = mk.mask_rgb(mk.predict(shots.where("frame_index % 2 = 0"), mean_mask(THRESHOLD)))
    full = mk.with_declared(shots, masks)
    return checksums(full).join(full.select("episode_index", "frame_index", F.length("pixels").cast("long").alias("bytes")), ["episode_index", "frame_index"]).select("episode_index", "frame_index", "total", "bytes")


_EDGE = "x BETWEEN frame_index % 3 AND frame_index % 3 + 4 AND y BETWEEN frame_index % 2 AND frame_index % 2 + 5 AND (x = frame_index % 3 OR x = frame_index % 3 + 4 OR y = frame_index % 2 OR y = frame_index % 2 + 5)"


@query(BASE + " " + _sums(f"CASE WHEN {_EDGE} THEN CASE WHEN ch = 1 THEN 255 ELSE 0 END ELSE level END"))
def h19_box_overlay(spark, sf_dir):
    shots = images(spark, sf_dir)
    i = F.col("frame_index")
    boxes = shots.select("episode_index", "frame_index", "camera", (i % 3).cast("double").alias("x0"), (i % 2).cast("double").alias("y0"), (i % 3 + 4).cast("double").alias("x1"), (i % 2 + 5).cast("double").alias("y1"))
    return checksums(im.boxed(shots, boxes, width=1))


def regions(shots: DataFrame) -> DataFrame:
    """Three regions of each image: where a channel is bright."""

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                x = np.frombuffer(r.pixels, np.uint8).reshape(r.h, r.w, r.c)
                for k in range(3):
                    m = (x[..., k] > 150).astype(np.uint8)
                    area = int(m.sum())
                    rows.append((r.episode_index, r.frame_index, r.camera, k, area, None if k == 1 else 0.5 + area % 50 / 100, m.tobytes()))
            yield pd.DataFrame(rows, columns=["episode_index", "frame_index", "camera", "region_id", "area", "predicted_iou", "pixels"])

    return shots.mapInPandas(run, "episode_index long, frame_index long, camera string, region_id int, area long, predicted_iou double, pixels binary")


_REGIONS = """spots AS (SELECT episode_index, frame_index, ch AS region_id, y, x, CASE WHEN level > 150 THEN 1 ELSE 0 END AS m FROM pixels),
regions AS (SELECT *, CASE WHEN region_id = 1 THEN NULL ELSE 0.5::DOUBLE + area % 50/100.0::DOUBLE END AS predicted_iou FROM (SELECT episode_index, frame_index, region_id, sum(m)::BIGINT AS area FROM spots GROUP BY 1, 2, 3)),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode_index, frame_index ORDER BY area DESC, region_id) AS k FROM regions) WHERE k <= 2 AND coalesce(predicted_iou, 1.0::DOUBLE) >= 0.6)"""


@query(BASE + f", {_REGIONS} SELECT episode_index, frame_index, region_id::BIGINT AS region_id, area FROM kept")
def f3_top_regions(spark, sf_dir):
    return mk.top_regions(regions(images(spark, sf_dir)), 2, 0.6).select("episode_index", "frame_index", F.col("region_id").cast("long").alias("region_id"), "area")


@query(BASE + f", {_REGIONS} SELECT episode_index, frame_index, sum(m)::BIGINT AS covered, {rounded_sql('avg(m::DOUBLE)')} AS coverage FROM (SELECT episode_index, frame_index, y, x, max(m) AS m FROM spots JOIN kept USING (episode_index, frame_index, region_id) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2")
def d16_mask_union(spark, sf_dir):
    found = mk.union(mk.top_regions(regions(images(spark, sf_dir)), 2, 0.6))
    return found.select("episode_index", "frame_index", F.round(F.col("coverage") * 64).cast("long").alias("covered"), rounded(F.col("coverage")).alias("coverage"))


_WALK = """walk AS (
  SELECT episode_index, frame_index, CASE WHEN good THEN frame_index END AS last, CASE WHEN good THEN 'predicted' ELSE 'fallback' END AS kind FROM judged WHERE frame_index = 0
  UNION ALL
  SELECT j.episode_index, j.frame_index, CASE WHEN (w.last IS NULL OR j.frame_index - w.last >= 5) AND j.good THEN j.frame_index ELSE w.last END,
         CASE WHEN w.last IS NULL OR j.frame_index - w.last >= 5 THEN CASE WHEN j.good THEN 'predicted' ELSE 'fallback' END ELSE 'cached' END
  FROM walk w JOIN judged j ON j.episode_index = w.episode_index AND j.frame_index = w.frame_index + 1)"""
_REUSE = f"WITH RECURSIVE {IMAGES}, {mask_sql(HARD)}, {covers_sql()}, judged AS (SELECT *, coverage >= 0.01::DOUBLE AND coverage <= 0.80::DOUBLE AS good FROM covers), {_WALK}"


@query(_REUSE + " SELECT episode_index, frame_index, last AS mask_src, kind FROM walk")
def e6_mask_reuse(spark, sf_dir):
    return mk.sources(mk.predict(images(spark, sf_dir), mean_mask(HARD)), 5).select("episode_index", "frame_index", "mask_src", "kind")


@query(_REUSE + f" SELECT episode_index, count(*) AS frames, sum((kind = 'predicted')::INT)::BIGINT AS calls, sum((kind = 'cached')::INT)::BIGINT AS cache_hits, sum((kind = 'fallback')::INT)::BIGINT AS fallbacks, {rounded_sql('avg(coverage)')} AS avg_coverage FROM walk JOIN covers USING (episode_index, frame_index) GROUP BY 1")
def d15_mask_statistics(spark, sf_dir):
    found = mk.predict(images(spark, sf_dir), mean_mask(HARD))
    both = mk.sources(found, 5).join(found.select(*mk.KEY, "coverage"), list(mk.KEY))
    return mk.statistics(both).withColumn("avg_coverage", rounded(F.col("avg_coverage")))


@query()
def b8_background_pool(spark, sf_dir):
    frames = vector_frames(spark, sf_dir)
    pool = selection.evenly(frames, datasets.episodes(frames), 20).select("episode_index", "frame_index", "pool_index")
    return pool.join(checksums(images(spark, sf_dir)), ["episode_index", "frame_index"])


@query()
def k3_augment_images_job(spark, sf_dir):
    recipe = resolve("v7", prefilter=False, num_passes=1, augmentations=("color_jitter", "gaussian_blur", "sharpness", "random_erasing", "static_erasing", "horizontal_flip"))
    frames = vector_frames(spark, sf_dir)
    made = jobs.augment_job(frames, recipe)
    return checksums(jobs.augment_images_job(images(spark, sf_dir), made, recipe), 3, "segment")


@query()
def k3_composite_images_job(spark, sf_dir):
    recipe = resolve("v9", prefilter=False, num_passes=1, feather=1)
    frames = vector_frames(spark, sf_dir)
    made = jobs.augment_job(frames, recipe)
    return checksums(jobs.augment_images_job(images(spark, sf_dir), made, recipe), 3, "segment")


_USED = f"""{mask_sql(THRESHOLD, 'soft')}, plain AS (SELECT episode_index, frame_index, avg(m::DOUBLE) AS coverage FROM soft GROUP BY 1, 2),
used AS (SELECT w.episode_index, w.frame_index, w.kind, CASE WHEN w.last IS NULL THEN p.coverage ELSE c.coverage END AS coverage
         FROM walk w JOIN plain p USING (episode_index, frame_index) LEFT JOIN covers c ON c.episode_index = w.episode_index AND c.frame_index = w.last)"""


@query(
    _REUSE
    + f", {_USED} SELECT episode_index, count(*) AS frames, sum((kind = 'predicted')::INT)::BIGINT AS calls, sum((kind = 'cached')::INT)::BIGINT AS cache_hits, sum((kind = 'fallback')::INT)::BIGINT AS fallbacks, {rounded_sql('avg(coverage)')} AS avg_coverage FROM used GROUP BY 1"
)
def d15_used_mask_statistics(spark, sf_dir):
    """Of the masks that frames get, as jobs report them; short blocks show that sequences are walked in parts."""
    found = mk.reused(images(spark, sf_dir), mean_mask(HARD), 5, mean_mask(THRESHOLD), block=20)
    return mk.statistics(found).withColumn("avg_coverage", rounded(F.col("avg_coverage")))


@query(_REUSE + " SELECT episode_index, frame_index, last AS mask_src, kind FROM walk")
def e6_mask_reuse_in_blocks(spark, sf_dir):
    return mk.reused(images(spark, sf_dir), mean_mask(HARD), 5, mean_mask(THRESHOLD), block=10).select("episode_index", "frame_index", "mask_src", "kind")


_BOXED = resolve("v7", prefilter=False, num_passes=2, smoothing=False, action_noise_std=0.0, augmentations=("background", "horizontal_flip"), box_overlay=True)
_IN_BOX = "segment >= 0 AND x BETWEEN src_frame % 3 AND src_frame % 3 + 4 AND y BETWEEN src_frame % 2 AND src_frame % 2 + 5"
_OUTPUT = f"WITH {IMAGES}, frames AS (SELECT episode_index, frame_index, NULL::VARCHAR AS task, action, state FROM vectors), {sql.EPISODES}, {sql.plan(_BOXED.temporal())}, {sql.POSITIONS}, {sql.RESAMPLED}"


@query(
    _OUTPUT
    + f", drawn AS (SELECT segment, output_order, out_idx, y, CASE WHEN segment >= 0 THEN 7 - x ELSE x END AS x, ch, CASE WHEN {_IN_BOX} THEN CASE WHEN ch = 1 THEN 255 ELSE 0 END ELSE level END AS level"
    + f" FROM made JOIN pixels p ON p.episode_index = made.episode_index AND p.frame_index = made.src_frame) SELECT segment::BIGINT AS segment, output_order::BIGINT AS episode_index, out_idx::BIGINT AS frame_index, {SUMS} FROM drawn GROUP BY 1, 2, 3"
)
def k3_flip_and_boxes_images_job(spark, sf_dir):
    """The image job in listed order: flip first, then boxes of source frames, mirrored with them; originals stay."""
    shots = images(spark, sf_dir)
    i = F.col("frame_index")
    boxes = shots.select("episode_index", "frame_index", "camera", (i % 3).cast("double").alias("x0"), (i % 2).cast("double").alias("y0"), (i % 3 + 4).cast("double").alias("x1"), (i % 2 + 5).cast("double").alias("y1"))
    made = jobs.augment_job(vector_frames(spark, sf_dir), _BOXED)
    return checksums(jobs.augment_images_job(shots, made, _BOXED, boxes), 3, "segment").withColumn("segment", F.col("segment").cast("long"))


@query()
def a6_declared_features(spark, sf_dir):
    """Frames of a composed dataset under their declared features: bytes of the mask feature, and covered pixels."""
    recipe = resolve("v9", prefilter=False, num_passes=1, feather=1)
    made = jobs.augment_job(vector_frames(spark, sf_dir), recipe)
    rows = export.with_features(made.frames, jobs.images_job(images(spark, sf_dir), made, recipe).images)
    covered = (F.length(F.regexp_replace(F.hex("mask_top"), "00", "")) / 6).cast("long")
    return rows.select("episode_index", "frame_index", F.octet_length("mask_top").cast("long").alias("mask_bytes"), covered.alias("covered"))
