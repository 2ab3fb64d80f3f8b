"""Trajectory-shaped views over the supplied tables, the same in Spark and DuckDB.

Each view is a function of the table folder on the Spark side, and the text of a
common table expression on the DuckDB side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FPS = 50
ACTION_DIMS = 14
IMAGE_SIZE = 8


def _view(spark: SparkSession, sf_dir: str, name: str, query: str) -> DataFrame:
    return spark.sql(query, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet")})


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as episodes, their events as frames of 14 dimensions."""
    low = [f"round(value/1000.0D*({d}+1.0D)/7.0D, 6)" for d in range(7)]
    high = [f"round(((event_id*({d}+3)) % 97)/970.0D, 6)" for d in range(7, ACTION_DIMS)]
    return _view(
        spark, sf_dir, "events",
        f"""
        SELECT episode_index, frame_index, frame_index/{FPS}.0D AS timestamp, task, action,
               transform(action, x -> 0.9D*x + 0.01D) AS state
        FROM (SELECT user_id AS episode_index, event_type AS task,
                     row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1L AS frame_index,
                     array({", ".join(low + high)}) AS action
              FROM {{events}})""",
    )


EVENT_FRAMES = f"""frames AS (
  SELECT episode_index, frame_index, frame_index/{FPS}.0::DOUBLE AS timestamp, task, action,
         list_transform(action, lambda x: 0.9::DOUBLE*x + 0.01::DOUBLE) AS state
  FROM (SELECT user_id AS episode_index, event_type AS task,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame_index,
               list_concat(
                 list_transform(range(0, 7), lambda d: round("value"/1000.0::DOUBLE*(d+1.0::DOUBLE)/7.0::DOUBLE, 6)),
                 list_transform(range(7, {ACTION_DIMS}), lambda d: round(((event_id*(d+3)) % 97)/970.0::DOUBLE, 6))) AS action
        FROM events))"""


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as episodes, their vectors as frames with a small image."""
    return _view(
        spark, sf_dir, "embeddings",
        """
        SELECT CAST(label AS BIGINT) AS episode_index,
               row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1L AS frame_index,
               slice(e, 1, 14) AS action, slice(e, 15, 14) AS state, e
        FROM (SELECT label, vec_id, transform(embedding, x -> CAST(x AS DOUBLE)) AS e FROM {embeddings})""",
    )


VECTOR_FRAMES = """vectors AS (
  SELECT label::BIGINT AS episode_index,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index,
         e[1:14] AS action, e[15:28] AS state, e
  FROM (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings))"""


def _pixel(y: int, x: int, channel: int, base: int) -> int:
    return (IMAGE_SIZE * y + x + 7 * channel) % 64 + base


def images(spark: SparkSession, sf_dir: str, camera: str = "top") -> DataFrame:
    """One raw 8 x 8 x 3 image per vector frame."""
    levels = F.transform("e", lambda v: F.floor((F.least(F.greatest(v, F.lit(-0.5)), F.lit(0.5)) + 0.5) * 255).cast("int"))
    order = [_pixel(y, x, c, 0) for y in range(IMAGE_SIZE) for x in range(IMAGE_SIZE) for c in range(3)]
    letters = F.transform(F.array(*[F.lit(i) for i in order]), lambda i: F.lpad(F.hex(F.col("levels")[i]), 2, "0"))
    framed = vector_frames(spark, sf_dir).select("episode_index", "frame_index", levels.alias("levels"))
    size = F.lit(IMAGE_SIZE)
    return framed.select("episode_index", "frame_index", F.lit(camera).alias("camera"), size.alias("h"), size.alias("w"), F.lit(3).alias("c"), F.unhex(F.concat_ws("", letters)).alias("pixels"))


IMAGES = VECTOR_FRAMES + """, pixels AS (
  SELECT episode_index, frame_index, y, x, ch,
         floor((least(greatest(e[((8*y + x + 7*ch) % 64) + 1], -0.5::DOUBLE), 0.5::DOUBLE) + 0.5::DOUBLE) * 255)::BIGINT AS level
  FROM vectors, (SELECT unnest(range(8)) AS y) ys, (SELECT unnest(range(8)) AS x) xs, (SELECT unnest(range(3)) AS ch) cs)"""


def supplier_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as longer episodes of four dimensions."""
    return _view(
        spark, sf_dir, "lineitem",
        """
        SELECT episode_index, frame_index, action, transform(action, x -> 0.9D*x) AS state
        FROM (SELECT l_suppkey AS episode_index,
                     row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1L AS frame_index,
                     array(l_quantity/50.0D, l_extendedprice/100000.0D, l_discount*10.0D, l_tax*10.0D) AS action
              FROM {lineitem})""",
    )


SUPPLIER_FRAMES = """suppliers AS (
  SELECT episode_index, frame_index, action, list_transform(action, lambda x: 0.9::DOUBLE*x) AS state
  FROM (SELECT l_suppkey AS episode_index,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS frame_index,
               [l_quantity/50.0::DOUBLE, l_extendedprice/100000.0::DOUBLE, l_discount*10.0::DOUBLE, l_tax*10.0::DOUBLE] AS action
        FROM lineitem))"""
