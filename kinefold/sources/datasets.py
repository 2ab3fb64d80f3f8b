"""Trajectory datasets: schemas, episodes, readers and writers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX_COLUMNS = ("timestamp", "index", "episode_index", "frame_index", "task_index")
DEFAULT_TASK = "robot manipulation"

_VECTOR = T.ArrayType(T.DoubleType())
FRAMES = T.StructType(
    [
        T.StructField("episode_index", T.LongType()),
        T.StructField("frame_index", T.LongType()),
        T.StructField("index", T.LongType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("task", T.StringType()),
        T.StructField("action", _VECTOR),
        T.StructField("state", _VECTOR),
    ]
)
IMAGES = T.StructType(
    [
        *[T.StructField(name, T.LongType()) for name in ("episode_index", "frame_index")],
        T.StructField("camera", T.StringType()),
        *[T.StructField(name, T.IntegerType()) for name in ("h", "w", "c")],
        T.StructField("pixels", T.BinaryType()),
    ]
)


def read_frames(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Frames with their declared schema; only the columns asked for are read."""
    frames = spark.read.schema(FRAMES).parquet(path)
    return frames.select(*columns) if columns else frames


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IMAGES).parquet(path)


def loose_images(spark: SparkSession, path: str, h: int, w: int, c: int = 3) -> DataFrame:
    """Raw files named <episode>_<frame>_<camera>.raw as images, all files among them.

    A file of another size has null pixels, one of another name null keys too; reason says so, and is null for the rest.
    """
    part = lambda k: F.nullif(F.regexp_extract("path", r"(\d+)_(\d+)_([^/]+)\.raw$", k), F.lit(""))
    files = spark.read.format("binaryFile").load(path)
    fits = F.col("length") == h * w * c
    reason = F.when(part(1).isNull(), F.concat(F.lit("not <episode>_<frame>_<camera>.raw: "), F.col("path"))).when(~fits, F.format_string(f"%d bytes, not {h} x {w} x {c}", "length"))
    return files.select(
        *(part(k).cast("long").alias(name) for k, name in ((1, "episode_index"), (2, "frame_index"))),
        part(3).alias("camera"),
        *(F.lit(v).alias(name) for name, v in (("h", h), ("w", w), ("c", c))),
        F.when(fits & part(1).isNotNull(), F.col("content")).alias("pixels"),
        reason.alias("reason"),
    )


def read_loose_images(spark: SparkSession, path: str, h: int, w: int, c: int = 3) -> DataFrame:
    """The sound images of :func:`loose_images`, which tells of the other files."""
    return loose_images(spark, path, h, w, c).where("reason is null").drop("reason")


def episodes(frames: DataFrame) -> DataFrame:
    """One row per episode with its length; partial counts travel, never the frames."""
    return frames.groupBy("episode_index").agg(F.count("*").alias("length"))


def episode_ranges(frames: DataFrame) -> DataFrame:
    """Half-open ranges of the running index, for frames that have one."""
    return frames.groupBy("episode_index").agg(F.min("index").alias("dataset_from_index"), (F.max("index") + 1).alias("dataset_to_index"), F.count("*").alias("length"))


def output_schema(source: T.StructType, mask_cameras: Iterable[str] | Mapping[str, tuple[int, int]] = (), size: tuple[int, int] = (480, 640)) -> T.StructType:
    """Declared output features: the source's without index columns, and a mask of height x width x 3 for each camera.

    Cameras may come with their own sizes.  Keys are a union in order, without repeats.
    """
    fields = {f.name: f for f in source.fields if f.name not in INDEX_COLUMNS}
    sizes = mask_cameras if isinstance(mask_cameras, Mapping) else {camera: size for camera in mask_cameras}
    for camera, shape in sizes.items():
        name = mask_feature(camera)
        fields.setdefault(name, T.StructField(name, T.BinaryType(), True, {"dtype": "video", "shape": [*shape, 3], "names": ["height", "width", "channel"]}))
    return T.StructType([*fields.values()])


def mask_feature(camera: str) -> str:
    """The mask's name for a camera, of which the last part counts."""
    return f"mask_{camera.rsplit('.', 1)[-1]}"


def output_frames(frames: DataFrame) -> DataFrame:
    """The columns that an output frame has: no index columns, a default task, scalars as arrays of one."""
    kept = [f for f in frames.schema.fields if f.name not in INDEX_COLUMNS and f.name != "task"]
    columns = [F.array(f.name).alias(f.name) if f.metadata.get("shape") == [1] and not isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in kept]
    task = F.coalesce(F.col("task"), F.lit(DEFAULT_TASK)) if "task" in frames.columns else F.lit(DEFAULT_TASK)
    return frames.select(task.alias("task"), *columns)


def write_frames(frames: DataFrame, path: str, force: bool = False, buckets: int | None = None, run: int = 65_536) -> None:
    """Write frames by episode, in frame order; without ``force`` an earlier output is an error.

    Episodes are dealt to files by a hash, and a long one is cut into runs of frames, so that no file holds
    an episode without bound.
    """
    cut = F.floor(F.col("frame_index") / run)
    dealt = frames.repartition(*([buckets] if buckets else []), "episode_index", cut)
    dealt.sortWithinPartitions("episode_index", "frame_index").write.mode("overwrite" if force else "errorifexists").parquet(path)


def write_images(images: DataFrame, path: str, force: bool = False) -> None:
    """Write images, and their masks if there are any, like frames, in shorter runs."""
    write_frames(images, path, force, run=256)


def write_scores(scores: DataFrame, path: str, force: bool = False) -> None:
    """The score report as JSON lines, nulls included."""
    scores.write.mode("overwrite" if force else "errorifexists").option("ignoreNullFields", "false").json(path)
