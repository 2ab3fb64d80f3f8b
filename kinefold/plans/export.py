"""Writing augmented datasets under their declared features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.masks import mask_rgb
from ..sources.datasets import INDEX_COLUMNS, mask_feature, output_schema, read_images, write_frames, write_images
from .jobs import Augmented, AugmentedImages


def declared(frames: DataFrame, images: DataFrame) -> tuple[T.StructType, dict[str, tuple[int, int]]]:
    """The features of the output: index columns, those of the frames, and a mask for each camera if images have masks.

    A camera's size is its images' largest; one row per camera is collected.
    """
    sizes = {}
    if "mask" in images.columns:
        rows = images.groupBy("camera").agg(F.max("h").alias("h"), F.max("w").alias("w")).where("camera is not null").orderBy("camera").collect()
        sizes = {r["camera"]: (r["h"], r["w"]) for r in rows}
    index = [f for f in frames.schema.fields if f.name in INDEX_COLUMNS]
    return T.StructType([*index, *output_schema(frames.schema, sizes).fields]), sizes


def with_features(frames: DataFrame, images: DataFrame) -> DataFrame:
    """Frames under their declared features: masks as images of three channels by camera, zeros where a frame has none.

    Masks come by one aggregation over (episode, frame), as wide as there are cameras; other columns of frames are dropped.
    """
    schema, sizes = declared(frames, images)
    if sizes:
        rgb = mask_rgb(images.where("mask is not null"))
        wide = rgb.groupBy("episode_index", "frame_index").agg(*(F.first(F.when(F.col("camera") == camera, F.col("pixels")), ignorenulls=True).alias(f"_{mask_feature(camera)}") for camera in sizes))
        frames = frames.join(wide, ["episode_index", "frame_index"], "left")
        for camera, (h, w) in sizes.items():
            name = mask_feature(camera)
            frames = frames.withColumn(name, F.coalesce(f"_{name}", F.unhex(F.repeat(F.lit("00"), F.lit(h * w * 3)))))
    # writers keep the metadata of named columns, not that of a schema alone
    return frames.to(schema).select(*(F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema))


def export_job(augmented: Augmented, made: AugmentedImages, path: str, force: bool = False) -> T.StructType:
    """Write frames with their features, images, and the masks' statistics if there are any; returns the declared features.

    Without ``force`` an earlier output is an error, and nothing is written.
    """
    frames = with_features(augmented.frames, made.images)
    write_frames(frames, f"{path}/frames", force)
    write_images(made.images.drop("mask"), f"{path}/images", force)
    if made.mask_statistics is not None:
        made.mask_statistics.write.mode("overwrite" if force else "errorifexists").parquet(f"{path}/mask_statistics")
    return frames.schema


def read_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Frames and images of :func:`export_job`, frames with the features that were declared."""
    return spark.read.parquet(f"{path}/frames"), read_images(spark, f"{path}/images")
