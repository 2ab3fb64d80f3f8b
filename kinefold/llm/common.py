"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Upper bound of UTF-8 bytes that one numpy step inside a task works on.
SLICE_BYTES = 8 << 20

_own_dir: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is ``spark.checkpoint.dir`` of the session.  Where that is unset in local mode
    (tests) one temporary folder is made for the application; on a cluster, whose
    executors wouldn't see it, an error is raised.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(_own_dir[app])
    return _own_dir[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def publish(df: DataFrame, label: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    This cuts the lineage: a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    (df.write.option("compression", compression) if compression else df.write).mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new_path`."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Published tables that are deleted together once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def publish(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(new_path(self.spark, label))
        return publish(df, label, self.paths[-1])

    def remove(self) -> None:
        while self.paths:
            remove(self.spark, self.paths.pop())


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take about ``limit`` bytes; a longer text stands alone."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n + 1
    if batch.num_rows > start:
        yield batch.slice(start)


def vocabulary(name: str) -> str:
    """``name`` is a file or the name of an installed public tokenizer."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def free_names(taken: list[str], wanted: list[str]) -> list[str]:
    """The wanted column names, with underscores in front where a column has the name in any case variant."""
    held, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        out.append(name)
    return out


def runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of equal keys."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    begin = np.flatnonzero(change)
    return begin, np.append(begin[1:], len(keys[0]))


def grouped(keys: list[str], each: Callable[[list[np.ndarray], pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """A mapInArrow function over sorted rows: ``each`` gets whole groups of rows with equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None or not held.num_rows else pa.concat_tables([held, now])
            cols = [held.column(k).to_numpy() for k in keys]
            begin, _ = runs(cols)
            cut = int(begin[-1])
            if cut:
                yield from each([c[:cut] for c in cols], held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from each([held.column(k).to_numpy() for k in keys], held.combine_chunks())

    return run
