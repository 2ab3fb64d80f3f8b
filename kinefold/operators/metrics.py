"""Motion metrics of episodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import distance_sum
from .groups import in_groups
from .spectra import arc_lengths


def in_order() -> WindowSpec:
    return Window.partitionBy("episode_index").orderBy("frame_index")


def differences(frames: DataFrame, vector: str = "action") -> DataFrame:
    """Add first and second differences (null where there are too few frames before)."""
    one, two = F.lag(vector, 1).over(in_order()), F.lag(vector, 2).over(in_order())
    first = F.zip_with(vector, one, lambda x, y: x - y)
    second = F.zip_with(F.zip_with(vector, one, lambda x, y: x - 2.0 * y), two, lambda x, y: x + y)
    return frames.withColumn("d1", first).withColumn("d2", F.when(two.isNotNull(), second))


def gradient(frames: DataFrame, vector: str = "state", fps: float = 50.0) -> DataFrame:
    """Add velocity: central differences inside, one-sided at the ends, times fps."""
    before, after = F.lag(vector).over(in_order()), F.lead(vector).over(in_order())
    minus = lambda a, b, by: F.zip_with(a, b, lambda x, y: (x - y) * (fps / by))
    inside = minus(after, before, 2.0)
    return frames.withColumn("velocity", F.when(before.isNull() & after.isNotNull(), minus(after, F.col(vector), 1.0)).when(after.isNull() & before.isNotNull(), minus(F.col(vector), before, 1.0)).otherwise(inside))


def paired(frames: DataFrame) -> DataFrame:
    """Each frame's action with the state after it; an episode's last frame has none."""
    return frames.withColumn("next_state", F.lead("state").over(in_order()))


_ORDER = "(PARTITION BY episode_index ORDER BY frame_index)"


def _terms(saturation_limit: float | None) -> list[Column]:
    """What a frame adds to its episode's metrics; arrays are reduced within the frame, so rows are never multiplied.

    Frames without an action count for nothing, and those around them are next to each other.
    """
    one, two = (F.expr(f"lag(action, {k}) IGNORE NULLS OVER {_ORDER}") for k in (1, 2))
    here = F.col("action").isNotNull()
    dims = F.size("action")
    bend = F.zip_with(F.zip_with("action", one, lambda x, y: x - y), F.zip_with(one, two, lambda x, y: x - y), lambda x, y: F.abs(x - y))
    columns = [
        F.when(here & one.isNotNull(), distance_sum(F.col("action"), one)).alias("s1"),
        F.when(here & one.isNotNull(), dims).alias("n1"),
        F.when(here & two.isNotNull(), F.aggregate(bend, F.lit(0.0), lambda t, x: t + x)).alias("s2"),
        F.when(here & two.isNotNull(), dims).alias("n2"),
    ]
    if saturation_limit is not None:
        after = F.expr(f"lead(if(action IS NULL, NULL, struct(state)), 1) IGNORE NULLS OVER {_ORDER}")["state"]
        far = F.exists(F.zip_with("action", after, lambda a, s: F.abs(a - s)), lambda e: e > saturation_limit)
        columns.append(F.when(here & after.isNotNull(), far.cast("double")).alias("sat"))
    return columns


def _sums(saturation_limit: float | None) -> list[Column]:
    ratio = lambda s, n: F.coalesce(F.sum(s) / F.sum(n), F.lit(0.0))
    out = [ratio("s1", "n1").alias("action_delta"), ratio("s2", "n2").alias("action_jerk")]
    return out if saturation_limit is None else [*out, F.coalesce(F.avg("sat"), F.lit(0.0)).alias("saturation")]


def motion(frames: DataFrame, saturation_limit: float | None = None) -> DataFrame:
    """frames, action_delta, action_jerk, and saturation if a limit is given; one row per episode."""
    return frames.select("episode_index", *_terms(saturation_limit)).groupBy("episode_index").agg(F.count("*").alias("frames"), *_sums(saturation_limit))


def spectral_arc_length(states: np.ndarray, fps: float) -> float:
    """Mean over joints of the arc length of the normalised velocity spectrum, negated."""
    if len(states) < 2:
        return 0.0
    speed = np.gradient(states, axis=0) * fps
    size = np.abs(np.fft.rfft(speed, axis=0))
    size = size / (size.max(0) + 1e-8)
    if len(size) < 2:
        return 0.0
    step = 1.0 / (2 * len(size))
    return float(np.mean(-np.sqrt(step * step + np.diff(size, axis=0) ** 2).sum(0)))


#: Frames up to which an episode's states are gathered in one row.
WHOLE = 1 << 18


def measured(frames: DataFrame, saturation_limit: float | None = None, fps: float | None = None, whole: int = WHOLE) -> DataFrame:
    """One row per episode: counts and shapes of vectors, motion, and with ``fps`` the smoothness sparc, by one exchange.

    States of an episode of up to ``whole`` frames are gathered beside its sums; longer ones are transformed in parts
    (:mod:`spectra`), for which the lengths of episodes are counted.  States that differ in length have no sparc.
    """
    place = F.row_number().over(in_order())
    columns = ["episode_index", "action", "state", *_terms(saturation_limit)]
    shape = [F.count("*").alias("frames"), F.count("action").alias("actions"), F.count("state").alias("states"), F.min(F.size("action")).alias("least"), F.max(F.size("action")).alias("most")]
    if fps is None:
        return frames.select(*columns).groupBy("episode_index").agg(*shape, *_sums(saturation_limit))
    gathered = F.collect_list(F.when((F.col("place") <= whole) & F.col("state").isNotNull(), F.struct("place", "state"))).alias("gathered")
    rows = frames.select(*columns, place.alias("place")).groupBy("episode_index").agg(*shape, *_sums(saturation_limit), gathered)
    kept = [f for f in rows.schema.fields if f.name != "gathered"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for many, held in zip(batch.column("frames").to_pylist(), batch.column("gathered"), strict=True):
                found = held.values
                sizes = pc.list_value_length(found.field("state"))
                if many > whole or not len(found) or pc.min(sizes) != pc.max(sizes):
                    made.append(None)
                    continue
                order = np.argsort(found.field("place").to_numpy())
                states = found.field("state").flatten().to_numpy(zero_copy_only=False).reshape(len(found), -1)
                made.append(spectral_arc_length(states[order], fps))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(made, pa.float64())], [*(f.name for f in kept), "sparc"])

    out = rows.mapInArrow(run, T.StructType([*kept, T.StructField("sparc", T.DoubleType())]))
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("n"), F.min(F.size("state")).alias("low"), F.max(F.size("state")).alias("high"), F.count("state").alias("held"))
    long = lengths.where((F.col("n") > whole) & (F.col("low") == F.col("high")) & (F.col("held") > 1)).select("episode_index")
    if frames.groupBy("episode_index").count().where(F.col("count") > whole).limit(1).count():
        parts = arc_lengths(frames.join(long, "episode_index", "left_semi"), fps).withColumnRenamed("sparc", "_sparc")
        out = out.join(parts, "episode_index", "left").withColumn("sparc", F.coalesce("sparc", "_sparc")).drop("_sparc")
    return out


def smoothness(frames: DataFrame, fps: float = 50.0, whole: int = WHOLE) -> DataFrame:
    """sparc, one row per episode."""
    return measured(frames.select("episode_index", "frame_index", F.lit(None).cast("array<double>").alias("action"), "state"), None, fps, whole).select("episode_index", "sparc")


#: Frames of an episode whose lag products are summed together.
CHUNK = 1024


def _products(size: int, low: int, high: int):
    """Sums over pairs of frames by lag, for chunks of episodes in order; a task adds up all its chunks."""
    width = high - low + 1

    def add(total: np.ndarray, chunk: int, at: np.ndarray, x: np.ndarray) -> None:
        at = at - chunk * size
        own = (at >= 0) & (at < size)
        if not own.any():
            return
        first, many = int(at[own].min()), int(at[own].max() - at[own].min() + 1)
        there = at - first - low
        late = (there >= 0) & (there < many + width - 1)
        a, b = np.zeros((many, x.shape[1])), np.zeros((many + width - 1, x.shape[1]))
        has_a, has_b = np.zeros(many), np.zeros(many + width - 1)
        a[at[own] - first], has_a[at[own] - first] = x[own], 1
        b[there[late]], has_b[there[late]] = x[late], 1
        sum_a, sum_b, square_a, square_b = a.sum(1), b.sum(1), np.square(a).sum(1), np.square(b).sum(1)
        for k in range(min(width, int(there.max(initial=-1)) + 1)):
            other = has_b[k : k + many]
            total[k] += (x.shape[1] * (has_a @ other), sum_a @ other, has_a @ sum_b[k : k + many], square_a @ other, has_a @ square_b[k : k + many], np.vdot(a, b[k : k + many]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, 6))
        for (_, chunk), part in in_groups(batches, ("episode_index", "chunk")):
            action = part.column("action").combine_chunks()
            sizes, at = pc.list_value_length(action).to_numpy(), part.column("at").to_numpy()
            for dims in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == dims)
                x = action.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dims)
                add(total, chunk, at[rows], x)
        seen = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(seen + low, pa.int64()), pa.array(total[seen, 0].astype(np.int64)), *(pa.array(total[seen, j]) for j in range(1, 6))], ["lag", "n", "a", "b", "aa", "bb", "ab"])

    return run


def autocorrelation(frames: DataFrame, max_lag: int = 50, min_lag: int = 1) -> DataFrame:
    """Correlation of an action with the one ``lag`` frames later in its episode, over all dimensions, by lag.

    An episode is cut into chunks.  A frame goes to its own chunk and to that (or those two) whose frames it follows by
    some lag, whatever the number of lags; products are summed there.  Actions of different length or with a null element make
    no pair; of frames that repeat an index one counts.
    """
    size = max(CHUNK, max_lag - min_lag + 1)
    at = F.col("frame_index").cast("long")
    chunk = lambda back: F.floor((at - back) / size)
    chunks = F.filter(F.array_distinct(F.array(chunk(0), chunk(min_lag), chunk(max_lag))), lambda c: c >= 0)
    rows = frames.where("action is not null").where(~F.exists("action", lambda x: x.isNull()))
    dealt = rows.select("episode_index", at.alias("at"), "action", F.explode(chunks).alias("chunk")).repartition("episode_index", "chunk").sortWithinPartitions("episode_index", "chunk")
    each = dealt.mapInArrow(_products(size, min_lag, max_lag), "lag long, n long, a double, b double, aa double, bb double, ab double")
    t = each.groupBy("lag").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    top = F.col("n") * F.col("ab") - F.col("a") * F.col("b")
    bottom = F.sqrt(F.col("n") * F.col("aa") - F.col("a") * F.col("a")) * F.sqrt(F.col("n") * F.col("bb") - F.col("b") * F.col("b"))
    return t.select("lag", F.col("n").alias("pairs"), F.when(bottom > 0, top / bottom).alias("correlation"))


def chunk_length(correlations: DataFrame, fps: float = 50.0, below: float = 0.5) -> DataFrame:
    """The first lag whose correlation is below a level, in steps and seconds; null if there is none."""
    first = correlations.where(F.col("correlation") < below).agg(F.min("lag").alias("steps"))
    return first.select("steps", (F.col("steps") / fps).alias("seconds"))


def first_chunk_length(frames: DataFrame, fps: float = 50.0, below: float = 0.5, block: int = 20) -> DataFrame:
    """:func:`chunk_length` over all lags: blocks of lags follow, each twice as long up to ``CHUNK``, until one holds it or the longest episode ends."""
    spans = frames.where("action is not null").groupBy("episode_index").agg((F.max("frame_index") - F.min("frame_index")).alias("span"))
    longest = spans.agg(F.max("span")).first()[0] or 0
    low = 1
    while True:
        high = low + block - 1
        found = chunk_length(autocorrelation(frames, high, low), fps, below).first()
        if found["steps"] is not None or high >= longest:
            return frames.sparkSession.createDataFrame([tuple(found)], "steps long, seconds double")
        low, block = high + 1, min(2 * block, CHUNK)
