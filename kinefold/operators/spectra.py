"""Amplitude spectra of episodes that are too long for one task, and their arc lengths.

The transform of a series of any length N is a convolution with a chirp (Bluestein), which a power of two M carries:
M = M1 x M2.  Each of its transforms goes in two steps, over columns of the M1 x M2 grid and then over rows, and
twiddle factors between them.  Column and row blocks are groups of bounded size; four exchanges move the numbers of
an episode, and no task holds one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns or rows of the grid in one group.
WIDE = 64
#: Frames whose places are counted together.
RUN = 65_536


def _turn(times: np.ndarray, of: int) -> np.ndarray:
    """exp(2 pi i times / of), of exact remainders."""
    return np.exp(2j * np.pi * (times % of) / of)


def _grid(n: int) -> tuple[int, int]:
    """M1 and M2 for a series of n."""
    bits = (2 * n - 2).bit_length()
    return 1 << bits // 2, 1 << (bits - bits // 2)


def numbered(frames: DataFrame) -> DataFrame:
    """(episode_index, n, length, state): frames with a state, counted from 0 in frame order, runs of frames summed first."""
    rows = frames.where("state is not null").select("episode_index", "frame_index", "state", F.floor(F.col("frame_index") / RUN).alias("run"))
    runs = rows.groupBy("episode_index", "run").agg(F.count("*").alias("held"))
    of = Window.partitionBy("episode_index")
    before = F.coalesce(F.sum("held").over(of.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = runs.select("episode_index", "run", before.alias("before"), F.sum("held").over(of).alias("length"))
    inside = F.row_number().over(Window.partitionBy("episode_index", "run").orderBy("frame_index"))
    return rows.join(placed, ["episode_index", "run"]).select("episode_index", (F.col("before") + inside - 1).alias("n"), "length", "state")


def _columns(rows: DataFrame, wide: int) -> DataFrame:
    """Rows by the blocks of columns that need them: their own, and those of the frames next to them."""
    bits = F.length(F.bin(2 * F.col("length") - 2))
    width = F.expr("shiftleft(1L, cast(bits - bits div 2 as int))")
    block = lambda n: F.floor(F.pmod(n, F.col("width")) / wide)
    n: Column = F.col("n")
    return rows.withColumn("bits", bits).withColumn("width", width).withColumn("block", F.explode(F.array_distinct(F.array(block(n), block(n + 1), block(n - 1))))).drop("bits", "width")


def _by_columns(fps: float, wide: int):
    """First half of the forward transform: velocities times the chirp, and the chirp itself as a last dimension."""

    def run(part: pa.Table) -> pa.Table:
        n, length, block = part.column("n").to_numpy(), part.column("length")[0].as_py(), part.column("block")[0].as_py()
        states = part.column("state").combine_chunks()
        x = states.flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1)
        m1, m2 = _grid(length)
        j0, j1 = block * wide, min(m2, (block + 1) * wide)
        w, dims = j1 - j0, x.shape[1]
        held = np.zeros((m1 + 1, w + 2, dims))
        own, left, right = (n % m2 >= j0) & (n % m2 < j1), (n + 1) % m2 == j0, (n > 0) & ((n - 1) % m2 == j1 - 1)
        held[n[own] // m2, n[own] % m2 - j0 + 1] = x[own]
        held[(n[left] + 1) // m2, 0] = x[left]
        held[(n[right] - 1) // m2, w + 1] = x[right]
        place = np.arange(m1)[:, None] * m2 + np.arange(j0, j1)
        inner, before, after = held[:m1, 1:-1], held[:m1, :-2], held[:m1, 2:]
        speed = (after - before) / 2
        first, last = place == 0, place == length - 1
        speed[first], speed[last] = (after - inner)[first], (inner - before)[last]
        inside = place < length
        chirp = np.where(inside, _turn(-(place * place), 2 * length), 0)
        mirror = np.minimum(place, m1 * m2 - place)
        both = np.where(mirror < length, _turn(mirror * mirror, 2 * length), 0)
        grid = np.concatenate([speed * fps * inside[..., None] * chirp[..., None], both[..., None]], -1)
        grid = np.fft.fft(grid, axis=0) * _turn(-(np.arange(m1)[:, None] * np.arange(j0, j1)), m1 * m2)[..., None]
        return _blocks(part, length, block, [grid[k : k + wide] for k in range(0, m1, wide)], dims)

    return run


_SCHEMA = "episode_index long, length long, dims int, block long, piece long, numbers binary"


def _blocks(part: pa.Table, length: int, piece: int, made: list[np.ndarray], dims: int) -> pa.Table:
    k = len(made)
    return pa.table(
        {
            "episode_index": pa.array([part.column("episode_index")[0].as_py()] * k, pa.int64()),
            "length": pa.array([length] * k, pa.int64()),
            "dims": pa.array([dims] * k, pa.int32()),
            "block": pa.array(range(k), pa.int64()),
            "piece": pa.array([piece] * k, pa.int64()),
            "numbers": pa.array([np.ascontiguousarray(x, complex).tobytes() for x in made], pa.binary()),
        }
    )


def _pieces(part: pa.Table) -> tuple[list[bytes], int, int, int]:
    order = np.argsort(part.column("piece").to_numpy())
    raw = part.column("numbers").to_pylist()
    return [raw[k] for k in order], *(part.column(c)[0].as_py() for c in ("length", "dims", "block"))


def _by_rows(wide: int):
    """Second half of the forward transform, the product with the chirp's, and the first half of the inverse one.

    A block of columns gets the first column of the next one too.
    """

    def run(part: pa.Table) -> pa.Table:
        raw, length, dims, block = _pieces(part)
        m1, m2 = _grid(length)
        k0, k1 = block * wide, min(m1, (block + 1) * wide)
        grid = np.concatenate([np.frombuffer(x, complex).reshape(k1 - k0, -1, dims + 1) for x in raw], 1)
        grid = np.fft.fft(grid, axis=1)
        grid = np.fft.ifft(grid[..., :dims] * grid[..., dims:], axis=1)
        grid = np.concatenate([grid, grid[:, :1]], 1) * _turn(np.arange(k0, k1)[:, None] * np.arange(m2 + 1), m1 * m2)[..., None]
        return _blocks(part, length, block, [grid[:, j : min(m2, j + wide) + 1] for j in range(0, m2, wide)], dims)

    return run


def _sizes(wide: int):
    """Second half of the inverse transform: amplitudes up to half the sampling rate, and the largest by dimension."""

    def run(part: pa.Table) -> pa.Table:
        raw, length, dims, block = _pieces(part)
        m1, m2 = _grid(length)
        w = min(m2, (block + 1) * wide) - block * wide + 1
        size = np.abs(np.fft.ifft(np.concatenate([np.frombuffer(x, complex).reshape(-1, w, dims) for x in raw]), axis=0))
        place = np.arange(m1)[:, None] * m2 + block * wide + np.arange(w)
        rows = int((place[:, 0] <= length // 2).sum())
        size = np.where((place <= length // 2)[..., None], size, 0)[:rows]
        top = size.reshape(-1, dims).max(0, initial=0)
        names = {"episode_index": pa.int64(), "length": pa.int64(), "dims": pa.int32(), "block": pa.int64()}
        held = {c: pa.array([part.column(c)[0].as_py()], kind) for c, kind in names.items()}
        return pa.table(held | {"top": pa.array([top.tolist()], pa.list_(pa.float64())), "size": pa.array([size.tobytes()], pa.binary())})

    return run


def _arcs(wide: int):
    def run(batches):
        for batch in batches:
            sums = []
            for length, dims, block, top, raw in zip(*(batch.column(c).to_pylist() for c in ("length", "dims", "block", "tops", "size")), strict=True):
                _, m2 = _grid(length)
                w = min(m2, (block + 1) * wide) - block * wide + 1
                size = np.frombuffer(raw).reshape(-1, w, dims) / (np.array(top) + 1e-8)
                place = np.arange(len(size))[:, None] * m2 + block * wide + np.arange(w - 1)
                step = 1 / (2 * (length // 2 + 1))
                sums.append(float(np.sqrt(step * step + np.diff(size, axis=1) ** 2)[place < length // 2].sum()) / dims)
            yield pa.RecordBatch.from_arrays([batch.column("episode_index"), pa.array(sums, pa.float64())], ["episode_index", "arc"])

    return run


def arc_lengths(frames: DataFrame, fps: float, wide: int = WIDE) -> DataFrame:
    """(episode_index, sparc) of episodes with at least two states, all of one number of dimensions."""
    by = ("episode_index", "block")
    half = _columns(numbered(frames), wide).groupBy(*by).applyInArrow(_by_columns(fps, wide), _SCHEMA)
    whole = half.groupBy(*by).applyInArrow(_by_rows(wide), _SCHEMA)
    sizes = whole.groupBy(*by).applyInArrow(_sizes(wide), "episode_index long, length long, dims int, block long, top array<double>, size binary")
    tops = sizes.select(F.col("episode_index").alias("of"), F.posexplode("top").alias("d", "x")).groupBy("of", "d").agg(F.max("x").alias("x"))
    tops = tops.groupBy("of").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda e: e["x"]).alias("tops"))
    arcs = sizes.join(tops, F.col("episode_index") == F.col("of")).select("episode_index", "length", "dims", "block", "tops", "size").mapInArrow(_arcs(wide), "episode_index long, arc double")
    return arcs.groupBy("episode_index").agg((-F.sum("arc")).alias("sparc"))
