"""Approximate nearest neighbours by an inverted multi-index (operator 13).

Vectors are cut into two halves, and each half is quantised by centroids of its
own, fitted by k-means on at most ``SAMPLE`` vectors.  Every vector stands in the
cell of its pair of centroids.  A query goes through pairs of centroids by the sum
of their squared distances, with a heap, until the cells that it has seen hold
``target`` vectors; these are compared by their exact distance in double precision.

``target`` is measured: for up to ``AUDIT`` queries all vectors are compared by brute
force, and it is the least number that reaches ``RECALL`` of their true neighbours.

Equal vectors are one entry, which keeps its ``k`` + 1 smallest ids; more can't be
in any answer of k rows without the query's own.  So copies of any number cost
one comparison.  Cells stand in shards of about ``SHARD`` entries; a cell that holds
more is spread over several.  A task holds one shard and streams the queries that
visit it; a shard that more than ``VISITS`` queries visit is read by several tasks.
Driver and tasks hold centroids and the sizes of cells, at most ``CENTROIDS`` squared.

Null ids and vectors that are null, empty, zero, or hold a null or non-finite
component take no part; neither do vectors whose length isn't the most frequent one
(of several, the longest).  Ties go to the smaller id.  Rows that repeat id and
vector count once; an id with several vectors is a candidate with each, and a query
with the smallest.  A query is no candidate of its own, nor is any row of its id.
Fewer candidates than k are all returned.  Empty tables give an empty table.  Extra columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, runs, table
from .neardup_vectors import usable

NEAREST = 10
SAMPLE = 16_384
CENTROIDS = 1024
CELL = 64
ITERATIONS = 12
SHARD = 1024
VISITS = 4096
AUDIT = 128
RECALL = 0.96
#: Doubles that a comparison of some queries with a shard holds at once.
STEP = 1 << 21


def entries(vectors: DataFrame, k: int = NEAREST) -> DataFrame:
    """(ids, vector): distinct vectors of the most frequent length, each with its ``k`` + 1 smallest ids."""
    fit = vectors.where("vec_id is not null").where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    sizes = fit.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    fit = fit.where(F.size("vector") == (sizes["size"] if sizes else -1))
    # the window's limit is taken before the shuffle too, so copies of one vector meet as k + 1 rows of each task
    first = fit.withColumn("nth", F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("nth") <= k + 1)
    return first.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")).select("ids", "vector")


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)[None, :]


def centroids(x: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """k-means from a draw of distinct rows; a centroid that no row is near to is drawn anew."""
    distinct = np.unique(x, axis=0)
    count = min(count, len(distinct))
    centres = distinct[rng.choice(len(distinct), count, replace=False)]
    for _ in range(ITERATIONS if count < len(distinct) else 0):
        near = np.concatenate([_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        size = np.bincount(near, minlength=count)
        order = np.argsort(near, kind="stable")
        sums = np.add.reduceat(x[order], np.minimum(np.cumsum(size) - size, len(x) - 1), axis=0)
        centres = np.where((size > 0)[:, None], sums / np.maximum(size, 1)[:, None], distinct[rng.integers(len(distinct), size=count)])
    return centres


@dataclass(frozen=True)
class Quantiser:
    """Centroids of the two halves of a vector."""

    first: np.ndarray
    second: np.ndarray

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to their centroids."""
        cut = self.first.shape[1]
        return _squares(x[:, :cut], self.first), _squares(x[:, cut:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def visits(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> Iterator[int]:
        """Cells that hold entries, by the sum of the distances a and b of their centroids."""
        one, two = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        x, y, width = a[one].tolist(), b[two].tolist(), len(two)
        heap, reached = [(x[0] + y[0], 0, 0)], [0] * len(one)  # reached: by row, how many columns have left the heap
        while heap:
            _, i, j = heapq.heappop(heap)
            reached[i] = j + 1
            if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
            if i + 1 < len(one) and reached[i + 1] == j:
                heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
            cell = one[i] * width + two[j]
            if sizes[cell]:
                yield cell


def fit(rows: DataFrame, count: int, seed: int = 0) -> Quantiser:
    """Centroids from at most ``SAMPLE`` entries, drawn by a hash of the vector."""
    draw = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(min(1.0, 1.2 * SAMPLE / max(1, count)) * (1 << 30))
    x = _matrix_of(rows.where(draw).select("vector").limit(SAMPLE).toArrow())
    if not len(x):
        x = _matrix_of(rows.select("vector").limit(SAMPLE).toArrow())
    wanted = int(min(CENTROIDS, max(2, 2 ** round(np.log2(max(4, count / CELL)) / 2))))
    cut, rng = max(1, x.shape[1] // 2), np.random.default_rng(seed)
    return Quantiser(centroids(x[:, :cut], wanted, rng), centroids(x[:, cut:], wanted, rng) if x.shape[1] > cut else np.zeros((1, 0)))


def _matrix_of(found: pa.Table) -> np.ndarray:
    lists = found.column("vector").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return _matrix(lists, len(lists)) if len(lists) else np.zeros((0, 0))


def indexed(rows: DataFrame, quantiser: Quantiser) -> DataFrame:
    """(cell, ids, vector): every entry in its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = quantiser.cells(_matrix(batch.column("vector"), batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column("ids"), batch.column("vector")], ["cell", "ids", "vector"])

    return rows.mapInArrow(run, "cell int, ids array<long>, vector array<double>")


def _best(ids: list[list[int]], distance: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k nearest (position, id) of entries, ties to smaller ids; the query's own id counts for nothing."""
    if len(distance) > k + 1:  # one entry may hold the query's own id alone
        near = np.flatnonzero(distance <= np.partition(distance, k)[k])
    else:
        near = np.arange(len(distance))
    found = [(distance[p], i, p) for p in near.tolist() for i in ids[p] if i != own]
    return [(p, i) for _, i, p in sorted(found)[:k]]


def brute(rows: DataFrame, ids: np.ndarray, x: np.ndarray, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score, cell): the true neighbours of some queries, compared with all of :func:`indexed`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, held, cell = _matrix(batch.column("vector"), batch.num_rows), batch.column("ids").to_pylist(), batch.column("cell").to_numpy()
            out = []
            for own, q in zip(ids.tolist(), x, strict=True):
                distance = np.sqrt(np.square(v - q).sum(1))
                out += [(own, i, float(distance[p]), int(cell[p])) for p, i in _best(held, distance, own, k)]
            yield _rows(out, ["query_id", "vec_id", "score", "cell"], [pa.int64(), pa.int64(), pa.float64(), pa.int32()])

    return _ranked(rows.mapInArrow(run, "query_id long, vec_id long, score double, cell int"), k)


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)


@dataclass(frozen=True)
class Shards:
    """Where cells stand: the first shard of each and how many it is spread over."""

    first: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray, rows: int = SHARD) -> Shards:
        parts = np.maximum(1, -(-sizes // rows))
        small = parts == 1
        place = np.cumsum(np.where(small, sizes, 0)) - np.where(small, sizes, 0)
        first = place // rows
        begin = int(first.max(initial=0)) + 1
        big = np.cumsum(np.where(small, 0, parts)) - np.where(small, 0, parts)
        return Shards(np.where(small, first, begin + big).astype(np.int64), parts.astype(np.int64))


def placed(rows: DataFrame, shards: Shards) -> DataFrame:
    """:func:`indexed` entries with their shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, deal = batch.column("cell").to_numpy(), batch.column("deal").to_numpy()
            shard = shards.first[cell] + deal % shards.parts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(shard), *(batch.column(c) for c in ("cell", "ids", "vector"))], ["shard", "cell", "ids", "vector"])

    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("vector"), F.lit(1 << 40)))
    return dealt.mapInArrow(run, "shard long, cell int, ids array<long>, vector array<double>")


def routed(queries: DataFrame, quantiser: Quantiser, sizes: np.ndarray, shards: Shards, target: int) -> DataFrame:
    """(shard, query_id, vector, cells): each query once for every shard that it visits, with the cells there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x, out = _matrix(part.column("vector"), part.num_rows), []
                for row, (a, b) in enumerate(zip(*quantiser.halves(x), strict=True)):
                    there: dict[int, list[int]] = {}
                    seen = 0
                    for cell in quantiser.visits(a, b, sizes):
                        for s in range(shards.first[cell], shards.first[cell] + shards.parts[cell]):
                            there.setdefault(s, []).append(cell)
                        seen += int(sizes[cell])
                        if seen >= target:
                            break
                    out += [(row, s, cells) for s, cells in there.items()]
                rows = pa.array([r for r, _, _ in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for _, s, _ in out], pa.int64()), part.column("query_id").take(rows), part.column("vector").take(rows), pa.array([c for _, _, c in out], pa.list_(pa.int32()))],
                    ["shard", "query_id", "vector", "cells"],
                )

    return queries.mapInArrow(run, "shard long, query_id long, vector array<double>, cells array<int>")


def reranked(rows: DataFrame, visits: DataFrame, k: int, shuffles: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the best of the cells that queries visit, by exact distance.

    Entries of a shard come before its queries, so a task holds one shard and some queries at a time.
    """
    busy = visits.groupBy("shard").count().where(F.col("count") > VISITS).select("shard", F.ceil(F.col("count") / VISITS).cast("int").alias("shares"))
    share = F.lit(0)
    if busy.limit(1).count():  # such a shard's entries are copied, its queries dealt
        rows = rows.join(busy, "shard", "left").withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).drop("shares")
        visits = visits.join(busy, "shard", "left").withColumn("share", F.pmod(F.xxhash64("query_id"), F.coalesce("shares", F.lit(1))).cast("int")).drop("shares")
    else:
        rows, visits = rows.withColumn("share", share), visits.withColumn("share", share)
    none = F.lit(None)
    both = rows.select("shard", "share", F.lit(0).alias("kind"), "cell", "ids", "vector", none.cast("array<int>").alias("cells")).unionByName(
        visits.select("shard", "share", F.lit(1).alias("kind"), none.cast("int").alias("cell"), F.array("query_id").alias("ids"), "vector", "cells")
    )
    dealt = both.repartition(shuffles, "shard", "share").sortWithinPartitions("shard", "share", "kind", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell, ids, held = None, np.zeros(0, np.int32), [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("shard", "share", "kind")]
            for a, b in zip(*runs(keys), strict=True):
                part, here = batch.slice(a, b - a), (int(keys[0][a]), int(keys[1][a]))
                x = _matrix(part.column("vector"), b - a)
                if here != at:
                    at, cell, ids, held = here, np.zeros(0, np.int32), [], []
                if keys[2][a] == 0:
                    cell, ids = np.append(cell, part.column("cell").to_numpy()), ids + part.column("ids").to_pylist()
                    held.append(x)
                    continue
                held = [np.concatenate(held)] if held else [np.zeros((0, x.shape[1]))]
                yield _compared(cell, ids, held[0], part, x)

    def _compared(cell: np.ndarray, ids: list, v: np.ndarray, part: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        out = []
        for own, q, cells in zip(part.column("ids").flatten().to_pylist(), x, part.column("cells"), strict=True):
            wanted = np.flatnonzero(np.isin(cell, cells.values.to_numpy()))
            # in steps, so that long vectors don't take more
            step = max(1, STEP // max(1, len(q)))
            distance = np.concatenate([np.zeros(0), *(np.sqrt(np.square(v[wanted[i : i + step]] - q).sum(1)) for i in range(0, len(wanted), step))])
            out += [(own, i, float(distance[p])) for p, i in _best([ids[w] for w in wanted.tolist()], distance, own, k)]
        return _rows(out, ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()])

    return _ranked(dealt.mapInArrow(run, "query_id long, vec_id long, score double"), k).select("query_id", "rank", "vec_id", "score")


def measured(quantiser: Quantiser, sizes: np.ndarray, ids: np.ndarray, x: np.ndarray, true: list, recall: float) -> tuple[int, float]:
    """The least target that finds ``recall`` of the true neighbours of some queries, and the recall that it has."""
    cells: dict[int, list[int]] = {}
    for r in true:
        cells.setdefault(r["query_id"], []).append(r["cell"])
    needed = []
    for own, a, b in zip(ids.tolist(), *quantiser.halves(x), strict=True):
        # a cell is visited as long as those before it hold fewer than the target
        before, seen, left = {}, 0, set(cells.get(own, ()))
        for cell in quantiser.visits(a, b, sizes):
            if not left:
                break
            if cell in left:
                before[cell] = seen
                left.discard(cell)
            seen += int(sizes[cell])
        needed += [before[c] + 1 for c in cells.get(own, ())]
    if not needed:
        return 1, 1.0
    needed = np.sort(needed)
    target = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])
    return target, float((needed <= target).mean())


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """The nearest of ``vectors`` (vec_id, embedding) to each of ``queries`` (the same columns).

    Returns query_id, rank, vec_id, score (distance), and audited: the recall that the audit has measured for the target.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double, audited double"
    kept = Scratch(spark)
    rows = kept.publish(entries(vectors, k), "multi-index-entries")
    count = rows.count()
    if not count:
        kept.remove()
        return spark.createDataFrame([], schema)
    quantiser = fit(rows, count)
    index = kept.publish(indexed(rows, quantiser), "multi-index-cells")
    sizes = np.zeros(len(quantiser.first) * len(quantiser.second), np.int64)
    for r in index.groupBy("cell").count().collect():  # CENTROIDS squared at most
        sizes[r["cell"]] = r["count"]
    length = quantiser.first.shape[1] + quantiser.second.shape[1]
    asked = queries.where("vec_id is not null").where(usable(F.col("embedding"))).where(F.size("embedding") == length)
    asked = kept.publish(asked.groupBy(F.col("vec_id").cast("long").alias("query_id")).agg(F.min(F.col("embedding").cast("array<double>")).alias("vector")), "multi-index-queries")
    some = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(AUDIT).toArrow()
    audit_ids, audit_x = some.column("query_id").to_numpy(), _matrix_of(some)
    if not len(audit_ids):
        kept.remove()
        return spark.createDataFrame([], schema)
    true = brute(index, audit_ids, audit_x, k).select("query_id", "cell").collect()  # k rows a query
    target, found = measured(quantiser, sizes, audit_ids, audit_x, true, recall)
    shards = Shards.of(sizes)
    visits = kept.publish(routed(asked, quantiser, sizes, shards, target), "multi-index-visits")
    shuffles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    result = Scratch(spark).publish(reranked(placed(index, shards), visits, k, shuffles).withColumn("audited", F.lit(found)), "multi-index-found")
    kept.remove()
    return result


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
