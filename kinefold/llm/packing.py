"""Packing of tokenized documents into fixed windows by best-fit decreasing (operator 2).

A document's ids are cut into full windows of ``capacity`` ids; each is a
sequence of its own.  The rest, shorter than a window, is placed by best-fit
decreasing: rests in descending length, each into the open window with the least
sufficient room, found by a segment tree over remaining capacities.

Best fit is a sequential rule, so rests are dealt into groups by a hash and each
group is packed by one task on lengths alone; ids never move.  A group has about
``group_rows`` rests, and at most one task's worth of windows stays partly
filled, so padding does not grow with the data.  The hash covers the row's
content and a row number within its task, so no key can gather in one group.

Null text counts as empty: such a document has the end id alone.  Repeated rows
are separate documents.  An empty table gives an empty table.  Extra columns are
ignored.  A sequence's rows are padded to the capacity, except a sequence whose
length is exactly a power of two, which needs no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoded
from .common import table, text_slices

CAPACITY = 4096
GROUP_ROWS = 4000


class Room:
    """Open windows by remaining capacity, in a segment tree of counts.

    Leaf r counts the open windows with room for r more ids; an inner node holds the sum of its two children.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, window: int, room: int) -> None:
        self.open[room].append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node, count = self.leaves + room, self.count
        while node:
            count[node] += by
            node >>= 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least ``size``."""
        count, node = self.count, self.leaves + size
        if not count[node]:
            # climb until a right sibling holds a window, then descend to its leftmost one
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        self._change(room, -1)
        return self.open[room].pop(), room


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; pieces of 1 to ``capacity`` ids, longest first, ties by position."""
    window, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room, windows = Room(capacity), 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = room.tightest(size)
        if found is None:
            found = (windows, capacity)
            windows += 1
        window[k], offset[k] = found[0], capacity - found[1]
        if found[1] > size:
            room.add(found[0], found[1] - size)
    return window, offset


def pieces(docs: DataFrame, vocab: str, end_id: int, capacity: int) -> DataFrame:
    """One row per document: its number of ids and the checksum of each of its pieces, and a tie breaker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, row = np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                raw = [x + last for x in encoded(vocab, part.column("text").to_pylist())]
                sums = [[zlib.crc32(x[i : i + 4 * capacity]) for i in range(0, len(x), 4 * capacity)] for x in raw]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(range(row, row + len(raw)), pa.int64())],
                    ["doc_id", "doc_tokens", "sums", "row"],
                )
                row += len(raw)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, doc_tokens long, sums array<long>, row long")


def pack(docs: DataFrame, vocab: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pack whole documents; one row per piece.

    ``sequence_id`` is the group's number times 2**32 plus the sequence's number in its group.
    """
    groups = max(1, -(-docs.count() // group_rows))
    found = pieces(docs, vocab, end_id, capacity)
    dealt = found.withColumn("group", F.pmod(F.xxhash64("doc_id", "doc_tokens", "sums", "row"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_tokens", "doc_id", "row"], kind="stable")
        total = pdf["doc_tokens"].to_numpy()
        full, rest = total // capacity, total % capacity
        window, offset = np.zeros(len(total), np.int64), np.zeros(len(total), np.int64)
        placed = np.flatnonzero(rest)
        window[placed], offset[placed] = best_fit(rest[placed], capacity)
        many = full + (rest > 0)
        which = np.repeat(np.arange(len(total)), many)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        is_rest = nth == full[which]
        sequence = np.where(is_rest, window[which], 0)
        sequence[~is_rest] = (window.max() + 1 if len(placed) else 0) + np.arange(int((~is_rest).sum()))
        return pd.DataFrame(
            {
                "doc_id": pdf["doc_id"].astype("Int64").to_numpy()[which],
                "start": nth * capacity,
                "length": np.where(is_rest, rest[which], capacity),
                "ids_crc32": np.concatenate([*map(np.asarray, pdf["sums"]), np.zeros(0, np.int64)]).astype(np.int64),
                "doc_tokens": total[which],
                "sequence_id": int(pdf["group"].iloc[0]) * (1 << 32) + sequence,
                "offset": np.where(is_rest, offset[which], 0),
            }
        )

    return dealt.groupBy("group").applyInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
