"""Groups of sorted rows inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def in_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal keys, each whole, from batches that are sorted by them; one group is held at a time."""
    at, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            here = tuple(c[a].item() if hasattr(c[a], "item") else c[a] for c in columns)
            if here != at and held:
                yield at, pa.Table.from_batches(held)
                held = []
            at = here
            held.append(batch.slice(a, b - a))
    if held:
        yield at, pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int = 1 << 16) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Tables of ``least`` rows or more, cut between groups of sorted rows, each with its rows' group numbers."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def numbers(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            c = table.column(k).to_numpy()
            change[1:] |= c[1:] != c[:-1]
        return np.cumsum(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            table = pa.Table.from_batches(held)
            group = numbers(table)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield group[:cut], table.slice(0, cut)
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if held:
        table = pa.Table.from_batches(held)
        yield numbers(table), table
