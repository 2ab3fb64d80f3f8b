"""Token counts that follow edits without encoding the whole text again (operator 9).

A document's state is a segment tree over its pre-token groups.  A group starts
at each space that a non-space follows, which is always a pre-token boundary and
depends on these two characters alone.  Leaves hold a group's tokens and
characters, inner nodes the sums; the root's tokens are the document's count.

An edit replaces ``removed`` characters from ``start`` on by ``inserted``; the
edits of a document refer to the text before all of them and must not overlap.
They are applied from the last to the first.  The groups that an edit touches
and one on either side become one text in the first of these leaves, the others
become empty.  The texts of all edits of a slice of documents are then encoded
in one call, and the sums on the paths to the root are changed.  So the number of leaves stays, and an edit costs its own
length and the logarithm of the document's.

Null text counts as empty and has 0 tokens; null edits are none.  An edit beyond
the text's end is moved to it; negative numbers count as 0; insertions at one place
keep their order.  Overlapping edits
raise ValueError.  Repeated rows are independent; an empty table gives an empty
table; extra columns are carried through by :func:`build` and :func:`edit`.  A
new column whose name an input column has, in any case, gets underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import coder
from .chunks import ChunkTable, glued
from .common import free_names, table, text_slices

VOCAB = "byte_bpe_50k.json"
#: What :func:`edit` adds.
NAMES = ("n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "chars_encoded")
#: Groups that a worker remembers; many hold line ends and don't come again.
REMEMBERED = 300_000
EDITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("removed", T.LongType()), T.StructField("inserted", T.StringType())]))


def groups(text: str) -> list[str]:
    """Cut before each space that a non-space follows; the pieces joined are the text."""
    first, *rest = text.split(" ")
    return glued([first, *(" " + x for x in rest)]) if text else []


@lru_cache(maxsize=2)
def counts(vocab: str) -> ChunkTable:
    def learn(chunks: list[str]) -> list[int]:
        _, ends = coder(vocab)(chunks)
        return np.diff([0, *ends]).tolist()

    return ChunkTable(learn, False, REMEMBERED)


def tree(leaves: np.ndarray) -> np.ndarray:
    """Segment tree in heap order: node k has the children 2k and 2k + 1, leaf j is node size + j."""
    size = 1 << max(0, len(leaves) - 1).bit_length()
    out = np.zeros((2 * size, leaves.shape[1]), np.int32)
    out[size : size + len(leaves)] = leaves
    while size > 1:
        size //= 2
        out[size : 2 * size] = out[2 * size : 4 * size].reshape(size, 2, -1).sum(1)
    return out


def leaf_at(nodes: np.ndarray, offset: int) -> tuple[int, int]:
    """The leaf that holds the character ``offset``, and its place there; a text's end lies in the last leaf."""
    size, node = len(nodes) // 2, 1
    offset = min(offset, int(nodes[1, 1]) - 1) if nodes[1, 1] else 0
    while node < size:
        node *= 2
        if offset >= nodes[node, 1]:
            offset -= int(nodes[node, 1])
            node += 1
    return node - size, offset


def set_leaf(nodes: np.ndarray, leaf: int, tokens: int, characters: int) -> None:
    node = len(nodes) // 2 + leaf
    change = np.array([tokens, characters], np.int32) - nodes[node]
    while node and change.any():
        nodes[node] += change
        node >>= 1


def rewritten(pieces: list[str], nodes: np.ndarray, edits: list[tuple[int, int, str]]) -> tuple[np.ndarray, list[str], list[int]]:
    """Apply edits to copies of a tree and its pieces; also the leaves whose tokens are to be counted anew.

    Until :func:`recounted` sets them, these leaves hold no tokens.
    """
    nodes, pieces, open_ = nodes.copy(), list(pieces) or [""], set()
    total = int(nodes[1, 1])
    plain = [(min(max(s or 0, 0), total), max(r or 0, 0), i or "") for s, r, i in edits]
    plain = sorted(((s, min(r, total - s), i) for s, r, i in plain), key=lambda e: e[:2])
    for (s, r, _), (t, _, _) in zip(plain, plain[1:], strict=False):
        if s + r > t:
            raise ValueError("edits overlap")
    for start, removed, inserted in reversed(plain):  # what stands before a later edit has kept its place
        now = int(nodes[1, 1])
        first, inside = leaf_at(nodes, min(start, max(0, now - 1)))
        inside += start >= now > 0
        last = leaf_at(nodes, start + removed - 1)[0] if removed else first
        low, high = max(0, first - 1), min(len(pieces) - 1, last + 1)
        before = "".join(pieces[low:first])
        touched = before + "".join(pieces[first : high + 1])
        at = len(before) + inside
        new = touched[:at] + inserted + touched[at + removed :]
        pieces[low : high + 1] = [new] + [""] * (high - low)
        set_leaf(nodes, low, 0, len(new))
        for k in range(low + 1, high + 1):
            set_leaf(nodes, k, 0, 0)
        open_.difference_update(range(low + 1, high + 1))
        open_.add(low)
    return nodes, pieces, sorted(open_)


def recounted(changed: list[tuple[np.ndarray, list[str], list[int]]], learn) -> list[int]:
    """Encode the open leaves of many documents in one call, set their sums, and give the characters encoded of each."""
    windows = [pieces[k] for _, pieces, leaves in changed for k in leaves if pieces[k]]
    found = iter(learn(windows) if windows else [])
    encoded = []
    for nodes, pieces, leaves in changed:
        for k in leaves:
            set_leaf(nodes, k, next(found) if pieces[k] else 0, len(pieces[k]))
        encoded.append(sum(len(pieces[k]) for k in leaves))
    return encoded


def edited(pieces: list[str], nodes: np.ndarray, edits: list[tuple[int, int, str]], count) -> tuple[np.ndarray, list[str], int]:
    """Apply edits to a copy of one tree; also the new pieces and the number of characters encoded."""
    changed = rewritten(pieces, nodes, edits)
    (encoded,) = recounted([changed], lambda texts: [count(t) for t in texts])
    return changed[0], changed[1], encoded


def trees_of(cut: list[list[str]], vocab: str) -> list[np.ndarray]:
    """The trees of texts that are cut into groups."""
    known = counts(vocab).values(cut)
    out = []
    for pieces in cut:
        leaves = np.zeros((max(1, len(pieces)), 2), np.int32)
        leaves[: len(pieces), 0] = np.fromiter(map(known.__getitem__, pieces), np.int32, len(pieces))
        leaves[: len(pieces), 1] = np.fromiter(map(len, pieces), np.int32, len(pieces))
        out.append(tree(leaves))
    return out


def _added(docs: DataFrame, names: list[str], kinds: list[T.DataType]) -> tuple[T.StructType, list[str]]:
    fresh = free_names(docs.columns, names)
    return T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(fresh, kinds, strict=True))]), fresh


def build(docs: DataFrame, text: str = "text", state: str = "token_tree", vocab: str = VOCAB) -> DataFrame:
    """Add each document's tree as a binary column: pairs (tokens, characters) of 32-bit numbers in heap order."""
    schema, names = _added(docs, [state], [T.BinaryType()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                trees = trees_of([groups(t or "") for t in part.column(text).to_pylist()], vocab)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([t.tobytes() for t in trees], pa.binary())], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def edit(docs: DataFrame, edits: str, text: str = "text", state: str | None = "token_tree", vocab: str = VOCAB, names: tuple[str, ...] = NAMES) -> DataFrame:
    """Apply the column ``edits`` and add the counts before and after, and what was encoded again.

    Without a ``state`` column the trees are built on the way, so that none passes through the plan.
    """
    schema, fresh = _added(docs, list(names), [T.LongType()] * len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                cut = [groups(t or "") for t in part.column(text).to_pylist()]
                trees = [np.frombuffer(x, np.int32).reshape(-1, 2) for x in part.column(state).to_pylist()] if state else trees_of(cut, vocab)
                todo = [[(e["start"], e["removed"], e["inserted"]) for e in changes or () if e] for changes in part.column(edits).to_pylist()]
                changed = [rewritten(*x) for x in zip(cut, trees, todo, strict=True)]
                encoded = recounted(changed, counts(vocab).learn)
                rows = zip(*[(int(t[1, 0]), len(e), int(c[0][1, 0]), int(c[0][1, 1]), n) for t, e, c, n in zip(trees, todo, changed, encoded, strict=True)], strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, pa.int64()) for x in rows)], [*part.schema.names, *fresh])

    return docs.mapInArrow(run, schema)


def standard_edits(text: Column, source: Column, lang: Column) -> Column:
    """Three edits of each document: a source line at the front, a cut in the middle, a language mark at the end."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")
    middle = F.floor(n / 2).cast("long")

    def one(start: Column, removed: Column, inserted: Column) -> Column:
        return F.struct(start.alias("start"), removed.cast("long").alias("removed"), inserted.alias("inserted"))

    return F.array(
        one(F.lit(0).cast("long"), F.lit(0), F.concat(F.coalesce(source, F.lit("?")), F.lit(":\n"))),
        one(middle, F.least(F.lit(24), n - middle), F.lit(" [cut] ")),
        one(n, F.lit(0), F.concat(F.lit(" #"), F.coalesce(lang, F.lit("?")))),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", standard_edits(F.col("text"), F.col("source"), F.col("lang")).alias("edits"))
    return edit(docs, "edits", state=None).select("doc_id", *NAMES)
