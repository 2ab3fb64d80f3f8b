"""Ranked lexical search by pipelined term partitioning (operator 11).

Terms of the items are dealt to owners, rarest terms first.  Documents stand in
blocks, and for each block and part of the items a bundle carries sparse document
accumulators from owner to owner: a stage cogroups the bundles with the postings
of its own terms, adds their integer contributions and hands the bundles on as a
written table.  The last stage selects each block's best, a window the best of all.

Between stages each item's tenth partial score over all blocks is known.  A
document whose partial score and the most that the terms still to come can add
stay below it is left out, and so is one that only such terms would bring in:
contributions are never negative, so nothing that could be returned is lost.

Items are searched in slices of about ``SLICE_BYTES`` of text, whose terms alone
every task knows; a slice is one run of the pipeline, so any number of items is
searched.  A document's text is read piecewise, so its length is not bounded.

Null texts have no terms, and neither have texts of other characters alone; items
without terms have no rows.  Each row of documents is a document of its own, also
where a doc_id repeats or is null (null ids come last among equal scores).  Items
that repeat item_id and text count once; items of one id with several texts are
ranked by themselves.  Empty tables give an empty table.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table, text_slices

BEST = 10
#: Bytes of item texts in a slice.
SLICE_BYTES = 8 << 20
#: Items of a part, documents and postings of a block: they bound what one cogroup holds.
ITEMS = 256
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
#: Bytes of a text that are counted at once.
PIECE_BYTES = 4 << 20
#: Shares of all postings up to which the owners go, rarest terms first.
OWNERS = (0.02, 0.15, 0.5, 1.0)
FACTOR = 1_000_000_000

#: Term characters stay, A-Z lower-cased; all else parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))

BUNDLE = "block long, part int, item int, at array<int>, score array<long>, ids array<long>, best array<long>"


def counted(text: bytes) -> tuple[int, Counter]:
    """The number of terms of a UTF-8 text, and how often each occurs."""
    text, n, found, at = text.translate(_FOLD), 0, Counter(), 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE_BYTES:
            end = text.rfind(b" ", at, at + PIECE_BYTES)
            end = end if end > at else text.find(b" ", at + PIECE_BYTES)
            end = len(text) if end < 0 else end
        words = text[at:end].split()
        n += len(words)
        found.update(words)
        at = end + 1
    return n, found


def postings(docs: DataFrame, known: dict[bytes, int], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Rows by block: one per known term with the documents that hold it, and one head (term -1).

    The head has the lengths and ids of the block's documents with a known term, and the numbers of all its documents
    that have terms and of their terms.
    """

    def flush(block: int, ids: list, lengths: list[int], held: dict[int, tuple[list[int], list[int]]], docs: int, terms: int) -> pa.RecordBatch:
        rows = len(held) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block] * rows, pa.int64()),
                pa.array([*held, -1], pa.int32()),
                pa.array([*(at for at, _ in held.values()), None], pa.list_(pa.int32())),
                pa.array([*(tf for _, tf in held.values()), lengths], pa.list_(pa.int64())),
                pa.array([*([None] * len(held)), ids], pa.list_(pa.int64())),
                pa.array([*([None] * len(held)), docs], pa.int64()),
                pa.array([*([None] * len(held)), terms], pa.int64()),
            ],
            ["block", "term", "at", "tf", "ids", "n_docs", "n_terms"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, filled = TaskContext.get().partitionId() << 32, 0
        ids, lengths, held, n_docs, n_terms = [], [], {}, 0, 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    n, found = counted(text or b"")
                    n_docs, n_terms = n_docs + (n > 0), n_terms + n
                    here = known.keys() & found.keys()
                    for word in here:
                        at, tf = held.setdefault(known[word], ([], []))
                        at.append(len(ids))
                        tf.append(found[word])
                    if here:
                        ids.append(doc)
                        lengths.append(n)
                        filled += len(here)
                    if len(ids) >= block_docs or filled >= BLOCK_POSTINGS:
                        yield flush(block, ids, lengths, held, n_docs, n_terms)
                        block, filled = block + 1, 0
                        ids, lengths, held, n_docs, n_terms = [], [], {}, 0, 0
        if n_docs:
            yield flush(block, ids, lengths, held, n_docs, n_terms)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "block long, term int, at array<int>, tf array<long>, ids array<long>, n_docs long, n_terms long")


class Plan:
    """What stages know of a slice: each item's terms by owner with their weights, falling by what they can add."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray, n_docs: int, n_terms: int, per_part: int = ITEMS):
        self.n_docs, self.n_terms, self.items, self.per_part = n_docs, n_terms, len(items), per_part
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        useful = np.flatnonzero((df > 0) & (self.weight > 0))
        order = useful[np.argsort(df[useful], kind="stable")]
        share = np.cumsum(df[order]) / max(1, df[order].sum())
        self.owner = np.full(len(df), -1, np.int64)
        self.owner[order] = np.minimum(np.searchsorted(OWNERS, share), len(OWNERS) - 1)
        #: by item and owner: (term, repeats, the most that it can add); and what all owners from one on can add
        self.terms: list[list[list[tuple[int, int, int]]]] = []
        self.ahead = np.zeros((len(items), len(OWNERS) + 1), np.int64)
        for i, (terms, repeats) in enumerate(items):
            own: list[list[tuple[int, int, int]]] = [[] for _ in OWNERS]
            for t, r in zip(terms.tolist(), repeats.tolist(), strict=True):
                if self.owner[t] >= 0:
                    own[self.owner[t]].append((t, r, r * int(self.weight[t]) * (FACTOR // 1000)))
            for s, mine in enumerate(own):
                mine.sort(key=lambda x: (-x[2], x[0]))
                self.ahead[i, s] = sum(x[2] for x in mine)
            self.terms.append(own)
        self.ahead = self.ahead[:, ::-1].cumsum(1)[:, ::-1]

    def owned(self, spark: SparkSession) -> DataFrame:
        """(term, owner, part): the parts of the items that hold a term."""
        rows = sorted({(t, s, i // self.per_part) for i, own in enumerate(self.terms) for s, mine in enumerate(own) for t, _, _ in mine})
        return spark.createDataFrame(rows, "term int, owner int, part int")


def _tenth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0


def stage(plan: Plan, owner: int, floors: np.ndarray, k: int):
    """A function for cogroups: the bundles of a block and part of the items, and this owner's postings of the block."""
    last = owner == len(OWNERS) - 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        item = left.column("item").to_numpy()
        scores, places, all_ids = left.column("score"), left.column("at"), left.column("ids")
        head = int(np.flatnonzero(item == -1)[0])
        length, ids = scores[head].values.to_numpy(), all_ids[head].values
        m = 25 + (75 * length * plan.n_docs) // plan.n_terms
        gain = {}
        for t, at, tf in zip(right.column("term").to_pylist(), right.column("at"), right.column("tf"), strict=True):
            at, tf = at.values.to_numpy(), tf.values.to_numpy()
            gain[t] = at, plan.weight[t] * ((FACTOR * tf) // (1000 * tf + 8 * m[at]))
        held = {int(i): row for row, i in enumerate(item) if i >= 0}
        part = left.column("part")[0].as_py()
        out: dict[str, list] = {"item": [], "at": [], "score": [], "ids": [], "best": []}
        if not last:
            for name, value in (("item", -1), ("at", None), ("score", length), ("ids", ids), ("best", None)):
                out[name].append(value)
        for i in range(part * plan.per_part, min(plan.items, (part + 1) * plan.per_part)):
            mine = [x for x in plan.terms[i][owner] if x[0] in gain]
            if not mine and i not in held:
                continue
            total = np.zeros(len(length), np.int64)
            if i in held:
                total[places[held[i]].values.to_numpy()] = scores[held[i]].values.to_numpy()
            least = max(int(floors[i]), _tenth(total[total > 0], k))
            later = int(plan.ahead[i, owner + 1])
            ahead = later + sum(x[2] for x in mine)
            for t, repeats, most in mine:
                at, add = gain[t]
                if ahead < least:  # too little to bring in a document of its own
                    seen = total[at] > 0
                    at, add = at[seen], add[seen]
                total[at] += repeats * add
                ahead -= most
            found = np.flatnonzero(total)
            least = max(least, _tenth(total[found], k))
            found = found[total[found] + later >= least]
            if last:
                chosen = ids.take(pa.array(found))
                order = pc.sort_indices(pa.table({"score": total[found], "doc": chosen}), [("score", "descending"), ("doc", "ascending")])[:k]
                found, chosen = found[order.to_numpy()], chosen.take(order)
            else:
                chosen = None
            if len(found):
                top = total[found]
                best = np.sort(np.partition(top, -k)[-k:] if len(top) > k else top)
                for name, value in (("item", i), ("at", found.astype(np.int32)), ("score", top), ("ids", chosen), ("best", best)):
                    out[name].append(value)
        n = len(out["item"])
        return pa.table(
            [
                pa.array([left.column("block")[0].as_py()] * n, pa.int64()),
                pa.array([part] * n, pa.int32()),
                pa.array(out["item"], pa.int32()),
                *(_lists(out[name], kind) for name, kind in (("at", pa.int32()), ("score", pa.int64()), ("ids", pa.int64()), ("best", pa.int64()))),
            ],
            ["block", "part", "item", "at", "score", "ids", "best"],
        )

    return run


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    """Arrays and nulls as one list array, without Python numbers between."""
    flat = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x in rows if x is not None]
    ends = np.cumsum([0 if x is None else len(x) for x in rows])
    offsets = pa.array(np.append(0, ends), pa.int32(), mask=np.append([x is None for x in rows], False)) if rows else pa.array([0], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(flat) if flat else pa.array([], kind))


def _search(docs: DataFrame, texts: list[tuple], k: int, kept: Scratch, block_docs: int, part_items: int) -> DataFrame:
    """(item, doc_id, score, rank) for the items of a slice, by their place in it."""
    spark, known, items = docs.sparkSession, {}, []
    for _, text in texts:
        found = counted((text or "").encode())[1]
        terms = np.array([known.setdefault(w, len(known)) for w in found], np.int64)
        items.append((terms, np.array(list(found.values()), np.int64)))
    listed = kept.publish(postings(docs, known, block_docs), "lexical-postings")
    heads = listed.where("term = -1")
    n_docs, n_terms = heads.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = np.zeros(len(known), np.int64)
    for r in listed.where("term >= 0").groupBy("term").agg(F.sum(F.size("at")).alias("df")).collect():
        df[r["term"]] = r["df"]
    plan = Plan(items, df, n_docs or 0, n_terms or 1, part_items)
    # at most the terms of SLICE_BYTES of text
    owned = listed.join(F.broadcast(plan.owned(spark)), "term").select("block", "part", "owner", "term", "at", "tf")
    empty = F.lit(None)
    parts = F.explode(F.sequence(F.lit(0), F.lit(max(0, len(items) - 1) // part_items)))
    # the block is named anew, as bundles and postings come from one table
    bundles = heads.select(F.col("block").alias("block"), parts.alias("part"), F.lit(-1).alias("item"), empty.cast("array<int>").alias("at"), F.col("tf").alias("score"), "ids", empty.cast("array<long>").alias("best"))
    floors = np.zeros(len(items), np.int64)
    for owner in range(len(OWNERS)):
        mine = owned.where(F.col("owner") == owner).drop("owner")
        met = bundles.groupBy("block", "part").cogroup(mine.groupBy("block", "part")).applyInArrow(stage(plan, owner, floors, k), BUNDLE)
        bundles = kept.publish(met, f"lexical-bundles-{owner}")
        if owner < len(OWNERS) - 1:
            scores = bundles.where("item >= 0").select("item", F.explode("best").alias("score"))
            first = scores.withColumn("nth", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("nth") <= k)
            for r in first.groupBy("item").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).collect():
                floors[r["item"]] = r["least"]
    rows = bundles.select("block", "item", F.posexplode(F.arrays_zip("ids", "score", "at")).alias("p", "x")).select("block", "item", "x.at", F.col("x.ids").alias("doc_id"), "x.score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "at")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_docs: int = BLOCK_DOCS, part_items: int = ITEMS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``k`` best documents (doc_id, text) for each item (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    once = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    slices = max(1, -(-(once.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // slice_bytes))
    kept, out = Scratch(spark), None
    for s in range(slices):
        texts = sorted(((r["item_id"], r["text"]) for r in once.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == s).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
        found = _search(docs, texts, k, kept, block_docs, part_items)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(texts)], "item int, item_id long")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    ended = Scratch(spark)
    result = ended.publish(out, "lexical-found")  # at most k rows an item; the caller may delete it
    kept.remove()
    return result


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS terms FROM documents),
d AS (SELECT row_id, doc_id, terms, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
b AS (SELECT row_number() OVER () AS item_row, item_id, {_TERMS} AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_row, item_id, term, count(*)::BIGINT AS repeats FROM (SELECT item_row, item_id, unnest(terms) AS term FROM b) GROUP BY ALL),
p AS (SELECT row_id, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT row_id, doc_id, n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY term, docs),
c AS (SELECT row_id, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))) AS gain FROM p JOIN w USING (term), s),
f AS (SELECT item_row, item_id, row_id, doc_id, sum(repeats * gain)::BIGINT AS score FROM q JOIN c USING (term) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST, row_id)::INTEGER AS rank, doc_id, score FROM f WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
