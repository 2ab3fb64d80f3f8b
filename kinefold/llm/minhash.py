"""Near-duplicate documents by MinHash and sequential Bayesian verification (operator 6).

1. One map over the documents gives each its number of shingles, a key of its
   whole shingle set, its signature of ``BANDS * ROWS`` minima and a bitmap of its
   shingles' hashes.
2. Documents with equal sets form a class; only the class with its smallest
   doc_id goes on, so exact copies of any number cost one aggregation.
3. Classes that agree in a band are candidates.  First each class meets the
   smallest class of its bucket.  Buckets whose classes are then still in
   several components are compared across these, cut into blocks: a task holds two
   blocks of at most ``BLOCK`` classes.  Classes of buckets of over ``HOT`` such
   first meet in deeper bands, each of minima of its own, which are deepened again while
   that parts them.  What these miss is found exactly: in an order of all shingles by
   their number of classes, two sets that reach the similarity share one of their first,
   so the classes that are in different components still meet at those shingles.
4. A candidate pair is judged on batches of its signatures.  After each batch
   the posterior of its similarity (uniform prior, so a Beta distribution) says
   how likely a similarity at the threshold is to show so few agreements; below
   ``MISS`` the pair is dropped.  In blocks the bitmaps then bound the
   similarity from above, which loses nothing; blocks of the exact way look at these
   alone.  Survivors are verified on their whole shingle sets, so no link is wrong.
5. Verified pairs and components give the classes' component ids.

At a similarity of 0.8 a pair is missed by all bands with probability
(1 - 0.8**4)**20 = 3e-5, and more similar pairs more rarely.

Shingles are 64-bit hashes of four words' hashes.  A document with fewer words
has its whole word sequence as one shingle.  Null and empty texts, and texts of
white space alone, have no shingles and link with nothing.  A null doc_id never
links.  Repeated rows are one class and each is returned.  Rows that repeat a
doc_id with another text are documents of their own, of which each may link.  An
empty table gives an empty table.  Columns but doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, grouped, publish, runs, table, text_slices
from .components import components

BANDS, ROWS = 20, 4
#: Signatures looked at before each decision.
BATCHES = (16, 32, 48, 64, 80)
MISS = 1e-9
#: Classes of a block; those of the exact way are larger, as each class goes to as many groups as its bucket has blocks.
BLOCK, EXACT_BLOCK = 256, 1024
#: Open classes of a bucket from which on they meet in deeper ones and then exactly, the miss probability of the deeper ones, and the similarity they tell from the threshold.
HOT, DEEP_MISS, TEMPLATE = 1024, 0.01, 0.6
#: Rows added to bands at once at most, and the share of the largest bucket from which on deeper ones don't part classes.
STEP, PARTED = 8, 0.8
#: Bytes of a bitmap; as many bits are set in it as a class has shingles, or fewer.
BITMAP = 512
#: Ids sent to all tasks at once at most; beyond it a shuffled join does the same.
BROADCAST_ROWS = 1_000_000
#: The type of a class's number.
NODE = "decimal(38,0)"
REMEMBERED_WORDS = 200_000
SLICE = 4 << 20


class _WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED_WORDS:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text."""
    get = _word_hashes().__getitem__
    out = []
    for t in texts:
        # bytes.lower and bytes.split know ASCII letters and ASCII white space alone
        found = (t or "").encode("utf-8", "surrogatepass").lower().split()
        h = np.fromiter(map(get, found), np.uint64, len(found))
        n = max(1, len(h) - words + 1) if len(h) else 0
        value = np.full(n, min(len(h), words), np.uint64)
        for j in range(min(words, len(h))):
            value = _mix(value * np.uint64(0x100000001B3) + h[j : j + n])
        out.append(np.unique(value))
    return out


@lru_cache(maxsize=1)
def _salts() -> np.ndarray:
    rng = np.random.default_rng(11)
    return rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima for each non-empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    begin = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    for k, salt in enumerate(_salts()):
        value = ((flat ^ salt >> np.uint64(7)) * salt >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(value, begin) if len(flat) else 0
    return out


def bitmap(shingles: np.ndarray) -> bytes:
    bits = np.zeros(8 * BITMAP, np.uint8)
    bits[(shingles >> np.uint64(20)) % np.uint64(8 * BITMAP)] = 1
    return np.packbits(bits).tobytes()


def describe(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, body, n_shingles and, null without shingles, set_key, mark, signature and bitmap, one row per document.

    ``body`` tells texts apart, ``set_key`` is a key of the whole set and ``mark`` 62 bits of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                sets = shingle_sets(part.column("text").to_pylist(), words)
                rows = iter(signatures([s for s in sets if len(s)]))
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                marks = [int.from_bytes(k[:8], "little") >> 2 if k else None for k in keys]
                signs = [next(rows).tobytes() if len(s) else None for s in sets]
                maps = [bitmap(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("body"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.int64()), pa.array(signs, pa.binary()), pa.array(maps, pa.binary())],
                    ["doc_id", "body", "n_shingles", "set_key", "mark", "signature", "bitmap"],
                )

    return _identified(docs).mapInArrow(run, "doc_id long, body long, n_shingles long, set_key binary, mark long, signature binary, bitmap binary")


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text")


@lru_cache(maxsize=8)
def least_agreement(threshold: float, miss: float) -> tuple[int, ...]:
    """For each batch, the fewest agreements with which a pair stays.

    With m of n signatures equal the posterior is Beta(m + 1, n - m + 1); the pair is dropped if the posterior of
    a similarity of at least ``threshold`` is below ``miss``.
    """
    out = []
    for n in BATCHES:
        for m in range(n + 1):
            # P(Beta(m + 1, n - m + 1) >= t) is P(Binomial(n + 1, t) <= m)
            tail = sum(math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))
            if tail >= miss:
                out.append(m)
                break
    return tuple(out)


def plausible(a: np.ndarray, b: np.ndarray, threshold: float, miss: float = MISS) -> np.ndarray:
    """Which pairs of signature rows survive all batches; dropped pairs aren't looked at again."""
    alive, agree, at = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in zip(BATCHES, least_agreement(threshold, miss), strict=True):
        agree[alive] += (a[alive, at:n] == b[alive, at:n]).sum(1)
        alive, at = alive[agree[alive] >= least], n
    return alive


def _signature_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, BANDS * ROWS)


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, id) for each band; the bucket is a hash of the band's number and minima."""
    each = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("signature", b * ROWS * 4 + 1, F.lit(ROWS * 4))))
    return classes.select("id", F.explode(each).alias("bucket"))


def deep_buckets(sets: list[np.ndarray], rows: int, threshold: float) -> np.ndarray:
    """A row of buckets for each non-empty set, one for each band of minima that no other band uses."""
    count = math.ceil(math.log(DEEP_MISS) / math.log1p(-(threshold**rows)))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    begin = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), count), np.uint64)
    for b in range(count if len(flat) else 0):
        value = np.full(len(sets), rows << 32 | b, np.uint64)
        for salt in np.random.default_rng([rows, b]).integers(1, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1):
            least = np.minimum.reduceat(((flat ^ salt >> np.uint64(7)) * salt >> np.uint64(32)).astype(np.uint32), begin)
            value = _mix(value * np.uint64(0x100000001B3) + least)
        out[:, b] = value
    return out.view(np.int64)


def _deeper(docs: DataFrame, hot: DataFrame, words: int, rows: int, threshold: float) -> DataFrame:
    """(bucket, id) for bands of more rows, of the classes (id, doc_id, body), whose texts are read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                found = deep_buckets(shingle_sets(part.column("text").to_pylist(), words), rows, threshold)
                ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))], ["id", "buckets"])

    once = _texts(docs, hot).mapInArrow(run, f"id {NODE}, buckets array<long>").dropDuplicates(["id"])
    return once.select("id", F.explode("buckets").alias("bucket"))


def _pruned(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) that the signatures leave plausible."""
    both = pairs.join(classes.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a").join(classes.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = pa.array(plausible(_signature_rows(batch.column("sa").to_pylist()), _signature_rows(batch.column("sb").to_pylist()), threshold))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(ok), batch.column("b").take(ok)], ["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, f"a {NODE}, b {NODE}")


def _small(df: DataFrame, count: int) -> DataFrame:
    return F.broadcast(df) if count <= BROADCAST_ROWS else df.hint("shuffle_hash")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the classes (id, doc_id, body), one row for each row of ``docs`` that has them."""
    return _identified(docs).join(_small(ids, ids.count()), ["doc_id", "body"]).select("id", "text")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles): the whole sets of the classes (id, doc_id, body), whose texts are read again."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                found = shingle_sets(part.column("text").to_pylist(), words)
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "shingles"])

    return _texts(docs, ids).mapInArrow(sets, f"id {NODE}, shingles array<long>").dropDuplicates(["id"])


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int, kept: Scratch) -> DataFrame:
    """Pairs whose whole shingle sets reach the similarity: 100 * intersection >= percent * union."""
    ids = kept.publish(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes.select("id", "doc_id", "body"), "id"), "minhash-ids")
    known = kept.publish(_sets(docs, ids, words), "minhash-sets")
    both = pairs.join(known.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(known.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    # compared row by row in the JVM: batches of pairs with both sets would not have a bounded size
    common = F.size(F.array_intersect("sa", "sb"))
    return kept.publish(both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "minhash-links")


def _open(bands: DataFrame, known: DataFrame) -> DataFrame:
    """(bucket, id, component, n): the classes of buckets with several components, and their number there.

    Of buckets of the same classes, told by 128 bits, one is enough.
    """
    rows = bands.join(known.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    members = [F.bit_xor(F.xxhash64(F.lit(k), "id")).alias(f"m{k}") for k in range(2)]
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), *members).where("low <> high")
    return rows.join(mixed.groupBy("n", "m0", "m1").agg(F.min("bucket").alias("bucket")).select("bucket", "n"), "bucket")


def _rest(docs: DataFrame, classes: DataFrame, known: DataFrame, words: int, percent: int, kept: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (a, b) of different components that share a bucket and may reach the similarity, and (bucket, id) of hot buckets, if there are any.

    Of the pairs in hot buckets those that deeper bands miss are left to :func:`_exactly`.
    """
    open_ = kept.publish(_open(_bands(classes), known), "minhash-open")
    most = open_.agg(F.max("n").alias("n")).first()["n"] or 0
    meeting = open_.where(F.col("n") <= HOT)
    rows, first = ROWS, open_.where(F.col("n") > HOT).select("bucket", "id") if most > HOT else None
    while most > HOT:
        rows += min(STEP, math.ceil(math.log(most / HOT) / -math.log(TEMPLATE)))
        hot = kept.publish(open_.where(F.col("n") > HOT).select("id").distinct().join(classes.select("id", "doc_id", "body"), "id"), "minhash-hot")
        deeper = kept.publish(_deeper(docs, hot, words, rows, percent / 100), "minhash-deep")
        open_ = kept.publish(_open(deeper, known), "minhash-open")
        last, most = most, open_.agg(F.max("n").alias("n")).first()["n"] or 0
        meeting = meeting.unionByName(open_.where(F.col("n") <= HOT))
        # classes that deeper buckets don't part are alike indeed and meet exactly
        if most > PARTED * last:
            break
    return _met(meeting, classes, percent, MISS, BLOCK), first


def _exactly(docs: DataFrame, classes: DataFrame, hot: DataFrame, known: DataFrame, words: int, percent: int, kept: Scratch) -> DataFrame:
    """Pairs (a, b) that may reach the similarity, all of the classes of buckets of ``hot`` (bucket, id) that still hold several components.

    Of the n shingles of a set, a set that reaches the similarity has ceil(percent * n / 100) at least.  So in any order of all shingles,
    one of the first n + 1 less that many is among the first of both.  Those of fewest classes come first, and those of one class lead nowhere.
    """
    left = kept.publish(_open(hot, known).select("id").distinct().join(classes.select("id", "doc_id", "body"), "id"), "minhash-hot")
    sets = kept.publish(_sets(docs, left, words), "minhash-sets")
    each = sets.select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    often = kept.publish(each.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"), "minhash-often")
    ordered = each.join(_small(often, often.count()), "shingle").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("known"))
    first = F.greatest(F.lit(0), F.size("known") + 1 - F.ceil(F.col("size") * percent / 100).cast("int"))
    buckets = kept.publish(ordered.select("id", F.explode(F.slice("known", F.lit(1), first)).alias("e")).select(F.col("e.shingle").alias("bucket"), "id"), "minhash-first")
    return _met(kept.publish(_open(buckets, known), "minhash-open"), classes, percent, None, EXACT_BLOCK)


def _met(meeting: DataFrame, classes: DataFrame, percent: int, miss: float | None, size: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a bucket and may reach the similarity; without ``miss`` none is lost.

    Members of a bucket are dealt into blocks of about ``size`` by a hash; each pair of blocks is one group.
    """
    dealt = meeting.withColumn("blocks", F.ceil(F.col("n") / size).cast("int")).withColumn("block", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
    full = dealt.join(classes.select("id", "signature", "bitmap", "n_shingles"), "id")
    # block i meets block j in the group (i, j), i <= j
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    spread = full.withColumn("meet", F.explode(meets)).select("bucket", "meet.i", "meet.j", "block", "id", "component", "signature", "bitmap", "n_shingles")

    def each(keys: list[np.ndarray], rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        u, v = _block_pairs(keys, rows, percent, miss)
        ids = rows.column("id")
        yield pa.RecordBatch.from_arrays([_flat(ids.take(pa.array(u))), _flat(ids.take(pa.array(v)))], ["a", "b"])

    found = spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id").mapInArrow(grouped(["bucket", "i", "j"], each), f"a {NODE}, b {NODE}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _block_pairs(keys: list[np.ndarray], rows: pa.RecordBatch, percent: int, miss: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of different components within a group that signatures, if some may be missed, and bitmaps leave possible."""
    marks = _signature_rows(rows.column("signature").to_pylist())
    maps = np.frombuffer(b"".join(rows.column("bitmap").to_pylist()), np.uint64).reshape(len(marks), -1)
    size, bits = rows.column("n_shingles").to_numpy(), np.bitwise_count(maps).sum(1, dtype=np.int64)
    component = _flat(rows.column("component")).dictionary_encode().indices.to_numpy()
    block, i, j = rows.column("block").to_numpy(), keys[1], keys[2]
    found: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
    for a, b in zip(*runs(keys), strict=True):
        x = np.arange(a, b)
        if i[a] == j[a]:
            p, q = (x[k] for k in np.triu_indices(len(x), 1))
        else:
            p, q = (k.ravel() for k in np.meshgrid(x[block[x] == i[a]], x[block[x] == j[a]], indexing="ij"))
        apart = component[p] != component[q]
        p, q = p[apart], q[apart]
        for at in range(0, len(p), 1 << 14):
            u, v = p[at : at + (1 << 14)], q[at : at + (1 << 14)]
            if miss:
                ok = plausible(marks[u], marks[v], percent / 100, miss)
                u, v = u[ok], v[ok]
            shared = np.bitwise_count(maps[u] & maps[v]).sum(1, dtype=np.int64)
            # of a set's shingles at least so many are not the other's as its bits that the other lacks
            common = np.minimum(size[u] - bits[u], size[v] - bits[v]) + shared
            ok = common * (100 + percent) >= (size[u] + size[v]) * percent
            found.append(np.stack([u[ok], v[ok]]))
    u, v = np.concatenate(found, 1)
    return u, v


def grouped_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, body, n_shingles, component_id, kept and leads, one row per row of ``docs``.

    ``leads`` holds for the rows of each component's smallest doc_id that have its text, and for rows that link with nothing.
    """
    kept = Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = publish(describe(docs, words), "minhash-docs")
    linkable = told.where("set_key is not null and doc_id is not null")
    # written, so that the join shuffles both sides and can split a key of many copies
    least = kept.publish(linkable.groupBy("set_key").agg(F.min("doc_id").alias("least")), "minhash-least")
    # the number of a class orders classes by their smallest doc_id, and tells those of one doc_id apart
    number = (F.col("least").cast("decimal(20,0)") * F.lit(1 << 62).cast("decimal(19,0)") + F.col("mark")).cast(NODE)
    rows = linkable.join(least, ["set_key"]).where("doc_id = least")
    classes = publish(rows.select(number.alias("id"), "set_key", "signature", "bitmap", "n_shingles", "doc_id", "body").dropDuplicates(["id", "set_key"]), "minhash-classes")
    bands = _bands(classes)
    hubs = kept.publish(bands.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("bucket", "a"), "minhash-buckets")
    pairs = bands.withColumnRenamed("id", "b").join(hubs, "bucket").where("a <> b").select("a", "b").distinct()
    near = kept.publish(_pruned(pairs, classes, percent / 100), "minhash-hubs")
    first = _verified(docs, classes, near, words, percent, kept)
    known = components(first, "minhash-components", kept)
    met, hot = _rest(docs, classes, known, words, percent, kept)
    left = kept.publish(met.join(near, ["a", "b"], "left_anti"), "minhash-rest")
    links = first.unionByName(_verified(docs, classes, left, words, percent, kept))
    final = components(links, "minhash-components", kept)
    if hot:
        met = _exactly(docs, classes, hot, final, words, percent, kept)
        left = kept.publish(met.join(near.unionByName(left), ["a", "b"], "left_anti"), "minhash-rest")
        final = components(links.unionByName(_verified(docs, classes, left, words, percent, kept)), "minhash-components", kept)
    of_class = publish(classes.select("set_key", "id").join(final.withColumnRenamed("node", "id"), "id", "left").select("set_key", "id", F.coalesce("component", "id").alias("component")), "minhash-told")
    kept.remove()
    # the doc_id of a number is its quotient, which is made exact first
    one = F.lit(1 << 62).cast("decimal(19,0)")
    least_id = ((F.col("component") - F.pmod(F.col("component"), one)) / one).cast("long")
    out = told.select("doc_id", "body", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(of_class.select("set_key", least_id.alias("component_id"), (F.col("id") == F.col("component")).alias("own")), "set_key", "left")
    component = F.coalesce("component_id", "doc_id")
    same = component.eqNullSafe(F.col("doc_id"))
    return out.select("doc_id", "body", "n_shingles", component.alias("component_id"), same.alias("kept"), (same & F.coalesce("own", F.lit(True))).alias("leads"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``."""
    return grouped_documents(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
