"""Near-duplicate embeddings by NN-descent (operator 1).

Vectors are compared within their label and length by cosine in double
precision.  Equal vectors of a label form a class first, which counts its
members, so exact copies of any number are one node.

1. Seeds: in several tables nodes are sorted by label, random-hyperplane code and
   a projection; neighbours in this order are compared.
2. NN-descent: each node keeps its best neighbours.  In a round every node brings
   its neighbours and reverse neighbours together, whose similarities improve
   their lists.  Lists that are full of links (saturated) are doubled, up to
   ``LARGEST`` entries.  Lists only steer the search: of all pairs compared at a
   node a spanning forest of the links is kept beside them, so no link that was
   computed is lost to a full list.  Rounds end when the links stop growing.
   Nodes whose lists are full of links can hide other groups; one representative
   of each such component is searched again among those of others, and two
   components meet if members could link by their distance from it.
3. Edges at the threshold and these meetings give candidate components.  Each is compared in full,
   cut into blocks of ``BLOCK`` vectors, a pair of blocks a group: this counts
   all links in double precision, also those beyond the longest list, and keeps
   a spanning forest of true links, which gives the final components.
4. Audit: a sample of nodes is compared with all nodes by brute force; it grows
   until it holds ``AUDIT_LINKS`` links, all nodes or ``AUDIT_LARGEST`` nodes.  If
   fewer than ``RECALL`` of its links lie within components, descent goes on with
   new seeds, up to ``ATTEMPTS`` times; if that doesn't help, an error is raised.

Null vectors, vectors with null or non-finite components, zero or empty vectors,
null labels and null ids link with nothing.  Repeated rows of one vec_id, with one
vector or several, count as vectors of their own.  An empty table gives an empty table.  Extra columns are
ignored.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, grouped, publish, runs, table
from .components import components

TABLES = 6
ADJACENT = 4
NEIGHBOURS = 6
LARGEST = 24
ROUNDS = 4
BLOCK = 512
AUDIT = 256
AUDIT_LINKS = 400
AUDIT_LARGEST = 4096
AUDIT_SLICE = 512
RECALL = 0.995
ATTEMPTS = 3
#: Similarities in descent are in single precision; what they may be off near the threshold.
SLACK = 1e-5

log = logging.getLogger(__name__)


def usable(vector: Column) -> Column:
    """Whether a vector can link: components all finite and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def classes(vectors: DataFrame) -> DataFrame:
    """(id, least, body, n, space, dims, unit): a row per distinct vector of a label; unit is its direction as doubles.

    ``least`` is its smallest vec_id, which with ``body``, a hash, tells classes apart; ``id`` numbers them and is fixed once
    the table is written.
    """
    alike = vectors.where("label is not null and vec_id is not null").where(usable(F.col("embedding"))).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for v in batch.column("embedding"):
                x = np.array(v.values, np.float64)
                scaled = x / np.abs(x).max()  # so that squares neither overflow nor vanish
                units.append((scaled / np.sqrt(scaled @ scaled)).tobytes())
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], [*carried, "dims", "unit"])

    carried = ["least", "body", "n", "label"]
    rows = alike.select("least", F.xxhash64("label", "embedding").alias("body"), "n", F.col("label").cast("string").alias("label"), "embedding")
    found = rows.mapInArrow(run, "least long, body long, n long, label string, dims int, unit binary")
    return found.select(F.monotonically_increasing_id().alias("id"), "least", "body", "n", F.xxhash64("label", "dims").alias("space"), "dims", "unit")


def _connected(link: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the smallest position that links lead to."""
    label = np.arange(len(link))
    while True:
        reach = np.where(link, label[None, :], len(link)).min(1)
        new = np.minimum(label, reach)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _vectors(rows: pa.Table, a: int, b: int, kind=np.float32) -> np.ndarray:
    raw = rows.column("vector").slice(a, b - a).to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(b - a, -1)


def seeds(nodes: DataFrame, count: int, attempt: int) -> DataFrame:
    """(u, v, sim) of nodes that stand near each other in some table's order, both ways."""
    bits = min(24, max(4, int(math.log2(max(2, count / 16)))))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims in np.unique(batch.column("dims").to_numpy()).tolist():
                part = batch.filter(pa.compute.equal(batch.column("dims"), dims))
                x = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float32).reshape(part.num_rows, dims)
                for t in range(TABLES):
                    planes = np.random.default_rng([attempt, t, dims]).normal(size=(dims, bits + 1)).astype(np.float32)
                    p = x @ planes
                    code = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), part.column("space"), pa.array(code), pa.array(p[:, bits].astype(np.float64)), part.column("id"), part.column("vector")],
                        ["t", "space", "code", "place", "id", "vector"],
                    )

    rows = nodes.mapInArrow(coded, "t int, space long, code long, place double, id long, vector binary")
    ordered = rows.repartitionByRange("t", "space", "code", "place").sortWithinPartitions("t", "space", "code", "place", "id")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            t, space, ids = (now.column(k).to_numpy() for k in ("t", "space", "id"))
            for a, b in zip(*runs([t, space]), strict=True):
                x, own = _vectors(now, a, b), ids[a:b]
                for k in range(1, min(ADJACENT, b - a - 1) + 1):
                    sim = np.einsum("ij,ij->i", x[:-k], x[k:]).astype(np.float64)
                    u, v = own[:-k], own[k:]
                    yield pa.RecordBatch.from_arrays([pa.array(np.r_[u, v]), pa.array(np.r_[v, u]), pa.array(np.r_[sim, sim])], ["u", "v", "sim"])
            held = now.slice(max(0, now.num_rows - ADJACENT))

    return ordered.mapInArrow(near, "u long, v long, sim double").where("u <> v")


def _no_length() -> Column:
    return F.lit(None).cast("int").alias("length")


def best(edges: DataFrame) -> DataFrame:
    """Edges with ``listed`` for the best neighbours of each node: NEIGHBOURS, or the ``length`` that some edge of the node tells.

    Edges with ``link`` stay whether listed or not.  ``place`` ranks a node's edges; ``size`` and ``worst`` are its list's length
    and last similarity, so that lists need no further shuffle.
    """
    # dealt by u once, for the aggregation and the windows alike
    each = edges.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("link").alias("link"), F.max("length").alias("length"))
    own = Window.partitionBy("u")
    ranked = each.withColumn("place", F.row_number().over(own.orderBy(F.desc("sim"), "v"))).withColumn("listed", F.col("place") <= F.coalesce(F.max("length").over(own), F.lit(NEIGHBOURS)))
    ranked = ranked.withColumn("size", F.sum(F.col("listed").cast("int")).over(own)).withColumn("worst", F.min(F.when(F.col("listed"), F.col("sim"))).over(own))
    return ranked.where("listed or link").select("u", "v", "sim", "link", "listed", "place", "size", "worst")


def _length(threshold: float) -> Column:
    """The next length of a node's list: twice as long if it is saturated."""
    return F.when(F.col("worst") >= threshold, F.least(F.col("size") * 2, F.lit(LARGEST))).otherwise(F.greatest("size", F.lit(NEIGHBOURS))).cast("int")


def limits(graph: DataFrame, threshold: float) -> DataFrame:
    """(u, worst): the similarity that a further neighbour of a node must exceed, -2 if its list is saturated or short."""
    return graph.where("place = 1").select("u", F.when((F.col("worst") >= threshold) | (F.col("size") < NEIGHBOURS), -2.0).otherwise(F.col("worst")).alias("worst"))


def descend(nodes: DataFrame, graph: DataFrame, state: DataFrame, threshold: float) -> DataFrame:
    """Candidate edges (u, v, sim, link) from neighbours of neighbours, both ways, where they improve a list.

    Besides, edges with ``link`` connect, at each node, what pairs at the threshold connect there.
    """
    graph = graph.where("listed")
    back = graph.select(F.col("v").alias("via"), F.col("u").alias("id"), "sim")
    ranked = back.withColumn("place", F.row_number().over(Window.partitionBy("via").orderBy(F.desc("sim"), "id"))).where(F.col("place") <= LARGEST)
    around = graph.select(F.col("u").alias("via"), F.col("v").alias("id")).unionByName(ranked.select("via", "id")).distinct()
    own = state.select(F.col("u").alias("via"), F.col("u").alias("id"))
    known = nodes.select("id", "vector").join(state.select(F.col("u").alias("id"), "worst"), "id", "left")
    rows = around.unionByName(own).join(known, "id").select("via", "id", F.coalesce("worst", F.lit(-2.0)).alias("worst"), "vector")

    def each(keys: list[np.ndarray], held: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, worst = held.column("id").to_numpy(), held.column("worst").to_numpy()
        out: list[tuple[np.ndarray, ...]] = []
        for a, b in zip(*runs(keys), strict=True):
            if b - a < 2:
                continue
            x = _vectors(held, a, b)
            sim = x @ x.T
            np.fill_diagonal(sim, -3)
            i, j = np.nonzero(sim > worst[a:b, None])
            out.append((ids[a + i], ids[a + j], sim[i, j].astype(np.float64), np.zeros(len(i), np.int64)))
            link = sim >= threshold - SLACK
            if link.any():
                label = _connected(link)
                i = np.flatnonzero(label != np.arange(b - a))
                out.append((ids[a + i], ids[a + label[i]], sim[i, label[i]].astype(np.float64), np.ones(len(i), np.int64)))
        if out:
            u, v, s, kept = (np.concatenate(c) for c in zip(*out, strict=True))
            # the same pair meets at several nodes
            first = np.unique(np.stack([u, v, kept], 1), axis=0, return_index=True)[1]
            yield pa.RecordBatch.from_arrays([pa.array(u[first]), pa.array(v[first]), pa.array(s[first]), pa.array(kept[first] > 0)], ["u", "v", "sim", "link"])

    return rows.repartition("via").sortWithinPartitions("via", "id").mapInArrow(grouped(["via"], each), "u long, v long, sim double, link boolean").where("u <> v")


def _linking(graph: DataFrame, threshold: float) -> DataFrame:
    """(a, b): edges that connect candidates."""
    return graph.where(F.col("link") | (F.col("sim") >= threshold - SLACK)).select(F.col("u").alias("a"), F.col("v").alias("b"))


def meetings(nodes: DataFrame, graph: DataFrame, candidates: DataFrame, threshold: float, attempt: int, scratch: Scratch) -> DataFrame | None:
    """(a, b): representatives of components with full lists, of which members could link; None if there are none."""
    full = graph.where("place = 1").where((F.col("size") >= NEIGHBOURS) & (F.col("worst") >= threshold - SLACK)).select(F.col("u").alias("node"))
    held = scratch.publish(candidates.join(full, "node").join(nodes.withColumnRenamed("id", "node"), "node").select("component", "node", "vector"), "vector-full")
    chosen = scratch.publish(held.groupBy("component").agg(F.min("node").alias("id")), "vector-chosen")
    count = chosen.count()
    if count < 2:
        return None
    reps = scratch.publish(nodes.join(chosen.select("id"), "id"), "vector-reps")
    pairs = held.join(chosen.join(reps.select("id", F.col("vector").alias("other")), "id"), "component").select("id", "vector", "other")

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = [float(np.dot(np.frombuffer(x, np.float32), np.frombuffer(y, np.float32))) for x, y in zip(batch.column("vector").to_pylist(), batch.column("other").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sims, pa.float64())], ["id", "sim"])

    angle = lambda sim: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sim)))
    radius = scratch.publish(pairs.mapInArrow(apart, "id long, sim double").groupBy("id").agg(angle(F.min("sim") - SLACK).alias("radius")), "vector-radius")
    edges = scratch.publish(seeds(reps, count, attempt).select("*", F.lit(False).alias("link"), _no_length()), "vector-rep-edges")
    for _ in range(2):
        around = scratch.publish(best(edges), "vector-rep-graph")
        edges = scratch.publish(edges.unionByName(descend(reps, around, limits(around, 2.0), 2.0).select("*", _no_length())).dropDuplicates(["u", "v"]), "vector-rep-edges")
    of = lambda n: radius.select(F.col("id").alias(n), F.col("radius").alias(f"r{n}"))
    near = edges.join(of("u"), "u").join(of("v"), "v").where(angle(F.col("sim") + SLACK) <= F.lit(math.acos(threshold - SLACK)) + F.col("ru") + F.col("rv"))
    met = scratch.publish(near.select(F.col("u").alias("a"), F.col("v").alias("b")), "vector-met")
    return None if met.isEmpty() else met


def exact_links(nodes: DataFrame, candidates: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(a, b, links): for each node its links' number in a pair of blocks, and a linked node of its own or b = a.

    All pairs within a candidate component are compared in double precision.  Edges (a, b) of a pair of blocks
    connect what links connect there.
    """
    rows = nodes.join(candidates.withColumnRenamed("node", "id"), "id").select("component", "id", "n", F.col("unit").alias("vector"))
    sizes = scratch.publish(rows.groupBy("component").agg(F.count("*").alias("size")), "vector-sizes")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rows.join(sizes, "component").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    spread = dealt.withColumn("meet", F.explode(meets)).select("component", "meet.i", "meet.j", "block", "id", "n", "vector")

    def each(keys: list[np.ndarray], held: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, n, block = (held.column(k).to_numpy() for k in ("id", "n", "block"))
        out = []
        for a, b in zip(*runs(keys), strict=True):
            x, own, many = _vectors(held, a, b, np.float64), ids[a:b], n[a:b]
            link = x @ x.T >= threshold
            np.fill_diagonal(link, False)
            if keys[1][a] != keys[2][a]:
                link &= block[a:b, None] != block[None, a:b]
            count = link @ many
            out.append((own, own[_connected(link)], count))
        a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c.astype(np.int64))], ["a", "b", "links"])

    sorted_ = spread.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "id")
    return sorted_.mapInArrow(grouped(["component", "i", "j"], each), "a long, b long, links long")


def audit(nodes: DataFrame, candidates: DataFrame, threshold: float, seed: int, count: int) -> tuple[float, int]:
    """Of a sample's links, by brute force against all nodes, the share within candidate components, and their number."""
    drawn = AUDIT
    while True:
        found, links = _audited(nodes, candidates, threshold, seed, drawn)
        if links >= AUDIT_LINKS or drawn >= min(count, AUDIT_LARGEST):
            return (found / links if links else 1.0), links
        drawn *= 4


def _audited(nodes: DataFrame, candidates: DataFrame, threshold: float, seed: int, drawn: int) -> tuple[int, int]:
    spark = nodes.sparkSession
    sample = nodes.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(drawn).select("id", "space", "unit").collect()
    if not sample:
        return 0, 0
    shared = spark.sparkContext.broadcast([(r["id"], r["space"], bytes(r["unit"])) for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            space, ids = batch.column("space").to_numpy(), batch.column("id").to_numpy()
            units = batch.column("unit").to_pylist()
            for s in {q[1] for q in shared.value}.intersection(space.tolist()):
                mine = [q for q in shared.value if q[1] == s]
                here = np.flatnonzero(space == s)
                x = np.frombuffer(b"".join([units[k] for k in here]), np.float64).reshape(len(here), -1)
                for k in range(0, len(mine), AUDIT_SLICE):
                    some = mine[k : k + AUDIT_SLICE]
                    q = np.frombuffer(b"".join([m[2] for m in some]), np.float64).reshape(len(some), -1)
                    i, j = np.nonzero(q @ x.T >= threshold)
                    a, b = np.array([m[0] for m in some], np.int64)[i], ids[here[j]]
                    yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    true = nodes.select("id", "space", "unit").mapInArrow(run, "a long, b long")
    of = lambda n: candidates.select(F.col("node").alias(n), F.col("component").alias(f"c{n}"))
    both = true.join(of("a"), "a", "left").join(of("b"), "b", "left").agg(F.count("*").alias("n"), F.sum((F.col("ca") == F.col("cb")).cast("long")).alias("found")).first()
    shared.unpersist()
    return both["found"] or 0, both["n"]


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``vectors`` (vec_id, embedding, label)."""
    scratch = Scratch(vectors.sparkSession)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    found = scratch.publish(classes(vectors), "vector-classes")
    nodes = scratch.publish(_with_single(found.select("id", "n", "space", "dims", "unit")), "vector-nodes")
    count = nodes.count()
    links, known, candidates = -1, None, None
    for attempt in range(ATTEMPTS):
        edges = seeds(nodes, count, attempt).select("*", (F.col("sim") >= threshold - SLACK).alias("link"), _no_length())
        graph = scratch.publish(best(edges if known is None else edges.unionByName(known)), "vector-graph")
        for _ in range(ROUNDS):
            further = descend(nodes, graph, limits(graph, threshold), threshold).select("*", _no_length())
            graph = scratch.publish(best(graph.select("u", "v", "sim", "link", _length(threshold).alias("length")).unionByName(further)), "vector-graph")
            now = _linking(graph, threshold).count()
            if now == links:
                break
            links = now
        known = graph.select("u", "v", "sim", (F.col("link") | (F.col("sim") >= threshold - SLACK)).alias("link"), _no_length())
        candidates = scratch.publish(components(_linking(graph, threshold), "vector-components", scratch), "vector-candidates")
        met = meetings(nodes, graph, candidates, threshold, attempt, scratch)
        if met is not None:
            joined = candidates.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(met)
            candidates = scratch.publish(components(joined, "vector-components", scratch), "vector-candidates")
        recall, audited = audit(nodes, candidates, threshold, attempt, count)
        log.info("attempt %d: %d link entries, audited recall %.4f of %d links", attempt, links, recall, audited)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"only {recall:.4f} of {audited} audited links were found in {ATTEMPTS} attempts, fewer than {RECALL}")
    exact = scratch.publish(exact_links(nodes, candidates, threshold, scratch), "vector-exact")
    final = components(exact.where("a <> b").select("a", "b"), "vector-components", scratch)
    counts = exact.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("others"))
    told = found.select("id", "least", "body", "n").join(counts, "id", "left").join(final.withColumnRenamed("node", "id"), "id", "left")
    told = publish(told.select("least", "body", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")), "vector-told")
    scratch.remove()  # what follows reads the input, told and tables made of them alone
    smallest = publish(told.groupBy("component").agg(F.min("least").alias("component_id")), "vector-smallest")
    told = told.join(smallest, "component").select("least", "body", "n_links", "component_id")
    # every row finds its class by its label and vector
    own = publish(vectors.where("label is not null and vec_id is not null").where(usable(F.col("embedding"))).groupBy("label", "embedding").agg(F.min("vec_id").alias("least")), "vector-ids")
    linkable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    key = F.when(linkable, F.xxhash64("label", "embedding"))
    keyed = own.select("least", F.col("label").alias("l"), F.col("embedding").alias("e"), F.xxhash64("label", "embedding").alias("key"))
    rows = vectors.join(keyed, (key == keyed["key"]) & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    out = rows.select("vec_id", "least", keyed["key"].alias("body")).join(told, ["least", "body"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def _with_single(found: DataFrame) -> DataFrame:
    """Add the direction in single precision, for descent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            single = [np.frombuffer(x, np.float64).astype(np.float32).tobytes() for x in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(single, pa.binary())], [*batch.schema.names, "vector"])

    return found.mapInArrow(run, "id long, n long, space long, dims int, unit binary, vector binary")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
