"""Ranked lexical search, whitening and nearest neighbours against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kinefold.llm import lexical, multi_index, whitening
from kinefold.llm import queries as registered

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=10):
    held = [(doc, len(t), Counter(t)) for doc, text in docs if (t := terms(text))]
    n_docs, total = len(held), sum(n for _, n, _ in held)
    df = Counter(w for _, _, c in held for w in c)
    out = []
    for item, text in sorted(set(items), key=repr):
        found = []
        for doc, n, tf in held:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * tf[w]) // (1000 * tf[w] + 8 * m)) for w in terms(text) if tf[w])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def prose(seed, docs, words=60):
    """Texts with frequent and rare words, nulls, odd characters, ties and repeated rows."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["Ünïcode", "naïve", "日本", "xİy", "—dash"]
    draw = lambda n: rnd.choice(" \n-.\x00\x1c").join(vocabulary[min(len(vocabulary) - 1, int(rnd.paretovariate(0.7)) - 1)] for _ in range(n))
    texts = [draw(rnd.randint(1, words)) for _ in range(docs)]
    rows = list(enumerate(texts)) + [(900 + i, t) for i, t in enumerate([None, "", " ,;", "W3 W3 w3", "only-W7"])]
    rows += [(5, texts[5]), (5, texts[5]), (6, "w1 another text w90"), (None, texts[7]), (None, "w2 w2 w50")]
    return rows, [(i, draw(rnd.randint(2, 25))) for i in range(9)] + [(20, None), (21, "..."), (22, "absentword"), (3, "w1 w2"), (None, "w5 w80 w5"), (4, "w0"), (4, "w0")]


@pytest.mark.parametrize(("block_docs", "part_items", "slice_bytes"), [(7, 3, 1 << 20), (1000, 256, 200)])
def test_ranked_search_against_brute_force(spark, block_docs, part_items, slice_bytes):
    docs, items = prose(1, 150)
    left = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, block int, score string").repartition(3)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    got = lexical.search(left, right, 10, block_docs, part_items, slice_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(docs, items)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "w1 w1")], docs.schema), items.limit(0)).count() == 0
    # the weight of a term that all documents hold can be 0, and then scores nothing
    assert lexical.search(spark.createDataFrame([(1, "w1")] * 2000, docs.schema), items).count() == 0


def test_long_texts_are_counted_piecewise(monkeypatch):
    text = ("Alpha beta," + "c" * 50 + " alpha\n") * 40
    whole = lexical.counted(text.encode())
    monkeypatch.setattr(lexical, "PIECE_BYTES", 16)
    assert lexical.counted(text.encode()) == whole == (160, Counter({b"alpha": 80, b"beta": 40, b"c" * 50: 40}))


def test_ranked_search_query_against_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    got = registered.queries()["op11_ranked_search"](spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(registered.oracle_sql()["op11_ranked_search"]).fetchall())


def whitened(x, components=8):
    """By numpy's eigenvectors of the whole covariance."""
    c = (len(x) * x - x.sum(0)) / len(x)
    e, u = np.linalg.eigh(c.T @ c / len(x))
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return c @ u / np.sqrt(e), e / np.trace(c.T @ c / len(x))


def test_whitening_query_against_numpy(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([r["embedding"] for r in table], float)).astype(np.int64) + 100_000
    want, share = whitened(x)
    rows = registered.queries()["op12_embedding_whitening"](spark, sf).orderBy("vec_id", "component").collect()
    assert len(rows) == 8 * len(x)
    got = np.array([r["whitened"] for r in rows]).reshape(-1, 8)
    got *= np.sign((got * want).sum(0))
    np.testing.assert_allclose(got, want, atol=1e-9)
    np.testing.assert_allclose([r["explained"] for r in rows[:8]], share, rtol=1e-10)
    deviation = np.square(len(x) * x - x.sum(0)).sum(1)
    assert [r["deviation"] for r in rows[::8]] == deviation.tolist()
    assert {r["n"] for r in rows} == {len(x)} and {r["identity_error"] for r in rows}.pop() < 1e-10


def fitted(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, id int, x int").repartition(2)
    rows = whitening.as_integers(df)
    return rows, whitening.fit(rows)


def test_whitening_drops_unfit_rows(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(40, 5)).tolist()
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0, 0.0, 0.0]]
    rows, model = fitted(spark, good + bad)
    want, _ = whitened(np.floor(1024 * np.array(good)).astype(np.int64) + 100_000, 5)
    got = np.array([r["whitened"] for r in whitening.whiten(rows, model).orderBy("id").collect()])
    np.testing.assert_allclose(np.abs(got), np.abs(want), atol=1e-9)
    assert model.n == 40 and whitening.identity_error(rows, model) < 1e-10


def test_whitening_without_variance(spark):
    rows, model = fitted(spark, [[1.0, 2.0, 3.0]] * 4)
    assert [r["whitened"] for r in whitening.whiten(rows, model).collect()] == [[None] * 3] * 4
    assert whitening.identity_error(rows, model) is None
    rows, model = fitted(spark, [[1.0, 2.0, 3.0], [2.0, 2.0, 3.0], [0.0, 2.0, 3.0]])
    got = whitening.whiten(rows, model).orderBy("id").collect()
    assert [abs(round(r["whitened"][0], 9)) for r in got] == [0, 1.224744871, 1.224744871] and all(r["whitened"][1:] == [None, None] for r in got)
    assert [r["deviation"] for r in got] == [0, (3 * 1024) ** 2, (3 * 1024) ** 2]
    assert fitted(spark, [None])[1] is None


def test_whitening_of_many_dimensions_is_certified(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 90)) * np.linspace(1, 2, 90)
    rows, model = fitted(spark, data.tolist())
    x = np.floor(1024 * data).astype(np.int64) + 100_000
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    np.testing.assert_allclose(model.values, e[::-1][:8], rtol=1e-12)
    np.testing.assert_allclose(np.abs(np.sum(model.vectors * u[:, ::-1][:, :8], 0)), 1, atol=1e-12)


def test_large_deviations_are_exact_or_null(spark):
    rows, model = fitted(spark, [[0.0, 1.0], [float(1 << 35), 1.0], [float(1 << 22), 3.0]])
    x = [[100_000, 101_024], [(1 << 45) + 100_000, 101_024], [(1 << 32) + 100_000, 103_072]]
    want = [sum((3 * v - s) ** 2 for v, s in zip(r, map(sum, zip(*x, strict=True)), strict=True)) for r in x]
    assert not model.exact and [r["deviation"] for r in whitening.whiten(rows, model).orderBy("id").collect()] == [v if v < 1 << 63 else None for v in want]


def nearest(rows, queries, k=10):
    """(query, rank, id, score) by brute force over distinct (id, vector)."""
    once = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for own, q in queries:
        found = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, q, strict=True))), i) for i, v in once if i != own)
        out[own] = found[:k]
    return out


def test_neighbours_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    table = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in table]), np.array([v for _, v in table])
    got = {}
    for r in registered.queries()["op13_nearest_neighbours"](spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    found = 0
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    for own, rows in got.items():
        distance = np.sqrt(np.square(x - x[ids == own]).sum(1))
        order = [int(i) for i in ids[np.lexsort((ids, distance))] if i != own][:10]
        assert [r["rank"] for r in rows] == list(range(1, 11))
        np.testing.assert_allclose([r["score"] for r in rows], [distance[ids == r["vec_id"]][0] for r in rows], rtol=1e-12)
        assert [(r["score"], r["vec_id"]) for r in rows] == sorted((r["score"], r["vec_id"]) for r in rows)
        found += len({r["vec_id"] for r in rows} & set(order))
    assert found >= 0.9 * 10 * len(got)


def _searched(spark, rows, recall=1.0, k=10):
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, shard int").repartition(3)
    out = {}
    for r in multi_index.search(df, df.where("vec_id % 100 = 0"), k, recall).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def test_neighbours_with_copies_ties_and_unfit_rows(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "SHARD", 16)
    monkeypatch.setattr(multi_index, "VISITS", 2)
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-3, 4, size=(400, 5)).astype(float)) if np.any(v)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(300)] + [(1100, [1.0, 1.0, 1.0, 1.0, 1.0])]
    bad = [(7, None), (700, [0.0] * 5), (800, [1.0, None, 0.0, 0.0, 0.0]), (900, [float("nan")] * 5), (None, [1.0] * 5), (600, [1.0, 2.0])]
    got = _searched(spark, rows + bad)
    want = nearest(rows, [(i, v) for i, v in rows if i % 100 == 0])
    assert {q: [(round(s, 9), i) for s, i in r] for q, r in got.items()} == {q: [(round(s, 9), i) for s, i in r] for q, r in want.items()}


def test_neighbours_of_few_rows(spark):
    assert _searched(spark, []) == {}
    assert _searched(spark, [(0, [1.0])]) == {}
    assert _searched(spark, [(0, [1.0]), (1, [3.0]), (2, [-1.0])]) == {0: [(2.0, 1), (2.0, 2)]}
    assert _searched(spark, [(1, [1.0, 0.0]), (2, [3.0, 1.0])]) == {}
    assert _searched(spark, [(0, [2.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 1.0])]) == {0: [(1.0, 3)]}


def test_pairs_of_centroids_come_by_distance():
    rng = np.random.default_rng(4)
    found = multi_index.Quantiser(np.zeros((9, 2)), np.zeros((7, 2)))
    a, b = rng.integers(0, 5, 9).astype(float), rng.integers(0, 5, 7).astype(float)
    sizes = rng.integers(0, 3, 63)
    seen = list(found.visits(a, b, sizes))
    assert sorted(seen) == np.flatnonzero(sizes).tolist()
    sums = [a[c // 7] + b[c % 7] for c in seen]
    assert sums == sorted(sums)
