"""Near duplicates, lines, personal data, languages, media and the pipeline on small fixtures."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from kinefold.llm import components, flac, langid, line_dedup, minhash, neardup_vectors, pii


def words(rnd, n):
    return " ".join("".join(rnd.choice("bcdfgklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(n))


def corpus(seed=1, groups=8):
    """Texts with exact and near copies, short and empty ones."""
    rnd, out = random.Random(seed), [None, "", " \n\t", "one", "one", "Two words", "two  WORDS"]
    for _ in range(groups):
        text = words(rnd, rnd.randint(30, 120)).split(" ")
        out.append(" ".join(text))
        for _ in range(rnd.randint(1, 5)):
            copy = list(text)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = "zzz"
            out.append(" ".join(copy))
    out.append(words(rnd, 4000))
    return out


def groups_of(sets, linked):
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("n", [4, 5])
def test_minhash_against_brute_force(spark, n):
    texts = corpus()
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    want = groups_of(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs.withColumnRenamed("doc_id", "doc_id"), n, 80).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_minhash_edges(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 2, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def family(rnd, members, size, edits):
    """Copies of one text with random words replaced: many pairs just below and above the threshold."""
    stem = words(rnd, size).split(" ")
    out = []
    for _ in range(members):
        copy = list(stem)
        for k in rnd.sample(range(size), rnd.randint(0, edits)):
            copy[k] = words(rnd, 1)
        out.append(" ".join(copy))
    return out


def shingle_sets(texts, n):
    split = [t.lower().split(" ") if t else [] for t in texts]
    return {i: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()) for i, w in enumerate(split)}


@pytest.mark.parametrize("hot", [1024, 4])
def test_minhash_query_on_a_family(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(minhash, "HOT", hot)
    rnd = random.Random(31)
    texts = family(rnd, 150, 200, 14) + family(rnd, 60, 60, 4) + [words(rnd, 30) for _ in range(100)] + ["a b c d"] * 3 + [None, ""]
    sets = shingle_sets(texts, 4)
    want = groups_of(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in minhash.op6_minhash_near_dedup(spark, str(tmp_path)).collect()}
    assert len(set(want.values())) < len(want) - 60
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(x) for i, x in sets.items()}


def test_minhash_hot_buckets_lose_no_link(spark, monkeypatch):
    """Pairs of hot buckets link also where the deeper bands miss them."""
    monkeypatch.setattr(minhash, "HOT", 4)
    monkeypatch.setattr(minhash, "_deeper", lambda docs, hot, *_: hot.select(minhash.F.xxhash64("id").alias("bucket"), "id"))
    rnd = random.Random(43)
    # 70 shingles of all, 4 of a pair, 9 of each: 74 of 92 in common in a pair, 70 of 96 else
    stem, own = words(rnd, 73), [words(rnd, 4) for _ in range(60)]
    texts = [f"{stem} {p} {words(rnd, 9)}" for p in own for _ in range(2)]
    sets = shingle_sets(texts, 4)
    want = groups_of(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b))
    assert sorted(want.values()) == [i - i % 2 for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 4, 80).collect()} == want


@pytest.mark.parametrize("rows", [5, 8, 12, 16, 20])
def test_minhash_deep_buckets(rows):
    rng = np.random.default_rng(rows)
    sets = []
    for _ in range(400):
        x = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
        # 160 of 200 shingles of the union in common: 180 each
        sets += [np.unique(x[:180]), np.unique(x[20:])]
    found = minhash.deep_buckets(sets, rows, 0.8)
    assert (found[::2] == found[1::2]).any(1).mean() >= 0.97
    assert not (found[:-2:2] == found[3::2]).any()


def test_minhash_texts_of_one_id(spark):
    rnd = random.Random(5)
    x, y = words(rnd, 50), words(rnd, 60)
    rows = [(4, x), (4, y), (9, y), (7, x), (-3, x + " end"), (4, x), (None, x)]
    got = minhash.grouped_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"], r["leads"]) for r in got) == sorted([
        ("4", 46, -3, False, False), ("4", 56, 4, True, True), ("9", 56, 4, False, False), ("7", 46, -3, False, False),
        ("-3", 47, -3, True, True), ("4", 46, -3, False, False), ("None", 46, None, True, True),
    ])


def test_bayes_keeps_what_is_similar():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 32, (4000, 80), dtype=np.uint32)
    b = np.where(rnd.random((4000, 80)) < 0.82, a, a + 1).astype(np.uint32)
    far = np.where(rnd.random((4000, 80)) < 0.3, a, a + 1).astype(np.uint32)
    assert len(minhash.plausible(a, b, 0.8)) >= 3980 and len(minhash.plausible(a, far, 0.8)) < 40


def test_components(spark):
    edges = [(k + 1, k) for k in range(1, 40)] + [(100, 50), (50, 100), (7, 7), (60, 100), (None, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 50: 50, 60: 50, 100: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def lines_of(text):
    return [] if text is None else text.split("\n")


def kept_lines(rows, percent=80):
    occ = {}
    for i, t in rows:
        for k, line in enumerate(lines_of(t)):
            n = line.strip(" \t\r\f\x0b").lower()
            if n:
                occ.setdefault(n, []).append((-1 if i is None else i, k))
    sets = {n: {m[1] for m in re.finditer(r"(?s)(?=(.{12}))[^ \t\r\f\x0b\n]{1,8}", n + "\n" + n[:11].ljust(11, "\n"))} for n in occ}
    of = groups_of(sets, lambda a, b: 100 * len(a & b) >= percent * len(a | b))
    best = {}
    for n, places in occ.items():
        best[of[n]] = min(best.get(of[n], (1 << 60, 0)), *places)
    gone = {p for n, places in occ.items() for p in places if p != best[of[n]]}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(lines_of(t)) if (-1 if i is None else i, k) not in gone) for i, t in rows}


def test_line_dedup_against_brute_force(spark):
    rnd = random.Random(3)
    pool = [words(rnd, rnd.randint(1, 40)) for _ in range(40)]
    pool += [p.replace("a", "e", 1) for p in pool[:20]] + ["", "  ", "漢字" * 30, "漢字" * 29 + "x"]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))) for i in range(40)] + [(40, None), (41, ""), (None, pool[0] + "\n" + pool[1])]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, dropped string, row int").repartition(3)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == kept_lines(rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_lines_by_every_shingle(spark, tmp_path):
    rnd = random.Random(7)
    pool = [words(rnd, rnd.randint(1, 40)) for _ in range(60)]
    pool += [p[: len(p) // 2] + "x" + p[len(p) // 2 + 1 :] for p in pool[:50]] + ["abc", "abd", "漢字😀" * 20, "漢字😀" * 19 + "x"]
    lines = [p for p in pool for _ in range(2)]
    rnd.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 4 : i * 4 + 4])) for i in range(len(lines) // 4)]
    sets = {p: {p[k : k + 5] for k in range(max(1, len(p) - 4))} for p in pool}
    of = groups_of(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    assert sum(of[p] != p for p in pool) >= 30
    seen, want = set(), {}
    for i, t in rows:
        kept = []
        for line in t.split("\n"):
            if of[line] not in seen:
                kept.append(line)
            seen.add(of[line])
        want[i] = "\n".join(kept)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["text_sha256"] for r in line_dedup.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


@pytest.mark.parametrize("hot", [400, 4])
def test_lines_of_a_family(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rnd = random.Random(17)
    pool = list(dict.fromkeys(family(rnd, 300, 60, 12) + family(rnd, 200, 12, 1) + family(rnd, 60, 3, 1) + [words(rnd, rnd.randint(1, 30)) for _ in range(800)]))
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(5))) for i in range(400)]
    lines = sorted({x for _, t in rows for x in t.split("\n")})
    sets = dict(enumerate({x[k : k + 5] for k in range(max(1, len(x) - 4))} for x in lines))
    close = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    found = groups_of(sets, close)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = line_dedup.Scratch(spark)
    rows_ = line_dedup.depth(docs)
    told = line_dedup.publish(line_dedup.signed(line_dedup._distinct(line_dedup.keyed(docs)), rows_), "test")
    got = {r["node"]: r["component"] for r in line_dedup.links(line_dedup.keyed(docs), told, 80, line_dedup.every_shingle, rows_, kept).collect()}
    keys = {r["line"]: r["key"] for r in line_dedup.occurrences(docs).select("line", line_dedup._key(line_dedup.F.col("line"))).distinct().collect()}
    node = [got.get(keys[x], keys[x]) for x in lines]
    links = [(a, b) for a in sets for b in sets if a < b and close(sets[a], sets[b])]
    assert len(links) > 1000
    together = sum(node[a] == node[b] for a, b in links) / len(links)
    wrong = sum(node[a] == node[b] and found[a] != found[b] for a in sets for b in sets if a < b)
    print("links", len(links), "found", together)
    assert together >= 0.99 and wrong == 0


def pairs_near(rnd, length, low, high, n):
    """Pairs of lines of about this length whose Jaccard index is between low and high."""
    out = []
    letters = "abcdefghijklmnopqrstuvwxyz "
    while len(out) < n:
        a = "".join(rnd.choice(letters) for _ in range(length))
        edits = rnd.randint(0, max(1, length // 20))
        b = list(a)
        for _ in range(edits):
            b[rnd.randrange(len(b))] = rnd.choice(letters)
        b = ("".join(b) + "".join(rnd.choice(letters) for _ in range(rnd.randint(0, length // 4)))).strip()
        x, y = ({t[k : k + 5] for k in range(len(t) - 4)} for t in (a.strip(), b))
        if low <= len(x & y) / len(x | y) <= high:
            out.append((a.strip(), b))
    return out


@pytest.mark.parametrize("rows", [7, 8, 11, 14, 20])
def test_line_buckets_of_every_depth(spark, rows):
    rnd = random.Random(5)
    pairs = {n: pairs_near(rnd, n, 0.8, 0.84 if n < 30 else 0.82, 150) for n in (25, 60, 300)}
    pairs[0] = pairs_near(rnd, 300, 0.58, 0.62, 150)
    texts = list(dict.fromkeys(x for some in pairs.values() for pair in some for x in pair))
    lines = spark.createDataFrame(list(enumerate(texts)), "key long, line string").repartition(4, "key")
    found = {texts[r["key"]]: set(r["buckets"]) for r in line_dedup.signed(lines, rows).select("key", "buckets").collect()}
    share = {n: sum(bool(found[a] & found[b]) for a, b in some) / len(some) for n, some in pairs.items()}
    print(rows, share)
    assert min(share[n] for n in (25, 60, 300)) >= 0.97
    assert share[0] <= {7: 0.75, 8: 0.65, 11: 0.35, 14: 0.15, 20: 0.06}[rows]


@pytest.mark.parametrize("array", [1 << 18, 70])
def test_line_pairs_as_arrays_and_rows(spark, monkeypatch, array):
    """Pairs of lines beyond ARRAY characters are compared as rows, with the same result."""
    monkeypatch.setattr(line_dedup, "ARRAY", array)
    rnd = random.Random(11)
    pairs = pairs_near(rnd, 50, 0.7, 0.9, 20) + pairs_near(rnd, 120, 0.7, 0.9, 20) + [("abc", "abd"), ("x" * 200, "x" * 90)]
    texts = spark.createDataFrame([(k, x) for k, x in enumerate(x for pair in pairs for x in pair)], "key long, line string")
    keys = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(pairs))], "a long, b long")
    sets = [[{x[k : k + 5] for k in range(max(1, len(x) - 4))} for x in pair] for pair in pairs]
    want = {2 * k for k, (x, y) in enumerate(sets) if 100 * len(x & y) >= 80 * len(x | y)}
    got = [r["a"] for r in line_dedup._verified(texts, keys, 80, line_dedup.every_shingle).collect()]
    assert sorted(got) == sorted(want) and 0 < len(want) < len(pairs)
    counts = {r["key"]: r["n"] for r in line_dedup._bitmaps(texts, line_dedup.every_shingle).collect()}
    assert counts == {k: len(x) for k, x in enumerate(x for pair in sets for x in pair)}


def test_line_tables_that_are_broadcast(spark):
    """The driver holds what is broadcast, so tables of more than some 8 MB are shuffled."""
    texts = spark.createDataFrame([(1, "a")], "key long, line string")
    plan = lambda n: texts.join(line_dedup._small(texts.select("key"), n), "key")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(200_000) and "strategy=broadcast" not in plan(300_000)


def test_lines_that_share_a_key(spark, monkeypatch):
    """Different lines of one key are told apart by the second."""
    monkeypatch.setattr(line_dedup, "_key", lambda line: line_dedup.F.pmod(line_dedup.F.xxhash64(line), line_dedup.F.lit(7)).alias("key"))
    rnd = random.Random(8)
    pool = [words(rnd, 12) for _ in range(30)]
    rows = [(i, f"{pool[i % 30]}\n{pool[i * 7 % 30]} x") for i in range(60)]
    seen, want = set(), {}
    sets = {p: {p[k : k + 5] for k in range(len(p) - 4)} for _, t in rows for p in t.split("\n")}
    of = groups_of(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    for i, t in rows:
        want[i] = "\n".join(x for x in t.split("\n") if not (of[x] in seen or seen.add(of[x])))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cut=line_dedup.every_shingle)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want


def test_lines_of_texts_of_one_id(spark):
    a, b, c, d = "boilerplate line of some length", "second beta with other words", "a totally distinct important sentence", "third gamma, once more different"
    rows = [(1, a), (2, f"{a}\n{b}"), (2, f"{c}\n{d}"), (2, f"{a}\n{b}"), (3, f"{c}\r\n\t{d} \n"), (None, f"{b}\n\n")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, body int")
    got = {r["body"]: r["text"] for r in line_dedup.dedup_lines(docs, cut=line_dedup.every_shingle).collect()}
    assert got == {0: a, 1: "", 2: f"{c}\n{d}", 3: "", 4: "", 5: f"{b}\n\n"}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def test_base_spans_against_brute_force(spark):
    rnd = random.Random(6)
    bits = ["a@b.c", "x.y@d-e.co.uk", "@", "_", "a@b", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.00.1.2", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+49 30 1234 5678)", "é", "😀", " ", "\n", "12", "+", "5" * 40]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(300)] + [None, "", "1" * 20000, "a." * 20000 + "@b", "x@" + "b.c" * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: [tuple(x) for x in r["base_spans"]] for r in pii.with_spans(docs, pii.NO_TREES).collect()}
    for i, t in enumerate(texts):
        assert got[i] == base(t), t


def test_redaction_and_trees(spark):
    rows = [(1, "mail a@b.co and +1 555 123 4567!", "k"), (2, None, None), (3, "", "k"), (4, "clean", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs, pii.NO_TREES).collect()}
    assert got == {1: "mail <EMAIL> and <PHONE>!", 2: None, 3: "", 4: "clean"}
    x = np.random.default_rng(1).integers(0, 20, (600, 12)).astype(float)
    y = ((x[:, 1] > 9) & (x[:, 4] <= 10)).astype(float)
    trees = pii.boost(x, y)
    assert ((trees.score_rows(x) > 0) == (y > 0)).mean() > 0.98
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x[:50])], "i int, f array<double>")
    from pyspark.sql import functions as F

    scores = [r["s"] for r in frame.select("i", trees.score(F.col("f")).alias("s")).orderBy("i").collect()]
    assert np.allclose(scores, trees.score_rows(x[:50]))
    assert pii.fit(docs.limit(0)) == pii.NO_TREES


def test_added_spans_need_evidence(spark):
    rnd = random.Random(2)
    texts = [f"{words(rnd, 5)} call +1 (555) {rnd.randint(100, 999)}-{rnd.randint(1000, 9999)} {words(rnd, 3)}" for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trees = pii.fit(docs)
    for r in pii.with_spans(docs, trees).collect():
        assert [tuple(x) for x in r["base_spans"]] == base(r["text"]) and set(r["base_spans"]) <= set(r["spans"])


def test_pii_query_and_long_texts(spark, tmp_path):
    many = "a.b@c.de " * 3000
    texts = ["call +1 (555) 123-4567 or 10.0.0.1", many, None, "", "x" * 100000 + " 1.2.3.4", "number 4111 1111 1111 1111 " * 700, "1.2.3.4.5@ab.cd"]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[0])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = pii.op5_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = base(None if r["doc_id"] == 2 else dict(rows)[r["doc_id"]])
        shown = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        every = r["spans"].split(",") if r["spans"] else []
        assert set(shown.split(",") if shown else []) <= set(every) and r["n_spans"] == len(every) == len(spans) + r["n_added"]
    clash = spark.createDataFrame([(1, many + "é😀 1.2.3.4 end", "mine")], "doc_id long, text string, Spans string")
    out = pii.with_spans(clash, pii.NO_TREES).first()
    assert out["Spans"] == "mine" and len(out["_spans"]) == 3001
    assert pii.redact(clash, pii.NO_TREES).first()["text"] == "<EMAIL> " * 3000 + "é😀 <IP> end"


def test_disguised_spans_are_added(spark):
    rnd = random.Random(12)
    digit = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))

    def card(n):
        head = rnd.choice("456") + digit(n - 2)
        return next(head + c for c in "0123456789" if luhn(head + c))

    def parted(d, by):
        return by.join(d[k : k + 4] for k in range(0, len(d), 4))

    planted, rows = {}, []
    for i in range(2400):
        kind = i % 8
        lead, span = {
            0: ("", f"{words(rnd, 1)} [at] {words(rnd, 1)} [dot] org"),
            1: ("host ", f"{rnd.randint(1, 223)}.{rnd.randint(0, 255)}.{rnd.randint(0, 255)}[.]{rnd.randint(1, 254)}"),
            2: ("", parted(card(16), rnd.choice("./"))),
            3: ("card ", card(13)),
            4: ("call ", f"({rnd.randint(200, 999)}) {digit(3)}-{digit(4)}"),
            5: ("", card(16)),
            6: ("order ", digit(rnd.randint(9, 13))),
            7: ("part ", f"{rnd.randint(256, 999)}.{digit(3)}[.]{digit(3)}[.]{rnd.randint(256, 999)}"),
        }[kind]
        before = f"{words(rnd, 3)}, {lead}"
        rows.append((i, f"{before}{span}, {words(rnd, 3)}"))
        if kind < 5:
            planted[i] = (len(before), (0, 1, 2, 2, 3)[kind], len(before) + len(span))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    trees = pii.fit(docs)
    assert trees.kinds() == list(pii.KINDS)
    got = {r["doc_id"]: (r["base_spans"], {tuple(x) for x in r["spans"]}) for r in pii.with_spans(docs, trees).collect()}
    n_added = sum(len(spans) - len(b) for b, spans in got.values())
    assert n_added > 0
    for kind in range(5):
        mine = [i for i in planted if i % 8 == kind]
        assert sum(planted[i] in got[i][1] for i in mine) >= 0.9 * len(mine), kind
    noise = [i for i, _ in rows if i % 8 in (6, 7)]
    assert sum(bool(got[i][1]) for i in noise) <= 0.02 * len(noise)


def test_language_id(spark):
    rnd = random.Random(5)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "клмно"}
    rows = []
    for i in range(600):
        lang = rnd.choice(list(alphabets))
        rows.append((i, " ".join("".join(rnd.choice(alphabets[lang]) for _ in range(5)) for _ in range(rnd.randint(1, 60))), lang, "s"))
    rows += [(1000, None, "aa", None), (1001, "123 !!", "bb", None), (1002, "", None, None), (None, "abc abd", "aa", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, place string").repartition(3)
    model = langid.fit(langid.learnable(docs))
    got = langid.predict(docs, model).withColumn("held", langid.held_out()).toPandas()
    assert got[got.doc_id.isna()].held.all()
    held = got[got.held & (got.doc_id < 600)]
    assert len(held) > 90 and (held.lang == held.lang_pred).mean() > 0.99
    odd = got[got.doc_id >= 1000]
    assert (odd.lang_pred == "und").all() and (odd.score == 0).all() and odd.rejected.all()
    assert got.score.between(0, 1).all() and (got[got.doc_id < 600].rejected.mean() < 0.02)
    for i, row in enumerate(rows[:20]):
        assert (zlib.crc32(str(row[0]).encode()) % 4 == 2) == bool(got[got.doc_id == row[0]].held.iloc[0])
    none = langid.predict(docs, langid.fit(docs.where("lang = 'zz'"))).toPandas()
    assert (none.lang_pred == "und").all()
    assert langid.predict(docs.limit(0), model).count() == 0


def test_language_sample_is_bounded_and_whole(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(7, "same text of a hot document", "aa")] * 900 + [(7, f"text number {i} of it", "aa") for i in range(300)]
    rows += [(i, words(rnd, 4000), "bb") for i in range(40)] + [(i, "rare", f"z{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    drawn = langid.draw(docs, 200, 7)
    assert {r[0] for r in drawn} == {"aa", "bb"} and len(drawn) < 200
    long = [r for r in drawn if r[0] == "bb"]
    assert len(long) == 40 and all(abs(r[3].sum() - 1) < 1e-4 for r in drawn) and max(len(r[2]) for r in long) > 4096


def test_language_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "some text", 0.5, "x")], "doc_id long, text string, SCORE double, lang_pred string")
    for model in (None, langid.Model(["en"], np.zeros(((1 << langid.BITS) + 1, 1), np.float32), np.zeros(1))):
        out = langid.predict(docs, model)
        assert out.columns == ["doc_id", "text", "SCORE", "lang_pred", "_lang_pred", "_score", "rejected"]
        assert out.first()["SCORE"] == 0.5 and out.first()["_lang_pred"] == ("en" if model else "und")


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            center = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 7))):
                rows.append((k, (center + rng.normal(size=16) * 0.05).astype(np.float32).tolist(), label))
                k += 1
    big = rng.normal(size=16)
    for _ in range(80):
        rows.append((k, (big + rng.normal(size=16) * 0.02).astype(np.float32).tolist(), 1))
        k += 1
    rows += [(k, rows[0][1], 0), (k + 1, rows[0][1], 0), (k + 2, [0.0] * 16, 0), (k + 3, None, 0), (k + 4, [float("nan")] * 16, 0), (k + 5, [], 0), (k + 6, [None] + [1.0] * 15, 1), (k + 7, [1e-30] * 8, 0)]
    ok = {i: (np.array(v, float), lab) for i, v, lab in rows if v and None not in v and lab is not None and np.isfinite(v).all() and np.any(v)}

    def linked(a, b):
        (x, p), (y, q) = a, b
        return p == q and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98

    want = groups_of(ok, linked)
    n = {i: sum(linked(ok[i], ok[j]) for j in ok if j != i) for i in ok}
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r["vec_id"]: r for r in neardup_vectors.near_duplicates(docs).collect()}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert (got[i]["n_links"], got[i]["component_id"]) == (n.get(i, 0), want.get(i, i)), i
        assert got[i]["kept"] == (got[i]["component_id"] == i)
    assert neardup_vectors.near_duplicates(docs.limit(0)).count() == 0


def test_vectors_of_one_id(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.001], 1), (7, [0.0, 1.0], 1), (5, [1.0, 0.0], 2)]
    got = neardup_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == [(5, 0, 5, True), (5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False)]


def test_full_lists_hide_no_links(spark):
    rng = np.random.default_rng(4)
    first = rng.normal(size=64)
    first /= np.linalg.norm(first)
    aside = rng.normal(size=64)
    aside -= aside @ first * first
    second = 0.9815 * first + np.sqrt(1 - 0.9815**2) * aside / np.linalg.norm(aside)
    x = np.concatenate([c + rng.normal(size=(60, 64)) * 0.001 for c in (first, second)] + [rng.normal(size=(40, 64))]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = unit @ unit.T >= 0.98
    np.fill_diagonal(link, False)
    assert link[:60, 60:120].all()
    docs = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r["vec_id"]: r for r in neardup_vectors.near_duplicates(docs).collect()}
    want = groups_of(dict(enumerate(range(160))), lambda a, b: link[a, b])
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {i: (int(link[i].sum()), want[i]) for i in range(160)}


def test_audit_failure_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(neardup_vectors, "audit", lambda *a: (0.5, 10))
    docs = spark.createDataFrame([(i, [1.0, i / 100], 1) for i in range(5)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(RuntimeError, match="audited links"):
        neardup_vectors.near_duplicates(docs)


def test_flac_round_trip():
    rng = np.random.default_rng(2)
    payloads = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 2, 3, 5, 64, 1023, 1024, 1025, 9000)]
    payloads += [b"a" * 3000, (128 + 90 * np.sin(np.arange(5000) / 15)).astype(np.uint8).tobytes(), flac.payload("text é " * 900)[0], bytes(64)]
    media = flac.encode(payloads)
    assert [(x + 128).astype(np.uint8).tobytes() for x in flac.decode(media)] == payloads
    assert flac.decode([]) == []
    for damage in (media[8][:-3], media[8][:200] + bytes([media[8][200] ^ 4]) + media[8][201:], b"fLaX" + media[8][4:]):
        with pytest.raises(ValueError):
            flac.decode([damage])
    head = flac.parse(media[8])
    assert head["samples"] == 9000 and head["seek"][1][0] == flac.SEEK_EVERY * flac.BLOCK_SIZE


def test_flac_columns(spark):
    texts = [None, "", "x" * 64, "é😀 text", "long " * 9000, "long " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    media = flac.to_media(docs)
    got = {r["doc_id"]: r for r in flac.digests(media).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        full = raw + bytes((-len(raw)) % 64 or (64 if not raw else 0))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    assert got[4].asDict() | {"doc_id": 0} == got[5].asDict() | {"doc_id": 0}
    blocks = flac.pcm_blocks(media, 1000).where("doc_id = 4").orderBy("sample_offset").collect()
    assert [b["sample_offset"] for b in blocks] == list(range(0, 45056, 1000))
    assert np.concatenate([np.frombuffer(b["pcm"], "<i2") for b in blocks]).tolist() == [c - 128 for c in ("long " * 9000).encode() + bytes(56)]
    assert flac.digests(flac.to_media(docs.limit(0))).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    rnd = random.Random(8)
    texts = [words(rnd, 60) + "\n" + words(rnd, 20) + " a@b.co" for _ in range(40)]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)] + [(90, None, None, None, None), (91, "!!", None, None, 2), (92, texts[0], "en", "s", 5), (92, texts[0], "en", "s", 5), (None, texts[1], None, None, None)]
    path = tmp_path / "documents.parquet"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "minhash", "pii", "packing"]
    docs = spark.read.parquet(str(path))
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "language_id":
            assert {r["doc_id"] for r in docs.collect()} >= set(range(40)) and not docs.where("doc_id in (90, 91)").count()
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(range(2, 40)) <= set(kept) and all("a@b.co" not in t for t in kept.values())
    pieces = cp.run(spark, str(tmp_path)).toPandas()
    assert set(range(2, 40)) <= set(pieces.doc_id.dropna()) and pieces.groupby("sequence_id").length.sum().max() <= 4096
    empty = tmp_path / "none"
    spark.createDataFrame([], schema).write.parquet(str(empty / "documents.parquet"))
    assert cp.run(spark, str(empty)).count() == 0
