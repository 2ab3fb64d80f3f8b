"""Tokenizer-based operators against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from kinefold.llm import bpe, packing, records, token_counts  # noqa: E402
from kinefold.llm.common import new_path, publish  # noqa: E402

TEXTS = [
    None, "", " ", "a", "  two  spaces ", "don't we'll I'VE", "line\n\n\nends \n x\n", "tab\there\r\nand\x0bthere", "<|endoftext|> in <|endoftext|>text", "naïve café — “quoted” 東京都 наука",
    "x" * 5000, "ab " * 3000, "\x1c odd \x85 spaces here", "1234567890 12.5% $3,000", "é" * 300, "ÿþ ÿ", "\0 zero \0", "Σίσυφος ΣΑΣ İstanbul", "a\n b\n\tc", "emoji 😀😀 ok", "same", "same",
]


def _noise(seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdetion é.,'\n  \tZ9<|>ßñ") for _ in range(rnd.randint(1, 400))) for _ in range(60)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    lib = Tokenizer.from_file(public_tokenizers.path(name))
    texts = TEXTS + _noise(1)
    for text, got in zip(texts, bpe.encoded(name, texts), strict=True):
        assert np.frombuffer(got, np.uint32).tolist() == lib.encode(text or "", add_special_tokens=False).ids, text


def test_greedy_is_verified():
    words = bpe.coder("byte_bpe_50k.json").words
    rnd = random.Random(7)
    some = [w.encode() for w in ("aaaaaaa", "x" * 200, *{"".join(rnd.choice("thereionasd") for _ in range(rnd.randint(2, 12))) for _ in range(400)})]
    ids, count, failed = words.encode_words(some)
    flat = np.frombuffer(b"".join(some), np.uint8)
    size = np.array([len(w) for w in some])
    exact, many = words.merge(flat, np.cumsum(size) - size, size)
    assert ids.tolist() == exact.tolist() and count.tolist() == many.tolist() and failed > 0


def _docs(spark, texts=TEXTS, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_round_trip(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in bpe.round_trip(_docs(spark)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_and_decode_columns(spark):
    docs = _docs(spark)
    back = bpe.decode(bpe.encode(docs, ids="Ids"), ids="Ids").collect()
    assert all((r["text"] or "") == r["decoded"] for r in back)
    assert bpe.encode(docs.limit(0)).count() == 0


def test_records(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = _docs(spark).unionByName(spark.createDataFrame([(None, "null id"), (3, "again")], "doc_id long, text string"))
    path = new_path(spark, "test-records")
    manifest = publish(records.write_records(docs, path), "test-manifest")
    got = sorted(records.read_records(records.with_bases(manifest), path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 0, 1, 2, 3, 3, *range(4, len(TEXTS))]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    for i in set(range(len(TEXTS))) - {3}:
        ids = np.array([*lib.encode(TEXTS[i] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert next(r for r in got if r["doc_id"] == i)["ids_crc32"] == zlib.crc32(ids)
    first = min(manifest.collect(), key=lambda r: r["part"])
    two, one = records.fetch(path, first["file"], [1, 0])
    assert (one[0], two[0]) == (None, 0)
    empty = records.write_records(docs.limit(0), new_path(spark, "test-none"))
    assert empty.count() == 0


def test_damaged_records_are_refused():
    frame = records.framed(records.pack(5, np.array([1, 2, 70000], "<u4").tobytes(), 4))
    assert records.unpack(next(records.frames(iter([frame[:9], frame[9:]]))))[1].tolist() == [1, 2, 70000]
    for damaged in (frame[:-1], frame[:20] + bytes([frame[20] ^ 1]) + frame[21:], bytes([frame[0] ^ 1]) + frame[1:]):
        with pytest.raises(ValueError):
            list(records.frames(iter([damaged])))


def test_packing(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = TEXTS + _noise(2) + ["word " * 9000]
    got = packing.pack(_docs(spark, texts), group_rows=30).toPandas()
    for i, t in enumerate(texts):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        mine = got[got.doc_id == i].sort_values("start")
        assert mine.length.sum() == len(ids) == mine.doc_tokens.iloc[0]
        at = 0
        for r in mine.itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 4096
    assert packing.pack(_docs(spark).limit(0)).count() == 0
    repeated = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string")
    assert packing.pack(repeated).count() == 3


def test_best_fit_is_the_tightest():
    rnd = np.random.default_rng(3)
    sizes = rnd.integers(1, 101, 500)
    window, offset = packing.best_fit(sizes, 100)
    room: list[int] = []
    for k in np.argsort(-sizes, kind="stable"):
        fitting = [r for r in room if r >= sizes[k]]
        before = 100 - offset[k]
        assert before == (min(fitting) if fitting else 100)
        if fitting:
            room.remove(before)
        room.append(before - sizes[k])
    assert np.bincount(window, sizes).max() <= 100


def test_edited_counts(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    rnd = random.Random(4)
    learn = token_counts.counts(token_counts.VOCAB).learn
    for text in [t or "" for t in TEXTS] + _noise(5):
        pieces = token_counts.groups(text)
        assert "".join(pieces) == text
        leaves = np.array([[learn([p])[0], len(p)] for p in pieces] or [[0, 0]], np.int32)
        places = sorted(rnd.sample(range(len(text) + 1), min(4, len(text) + 1)))
        edits = [(a, rnd.randint(0, b - a), rnd.choice(["", " ", "  ", "new", " x\n"])) for a, b in zip(places, [*places[1:], len(text)], strict=True)]
        new = text
        for a, n, s in reversed(edits):
            new = new[:a] + s + new[a + n :]
        nodes, after, _ = token_counts.edited(pieces, token_counts.tree(leaves), edits, lambda t: learn([t])[0] if t else 0)
        assert "".join(after) == new and nodes[1].tolist() == [count(new), len(new)]
    rows = [(1, "a b c", [(0, 1, "x")]), (2, None, None), (3, "tail", [(99, 5, " end"), (None, None, None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,removed:long,inserted:string>>")
    got = {r["doc_id"]: r for r in token_counts.edit(token_counts.build(docs), "edits").collect()}
    assert (got[1]["n_tokens_after"], got[2]["n_tokens"], got[2]["n_tokens_after"]) == (count("x b c"), 0, 0)
    assert got[3]["n_tokens_after"] == count("tail end")
    with pytest.raises(ValueError):
        token_counts.edited(["abc"], token_counts.tree(np.array([[1, 3]], np.int32)), [(0, 2, ""), (1, 1, "")], len)


def test_counts_query(spark, tmp_path):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    texts = [*TEXTS, *_noise(9), "line\n" * 400, " \n x\ty " * 300, "one\n\ntwo", "x" * 30000]
    rows = [(k, t, "en" if k % 3 else None, "web" if k % 2 else None) for k, t in enumerate(texts)] + [(1, texts[1], "en", "web"), (None, "no id", "en", "web")]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in token_counts.op9_token_counts(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t, lang, source in rows:
        t = t or ""
        half, cut = len(t) // 2, min(24, len(t) - len(t) // 2)
        new = f"{source or '?'}:\n" + t[:half] + " [cut] " + t[half + cut :] + f" #{lang or '?'}"
        want.append((i, count(t), 3, count(new), len(new)))
    assert [x[:5] for x in got] == sorted(want, key=str)
    assert all(e <= n for *_, n, e in got)
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert token_counts.op9_token_counts(spark, str(tmp_path / "none")).count() == 0
    clash = spark.createDataFrame([(1, "a b", 7, "s", [(0, 0, "x")])], "doc_id long, text string, N_TOKENS int, token_tree string, edits array<struct<start:long,removed:long,inserted:string>>")
    built = token_counts.build(clash)
    assert built.columns[-1] == "_token_tree"
    assert token_counts.edit(built, "edits", state="_token_tree").first().asDict()["_n_tokens"] == count("a b")
