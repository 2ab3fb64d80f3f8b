"""Registered queries on a whole small table, against libraries and brute force."""

import hashlib
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from kinefold.llm import queries as registered  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def ran(spark, name):
    return registered.queries()[name](spark, SF).collect()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_vectors_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, label = np.array([r["vec_id"] for r in rows]), np.array([r["label"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    link = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    least = ids.copy()
    while True:
        new = np.minimum(least, np.where(link, least, least.max() + 1).min(1))
        if (new == least).all():
            break
        least = new
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ran(spark, "op1_embedding_near_dedup")}
    assert got == {i: (int(n), int(c), bool(i == c)) for i, n, c in zip(ids.tolist(), link.sum(1), least, strict=True)}


def test_packing_holds_every_id_once(spark, documents):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, windows = {}, {}
    for r in ran(spark, "op2_packing"):
        found.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(found) == set(documents)
    for i, pieces in found.items():
        ids, at = [*lib.encode(documents[i]["text"] or "", add_special_tokens=False).ids, 2], 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), crc(ids[at : at + p["length"]]))
            at += p["length"]
        assert at == len(ids)
    used = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        used += at
    assert used >= 0.9 * 4096 * (len(windows) - 1)


def test_languages_on_held_out_rows(spark, documents):
    rows = ran(spark, "op4_language_id")
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    judged = [(r["lang_pred"], documents[r["doc_id"]]["lang"]) for r in rows if r["held_out"] and documents[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    assert len(judged) > 20 and np.mean([a == b for a, b in judged]) > 0.9


def test_round_trip_is_the_librarys(spark, documents):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = ran(spark, "op7_bpe_round_trip")
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = lib.encode(documents[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), digest(",".join(map(str, ids))), digest(lib.decode(ids, skip_special_tokens=False)))


def test_records_in_order_of_documents(spark, documents):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, at = {r["doc_id"]: r for r in ran(spark, "op8_token_records")}, 0
    assert set(got) == set(documents)
    for i in sorted(documents):
        ids = [*lib.encode(documents[i]["text"] or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


def test_media_hold_the_texts(spark, documents):
    rows = ran(spark, "op10_flac_media")
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for r in rows:
        raw = (documents[r["doc_id"]]["text"] or "").encode()
        full = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
        x = np.frombuffer(full, np.uint8).astype(int) - 128
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
        assert r["feature"].startswith(f"n={len(x)};peak={np.abs(x).max()};energy={(x * x).sum()};") and r["media_bytes"] > 0
