"""Byte-pair encoding by speculation and verification (operator 7).

A greedy longest match proposes the tokens of each word.  The proposal is the
exact encoding if and only if every adjacent pair of tokens is compatible, that
is, if byte-pair merging of the two tokens' bytes alone would keep them apart.
All pairs of all words are tested together in numpy; only words with a failing
pair undergo exact merging.

Results are the ones of the ``tokenizers`` library for the same vocabulary
file.  Words with characters above U+024F, and texts of special tokens, are
handed to the library itself, because Unicode tables of libraries differ there.

Null text counts as empty; an empty text has no tokens and decodes to an empty
text.  Rows are independent, so repeated rows, ties and extra columns of any
name have no influence; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ChunkTable, LibraryIds, joined, space_led, words_only
from .common import table, text_slices, vocabulary

#: Marks the end of a word inside keys; the byte never occurs in UTF-8.
END = b"\xff"
NONE = np.int64(1 << 40)
#: Words of more symbols are merged one by one with a heap.
MATRIX_WIDTH = 48
# U+001C to U+001F are white space to Python alone.
_FOREIGN = re.compile("[^\\x00-\\x1b\\x20-\\u012f\\u0131-\\u024f]|<\\|").search
#: Chunks that are empty or have white space at an edge, but for one leading space; a line end stands around each.
_OUTER_SPACE = re.compile(r"\n(?:[^\S ]| \s|(?<=\s\n)(?<!^\n))").search

# The pre-tokenizer patterns of the two vocabulary files.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An open-addressing table, at most an eighth full, as two arrays: keys and values."""
    bits = max(4, int(len(keys) * 8).bit_length())
    slots, out = np.full(1 << bits, EMPTY), np.full(1 << bits, -1, np.int64)
    todo, at = np.arange(len(keys)), _home(keys, bits)
    while len(todo):
        free = slots[at] == EMPTY
        slots[at[free]] = keys[todo[free]]  # of several for one slot, the last stays
        won = slots[at] == keys[todo]
        out[at[won]] = values[todo[won]]
        todo, at = todo[~won], (at[~won] + 1) & ((1 << bits) - 1)
    return slots, out


def _home(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _probe(slots: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Values of keys, or -1."""
    mask = len(slots) - 1
    at = _home(keys, mask.bit_length())
    found = slots[at]
    out = np.where(found == keys, values[at], -1)
    open_ = np.flatnonzero((found != keys) & (found != EMPTY))
    while len(open_):
        at[open_] = (at[open_] + 1) & mask
        found = slots[at[open_]]
        hit = found == keys[open_]
        out[open_[hit]] = values[at[open_[hit]]]
        open_ = open_[~hit & (found != EMPTY)]
    return out


class Vocabulary:
    """Tokens, merges and fast look-up tables of one vocabulary file."""

    #: Odd, so that it has an inverse modulo 2**64; hashes of equal bytes are equal wherever they stand.
    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, name: str):
        with open(vocabulary(name), encoding="utf-8") as f:
            model = json.load(f)
        suffix = model["model"]["end_of_word_suffix"] or ""
        letters, self.ends = byte_letters(), bool(suffix)
        special = {x["content"]: x["id"] for x in model["added_tokens"]}

        def raw(token: str) -> bytes:
            end = self.ends and token.endswith(suffix) and len(token) > len(suffix)
            return bytes(letters[c] for c in (token[: -len(suffix)] if end else token)) + END * end

        ids = model["model"]["vocab"]
        # the byte of END stands in no UTF-8 text, so its own tokens are left out
        self.ids: dict[bytes, int] = {k: i for t, i in ids.items() if t not in special and (not self.ends or END not in (k := raw(t))[: -1 if k.endswith(END) and len(k) > 1 else None])} if self.ends else {raw(t): i for t, i in ids.items() if t not in special}
        size = max([*ids.values(), *special.values()]) + 1
        self.pieces: list[bytes] = [b""] * size
        for key, i in self.ids.items():
            self.pieces[i] = key.removesuffix(END) + b" " * key.endswith(END)
        for text, i in special.items():
            self.pieces[i] = text.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([ids[a + b] if not self.ends else self.ids[raw(a) + raw(b)] for a, b in merges], np.int64)
        assert len(np.unique(made)) == len(made)
        self.rank = np.full(size + 1, -1, np.int64)
        self.rank[made] = np.arange(len(made))
        self.pair_table = _hash_table((left << 16 | right).astype(np.uint64), made)
        self.pair_ids = (left << 16 | right, made)
        self._edges(size, left, right, made)
        self.single, self.single_last = np.full(256, -1, np.int64), np.full(256, -1, np.int64)
        for b in range(256):
            self.single[b] = self.ids.get(bytes([b]), -1)
            self.single_last[b] = self.ids.get(bytes([b]) + END, -1)
        self._hashes()

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, or -1."""
        keys = (a << 16 | b).ravel()
        keys[((a < 0) | (b < 0)).ravel()] = -2
        return _probe(*self.pair_table, keys.view(np.uint64)).reshape(a.shape)

    def _edges(self, size: int, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        """For each token, the parts that border on its right and left neighbour while it is built.

        A part comes with the rank of the merge that consumes it: none for the token itself.
        """
        split = {True: np.full(size, -1, np.int64), False: np.full(size, -1, np.int64)}
        split[True][made], split[False][made] = right, left
        self.borders = {}
        for side, inner in split.items():
            parts, until = [np.arange(size)], [np.full(size, NONE)]
            while True:
                last = parts[-1]
                nxt = np.where(last >= 0, inner[last], -1)
                if not (nxt >= 0).any():
                    break
                parts.append(nxt)
                until.append(np.where(nxt >= 0, self.rank[last], -1))
            self.borders[side] = (np.stack(parts), np.stack(until))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a and b would leave exactly these two tokens.

        It would not if some bordering parts x of a and y of b merge before either is consumed
        by its own token.  Of equal ranks the merge further left comes first.
        """
        ok = np.ones(len(a), bool)
        (ends, ends_until), (starts, starts_until) = self.borders[True], self.borders[False]
        for i in range(len(ends)):
            rows = np.flatnonzero(ok & (ends[i][a] >= 0))
            if not len(rows):
                break
            for j in range(len(starts)):
                rows = rows[starts[j][b[rows]] >= 0]
                if not len(rows):
                    break
                made = self.merged(ends[i][a[rows]], starts[j][b[rows]])
                rank = np.where(made >= 0, self.rank[made], NONE)
                bad = (rank < ends_until[i][a[rows]]) & (rank <= starts_until[j][b[rows]]) & (made >= 0)
                ok[rows[bad]] = False
                rows = rows[~bad]
        return ok

    def greedy(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest-match tokens of all words at once: ids in word order, and the number for each word.

        ``flat`` holds the words' bytes; all words advance together, a token a step.
        """
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat.astype(np.uint64) * self.powers(len(flat)), dtype=np.uint64)])
        inverse = self.inverse(len(flat))
        end, at, rows = start + size, start.copy(), np.arange(len(start))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            here = at[rows]
            room = np.minimum(self.reach[flat[here].astype(np.int64) << 8 | flat[np.minimum(here + 1, len(flat) - 1)]], end[rows] - here)
            room = np.maximum(room, 1)
            token = np.full(len(rows), -1, np.int64)
            open_ = np.arange(len(rows))
            for n in range(int(room.max()), 0, -1):
                now = open_[room[open_] >= n]
                if self.ends:  # a word's last byte and its end are one symbol
                    now = now[here[now] + n != end[rows[now]] - 1]
                if len(now):
                    p = here[now]
                    got = self.by_hash((sums[p + n] - sums[p]) * inverse[p], n)
                    token[now] = got
                    at[rows[now[got >= 0]]] += n
                    open_ = open_[token[open_] < 0]
                if not len(open_):
                    break
            assert not len(open_)
            steps.append((rows, token))
            rows = rows[at[rows] < end[rows]]
        owner = np.concatenate([r for r, _ in steps]) if steps else np.zeros(0, np.int64)
        token = np.concatenate([t for _, t in steps]) if steps else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return token[order], np.bincount(owner, minlength=len(start))

    def powers(self, n: int) -> np.ndarray:
        if len(self._powers) < n:
            for name, base in (("_powers", int(self.BASE)), ("_inverse", pow(int(self.BASE), -1, 1 << 64))):
                each = np.full(n * 2 + 64, base, np.uint64)
                each[0] = 1
                setattr(self, name, np.cumprod(each))
        return self._powers[:n]

    def inverse(self, n: int) -> np.ndarray:
        self.powers(n)
        return self._inverse[:n]

    def by_hash(self, value: np.ndarray, n: int) -> np.ndarray:
        """Tokens of n bytes by the hash of their bytes, or -1."""
        hashes, ids = self.of_size.get(n, (None, None))
        if hashes is None:
            return np.full(len(value), -1, np.int64)
        return _probe(hashes, ids, value)

    def _hashes(self) -> None:
        self._powers = self._inverse = np.zeros(0, np.uint64)
        self.of_size, groups = {}, {}
        for key, i in self.ids.items():
            groups.setdefault(len(key), []).append((key, i))
        for n, found in groups.items():
            grid = np.frombuffer(b"".join(k for k, _ in found), np.uint8).reshape(-1, n).astype(np.uint64)
            value = (grid * self.powers(n)).sum(1, dtype=np.uint64)
            assert len(np.unique(value)) == len(value)
            self.of_size[n] = _hash_table(value, np.array([i for _, i in found], np.int64))
        self.reach = np.ones(1 << 16, np.int64)
        for n, found in sorted(groups.items()):
            if n > 1:
                self.reach[[k[0] << 8 | k[1] for k, _ in found]] = n

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of all words one after the other, the number for each word, and how many words failed the test."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        ids, count = self.greedy(flat, start, size)
        owner = np.repeat(np.arange(len(words)), count)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ok = self.compatible(ids[inside], ids[inside + 1])
        failing = np.unique(owner[inside[~ok]])
        if len(failing):
            fixed, many = self.merge(flat, start[failing], size[failing])
            keep = np.ones(len(words), bool)
            keep[failing] = False
            owner = np.concatenate([owner[keep[owner]], np.repeat(failing, many)])
            ids = np.concatenate([ids[np.repeat(keep, count)], fixed])[np.argsort(owner, kind="stable")]
            count[failing] = many
        return ids, count, len(failing)

    def merge(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact byte-pair merging of words: ids in word order, and the number for each word."""
        length = size - self.ends
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(length, kind="stable")
        for at in range(0, len(order), 8192):
            rows = order[at : at + 8192]
            rows = rows[length[rows] <= MATRIX_WIDTH]
            if not len(rows):
                continue
            columns = np.arange(int(length[rows].max()))
            inside = columns < length[rows][:, None]
            grid = self.single[flat[np.minimum(start[rows][:, None] + columns, len(flat) - 1)]]
            if self.ends:
                last = length[rows] - 1
                grid[np.arange(len(rows)), last] = self.single_last[flat[start[rows] + last]]
            grid[~inside] = -1
            grid = self._merge_grid(grid)
            used = grid >= 0
            parts.append((np.repeat(rows, used.sum(1)), grid[used]))
        for k in np.flatnonzero(length > MATRIX_WIDTH).tolist():
            symbols = self.single[flat[start[k] : start[k] + length[k]]]
            if self.ends:
                symbols[-1] = self.single_last[flat[start[k] + length[k] - 1]]
            got = np.array(self._merge_long(symbols.tolist()), np.int64)
            parts.append((np.full(len(got), k), got))
        owner = np.concatenate([o for o, _ in parts])
        ids = np.concatenate([i for _, i in parts])[np.argsort(owner, kind="stable")]
        return ids, np.bincount(owner, minlength=len(start))

    def _merge_grid(self, grid: np.ndarray) -> np.ndarray:
        rows, at = np.arange(len(grid)), np.arange(grid.shape[1])
        while len(rows) and grid.shape[1] > 1:
            now = grid[rows]
            made = self.merged(now[:, :-1], now[:, 1:])
            rank = np.where(made >= 0, self.rank[made], NONE)
            first = rank.argmin(1)
            live = rank[np.arange(len(rows)), first] < NONE
            rows, now, made, first = rows[live], now[live], made[live], first[live]
            if not len(rows):
                break
            now[np.arange(len(rows)), first] = made[np.arange(len(rows)), first]
            moved = np.where(at > first[:, None], np.concatenate([now[:, 1:], np.full((len(now), 1), -1)], 1), now)
            grid[rows] = moved
        return grid

    @lru_cache(maxsize=1)  # noqa: B019
    def _pairs(self) -> dict[int, int]:
        return dict(zip(*(x.tolist() for x in self.pair_ids), strict=True))

    def _merge_long(self, ids: list[int]) -> list[int]:
        """Merging of one long word in n log n steps."""
        pairs, rank, n = self._pairs(), self.rank, len(ids)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := pairs.get(ids[i] << 16 | ids[j])) is not None:
                heapq.heappush(heap, (int(rank[m]), i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if not alive[i] or ids[i] != a or (j := after[i]) >= n or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = pairs[a << 16 | b], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x, y in zip(ids, alive, strict=True) if y]


class ChunkCoder:
    """Ids of text chunks: words by speculation, foreign chunks by the library."""

    def __init__(self, name: str):
        self.words = Vocabulary(name)
        self.ends = self.words.ends
        self.library = LibraryIds(name, "<|endoftext|>")
        pattern = WORD_PATTERN + "|\n" if self.ends else BYTE_LEVEL_PATTERN
        self.fold = str.lower if self.ends else str
        # below U+0250 the character classes are spelt out, for the faster standard module
        for name in "LN":
            members = "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == name)
            pattern = pattern.replace(f"[\\p{{{name}}}]", f"[{members}]").replace(f"\\p{{{name}}}+", f"[{members}]+").replace(f"\\p{{{name}}}", members)
        self.find = re.compile(pattern).findall
        self.cut = words_only if self.ends else space_led
        self.failed = self.seen = 0

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of all chunks one after the other, and where each chunk's ids end.

        Chunks are cut into words in one call, with a line end between them, which is a word of its own
        there.  Chunks with line ends or outer white space are cut one by one and encoded together, foreign ones go
        to the library.
        """
        flat = "\n".join(chunks)
        if not _FOREIGN(flat) and flat.count("\n") == len(chunks) - 1 and not _OUTER_SPACE(f"\n{flat}\n"):
            return self._plain(flat)
        kind = [2 if _FOREIGN(c) else 1 if "\n" in c or _OUTER_SPACE(f"\n{c}\n") else 0 for c in chunks]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(chunks)
        if plain := [k for k, x in enumerate(kind) if x == 0]:
            ids, ends = self._plain("\n".join([chunks[k] for k in plain]))
            for k, a, b in zip(plain, [0, *ends], ends, strict=False):
                out[k] = ids[a:b]
        if odd := [k for k, x in enumerate(kind) if x == 1]:
            words = [[w for w in self.find(self.fold(chunks[k])) if not self.ends or w != "\n"] for k in odd]
            ids, stops = self._spoken([w for ws in words for w in ws])
            at = 0
            for k, ws in zip(odd, words, strict=True):
                out[k] = ids[stops[at] : stops[at + len(ws)]]
                at += len(ws)
        if foreign := [k for k, x in enumerate(kind) if x == 2]:
            for k, got in zip(foreign, self.library([chunks[k] for k in foreign]), strict=True):
                out[k] = got
        return np.concatenate([*out, np.zeros(0, np.uint32)]), np.cumsum([len(x) for x in out]).tolist()

    def _plain(self, flat: str) -> tuple[np.ndarray, list[int]]:
        words = self.find(self.fold(flat))
        words.append("\n")
        every, stops = self._spoken(words)
        marks = np.flatnonzero(np.fromiter(map("\n".__eq__, words), bool, len(words)))
        keep = np.ones(len(every), bool)
        keep[stops[marks]] = False  # a line end is one token
        return every[keep], (stops[marks] - np.arange(len(marks))).tolist()

    def _spoken(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many there are before each word and in all."""
        last, unique = END if self.ends else b"", dict.fromkeys(words)
        keys = list(unique)
        ids, count, failed = self.words.encode_words([w.encode() + last for w in keys])
        self.failed, self.seen = self.failed + failed, self.seen + len(keys)
        for i, w in enumerate(keys):
            unique[w] = i
        which = np.fromiter(map(unique.__getitem__, words), np.int64, len(words))
        size = count[which]
        stop = np.cumsum(size)
        first = (np.cumsum(count) - count)[which]
        every = ids[np.repeat(first - (stop - size), size) + np.arange(int(size.sum()))].astype(np.uint32)
        return every, np.concatenate([[0], stop])


@lru_cache(maxsize=4)
def coder(name: str) -> ChunkCoder:
    """One per vocabulary and Python worker."""
    return ChunkCoder(name)


@lru_cache(maxsize=4)
def id_table(name: str) -> ChunkTable:
    """Chunks to their ids as little-endian unsigned 32-bit numbers; one per vocabulary and worker."""

    def learn(chunks: list[str]) -> list[bytes]:
        ids, ends = coder(name)(chunks)
        raw, at, out = ids.tobytes(), 0, []
        for end in ends:
            out.append(raw[at : 4 * end])
            at = 4 * end
        return out

    return ChunkTable(learn, not coder(name).ends)


def encoded(name: str, texts: list[str | None]) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit numbers; null is empty."""
    cut = coder(name).cut
    return joined(id_table(name), [cut(t or "") for t in texts], b"".join)


@lru_cache(maxsize=2)
def _digest_table(name: str) -> ChunkTable:
    """Chunks to (number of ids, ",id,id", decoded bytes); the bytes come from the ids alone."""
    pieces, code = coder(name).words.pieces, coder(name)

    def learn(chunks: list[str]) -> list[tuple[int, bytes, bytes]]:
        ids, ends = code(chunks)
        x, at, out = ids.tolist(), 0, []
        shown, back = [b",%d" % i for i in x], [pieces[i] for i in x]
        for end in ends:
            out.append((end - at, b"".join(shown[at:end]), b"".join(back[at:end])))
            at = end
        return out

    return ChunkTable(learn, True)


def encode(df: DataFrame, text: str = "text", vocab: str = "byte_bpe_50k.json", ids: str = "ids") -> DataFrame:
    """Add the column ``ids`` (array of int): the encoding of each whole text."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                got = [np.frombuffer(x, np.uint32).astype(np.int32) for x in encoded(vocab, part.column(text).to_pylist())]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*got, np.zeros(0, np.int32)])))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", vocab: str = "byte_bpe_50k.json", text: str = "decoded") -> DataFrame:
    """Add the column ``text``: the decoding of ``ids``, special tokens included; null ids give null."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(vocab).words.pieces
        for batch in batches:
            got = [None if x is None else b"".join([pieces[i] for i in x]).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], [*batch.schema.names, text])

    return df.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocab: str = "byte_bpe_50k.json") -> DataFrame:
    """Encode and decode every whole text and return digests of both, one row per document.

    No shuffle: each task maps its documents slice by slice, in memory bounded by the
    slice and the bounded chunk table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for batch in batches:
            for part in text_slices(batch, "text"):
                chunks = [space_led(t or "") for t in part.column("text").to_pylist()]
                rows = joined(_digest_table(vocab), chunks, lambda x: tuple(zip(*x, strict=True)))
                counts = [sum(r[0]) for r in rows]
                ids = [sha(b"".join(r[1])[1:]).hexdigest() for r in rows]
                back = [sha(_as_text(b"".join(r[2]))).hexdigest() for r in rows]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _as_text(raw: bytes) -> bytes:
    """The bytes of the text that ``raw`` decodes to: ill-formed parts become U+FFFD."""
    return raw.decode("utf-8", "replace").encode()


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"))
