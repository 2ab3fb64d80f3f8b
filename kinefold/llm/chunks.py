"""Encoding of whole texts through a bounded table of space-delimited chunks.

Text repeats words, so most of the cost of a tokenizer library is spent on
words that the task has met already.  A text is cut into chunks at places where
the pre-tokenizer certainly cuts as well; the library encodes each new chunk
once, and a text's ids are the concatenation of its chunks' ids.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np

from .common import vocabulary

#: Chunks that a Python worker remembers; further ones are encoded for each slice anew.
REMEMBERED = 700_000


#: A line end beside other white space.
_SPACED_END = re.compile(r"\n(?:\s|(?<=\s\n))").search


def space_led(text: str) -> list[str]:
    """Chunks for byte-level BPE: every space starts a chunk.

    The pre-tokenizer cuts before each single space that a non-space follows.  Chunks
    that are a space alone or start with two white-space characters are irregular, see
    :func:`glued`.
    """
    if "\0" in text:
        first, *rest = text.split(" ")
        return [first, *(" " + x for x in rest)]
    if "\n" in text and not _SPACED_END(text) and not text[-1].isspace() and not text[0].isspace():
        text = text.replace("\n", "\0\n\0")  # a line end between non-spaces is a word of its own
    return text.replace(" ", "\0 ").split("\0")


def glued(chunks: list[str]) -> list[str]:
    """Join irregular chunks to the one before, so that runs of white space stay whole."""
    out: list[str] = []
    for c in chunks:
        if out and (len(c) == 1 or c[1].isspace()):
            out[-1] += c
        else:
            out.append(c)
    return out


def words_only(text: str) -> list[str]:
    """Chunks for a tokenizer that drops white space: pieces between spaces and line ends."""
    return text.replace("\n", " ").split(" ")


class LibraryIds:
    """Ids of chunks by the tokenizers library, many chunks in one call.

    Chunks are joined by a special token of the vocabulary, whose id then separates the
    ids of the chunks.  A chunk that holds the special token's text is encoded alone.
    """

    def __init__(self, vocab: str, delimiter: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary(vocab))
        self.library.no_truncation()
        self.library.no_padding()
        self.delimiter, self.mark = delimiter, self.library.token_to_id(delimiter)

    def __call__(self, chunks: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for at in range(0, len(chunks), 4096):
            part = chunks[at : at + 4096]
            plain = [c for c in part if self.delimiter not in c]
            got: list[np.ndarray] = []
            if plain:
                ids = np.array(self.library.encode(self.delimiter.join(plain), add_special_tokens=False).ids, np.uint32)
                got = np.split(ids, cuts := np.flatnonzero(ids == self.mark))
                got[1:] = [x[1:] for x in got[1:]]
                assert len(cuts) == len(plain) - 1
            each = iter(got)
            out += [next(each) if self.delimiter not in c else np.array(self.library.encode(c, add_special_tokens=False).ids, np.uint32) for c in part]
        return out


class ChunkTable:
    """Maps chunks to bytes that are simply concatenated for a text.

    ``learn`` gives the bytes of new chunks.  At most ``REMEMBERED`` chunks are kept, so a
    worker's memory is bounded; results do not depend on what is kept.
    """

    def __init__(self, learn: Callable[[list[str]], list], irregular: bool, limit: int = REMEMBERED):
        self.learn, self.irregular, self.limit = learn, irregular, limit
        self.known: dict = {}

    def values(self, texts: list[list[str]]) -> dict:
        """Values of all chunks in ``texts``; irregular chunks get None."""
        wanted = set().union(*texts)
        new = [c for c in wanted if c not in self.known]
        odd = [c for c in new if self.irregular and c[:1] == " " and (len(c) == 1 or c[1].isspace())]
        if odd:
            new = list(set(new).difference(odd))
        found = dict(zip(new, self.learn(new), strict=True)) if new else {}
        found.update(dict.fromkeys(odd))
        if len(self.known) + len(found) <= self.limit:
            self.known.update(found)
            return self.known
        for c, v in found.items():
            if len(self.known) >= self.limit:
                break
            self.known[c] = v
        return {c: found[c] if c in found else self.known[c] for c in wanted}


def joined(table: ChunkTable, texts: list[list[str]], join: Callable) -> list:
    """``join`` of the values of each text's chunks, with irregular chunks glued."""
    values = table.values(texts)
    out = []
    for chunks in texts:
        try:
            out.append(join([values[c] for c in chunks]))
        except (TypeError, AttributeError):
            whole = glued(chunks)
            out.append(join([values.get(c) or v for c, v in zip(whole, table.learn(whole), strict=True)]))
    return out
