"""Language identification by averaged hashed subword embeddings (operator 4).

A text's subwords are the runs of 2 to 4 characters of its lower-cased letters,
with every run of other characters as one space.  Subwords are hashed into
buckets with an embedding each; a text is the average of its subwords'
embeddings, a linear layer and a softmax give the languages' probabilities.
Embeddings and layer are trained by stochastic gradient descent in numpy on the
driver, on a bounded sample of labelled rows, a row being at most 2**BITS numbers.  At prediction time embeddings and
layer fold into one table of scores per bucket, so a task adds up table rows.

Calibration uses a fifth of the sample that training doesn't see: a temperature
that minimises the log loss, then the score below which predictions are
rejected, so that at most ``loss`` of those rows are.

Predictions depend on the text alone.  Null text and text without a letter get
``und``, score 0, and are rejected; so does every text if there is no labelled
row to learn from.  Repeated rows get equal values; an empty table gives an empty
table.  Extra columns are carried through; a new column whose name an input column
has, in any case, gets underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, table, text_slices

BITS = 15
ORDERS = (2, 3, 4)
#: At most about this many labelled rows are drawn, shared evenly by the languages, each with its whole text.
SAMPLE_ROWS = 2400
#: So many languages are learnt, the most frequent ones.
LANGUAGES = 400
UNKNOWN = "und"
#: Bytes of text that a task works on at once; a worker keeps some hundred times that while it is idle.
SLICE = 1 << 17


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all subwords, where each text's begin, their numbers, and whether each text has a letter."""
    flat = "    ".join([(t or "").lower() for t in texts]) + "    "
    size = np.fromiter((len((t or "").lower()) for t in texts), np.int64, len(texts)) + 4
    code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    begin = np.cumsum(size) - size
    has_letter = np.add.reduceat(letter.astype(np.int64), begin) > 0 if len(begin) else np.zeros(0, bool)
    code = np.where(letter, code, 32).astype(np.uint32)
    # of a run of other characters the last stays, which is the space before a word
    keep = letter | np.concatenate([letter[1:], [False]])
    keep[begin + size - 1] = True
    kept = code[keep].astype(np.uint64)
    many = np.add.reduceat(keep.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    owner_end = np.cumsum(many)
    buckets = []
    for n in ORDERS:
        value = np.zeros(len(kept), np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + np.roll(kept, -j)
        buckets.append((value * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int32))
    # subwords that reach over a text's end count for the text before, so both equal texts and neighbours would differ: mask them
    grid = np.stack(buckets, 1)
    position = np.arange(len(kept))
    stop = np.repeat(owner_end, many)
    valid = np.stack([position + n <= stop for n in ORDERS], 1)
    return np.where(valid, grid, -1), owner_end - many, many, has_letter


@dataclass
class Model:
    """Scores per bucket and language, ready for prediction."""

    languages: list[str]
    scores: np.ndarray  # float32, a row for each bucket and a last one of zeros for none
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        grid, begin, many, has_letter = subwords(texts)
        out = np.zeros((len(texts), len(self.languages)))
        if not len(texts):
            return out, has_letter
        count = np.add.reduceat((grid >= 0).sum(1), begin)
        for k in range(len(self.languages)):
            column = self.scores[:, k]
            out[:, k] = np.add.reduceat(sum(column[grid[:, n]].astype(np.float64) for n in range(len(ORDERS))), begin)
        return out / np.maximum(count, 1)[:, None] + self.bias, has_letter

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        logits, has_letter = self.logits(texts)
        p = softmax(logits / self.temperature)
        best = p.argmax(1)
        score = np.where(has_letter, p[np.arange(len(p)), best], 0.0)
        return [self.languages[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), has_letter.tolist(), strict=True)], score


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def draw(docs: DataFrame, sample_rows: int, seed: int) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """A bounded sample of labelled rows: language, order, buckets and their weights.

    Each language gets an equal share, drawn by a hash of doc_id and text, so no sort or group of all rows is needed.
    Rows that repeat both count once, so no doc_id and no text can fill the sample.
    """
    labelled = docs.where("lang is not null and text is not null")
    frequent = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["n"] for r in frequent.collect()}
    if not counts:
        return []
    share = max(1, sample_rows // len(counts))
    parts = 1 << 30
    limit = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, int(min(1.0, share / n) * parts))])
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(parts))
    chosen = labelled.where(place < F.try_element_at(limit, F.col("lang"))).select("lang", place.alias("place"), "text").dropDuplicates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                grid, begin, many, has_letter = subwords(part.column("text").to_pylist())
                ids, weights = [], []
                for a, n in zip(begin.tolist(), many.tolist(), strict=True):
                    found, times = np.unique(grid[a : a + n], return_counts=True)
                    times, found = times[found >= 0], found[found >= 0]
                    ids.append(found.astype(np.uint16).tobytes())
                    weights.append((times / max(1, times.sum())).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("place"), pa.array(ids, pa.binary()), pa.array(weights, pa.binary()), pa.array(has_letter)],
                    ["lang", "place", "ids", "weights", "has_letter"],
                ).filter(pa.array(has_letter))

    rows = chosen.mapInArrow(run, "lang string, place long, ids binary, weights binary, has_letter boolean").toArrow()
    out = [(r["lang"], r["place"], np.frombuffer(r["ids"], np.uint16).astype(np.int64), np.frombuffer(r["weights"], np.float32)) for r in rows.to_pylist()]
    return sorted(out, key=lambda r: (r[1], r[0], r[2].tobytes()))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, width: int = 16, epochs: int = 6, rate: float = 8.0, loss: float = 0.001, seed: int = 7) -> Model | None:
    """Train on labelled rows of ``docs`` (text, lang, doc_id); None if there are none."""
    rows = draw(docs, sample_rows, seed)
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    index = {x: k for k, x in enumerate(languages)}
    held = [r for k, r in enumerate(rows) if k % 5 == 4]
    learn = [r for k, r in enumerate(rows) if k % 5 != 4 or len(rows) < 20]
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BITS, width)).astype(np.float32)
    layer = rng.normal(0, 0.3, (width, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, step = epochs * len(learn), 0
    for _ in range(epochs):
        for k in rng.permutation(len(learn)).tolist():
            lang, _, ids, weights = learn[k]
            now = rate * (1 - step / steps)
            step += 1
            mean = weights @ vectors[ids]
            slope = softmax((mean @ layer + bias)[None])[0]
            slope[index[lang]] -= 1
            back = layer @ slope
            layer -= 0.1 * now * np.outer(mean, slope)
            bias -= 0.002 * now * slope
            vectors[ids] -= now * weights[:, None] * back[None] * 4
    scores = np.concatenate([vectors @ layer, np.zeros((1, len(languages)), np.float32)])
    model = Model(languages, scores, bias.astype(np.float64))
    return _calibrated(model, held or learn, index, loss)


def _calibrated(model: Model, rows: list, index: dict[str, int], loss: float) -> Model:
    logits = np.stack([w @ model.scores[i] + model.bias for _, _, i, w in rows])
    truth = np.array([index[r[0]] for r in rows])
    every = np.geomspace(0.05, 20, 60)
    losses = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in every]
    model.temperature = float(max(every[int(np.argmin(losses))], 1.0))
    score = softmax(logits / model.temperature).max(1)
    model.reject_below = float(min(np.quantile(score, loss, method="lower"), 0.5))
    return model


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learnt from: those whose crc32 of doc_id as text, modulo 4, isn't 2."""
    return docs.where(~held_out())


def held_out():
    """A null doc_id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def predict(docs: DataFrame, model: Model | None, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """Add the predicted language, its calibrated score, and whether the prediction is rejected."""
    names = tuple(free_names(docs.columns, list(names)))
    if model is None:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), names[1]: F.lit(0.0), names[2]: F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages: bounded
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in text_slices(batch, text, SLICE):
                lang, score = own.predict(part.column(text).to_pylist())
                bad = [x == UNKNOWN or s < own.reject_below for x, s in zip(lang, score.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(bad, pa.bool_())], [*part.schema.names, *names])
        # the worker stays for a minute while other stages run
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(learnable(docs.select("doc_id", "text", "lang")))
    return predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
