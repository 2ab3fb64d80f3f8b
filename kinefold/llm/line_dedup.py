"""Fuzzy line dedup by MinHash, in DataFrame functions only (operator 3).

Lines are compared as lower-cased, trimmed text.  Signatures are made of all runs of
``CHARACTERS`` characters of a line, or the whole line if it is shorter.  The query
and the pipeline also verify on these (:func:`every_shingle`); the default of
:func:`dedup_lines` verifies on a sparser choice, which loses near copies of short
lines: the ``SHINGLE`` characters from each anchor on, where the line's start
follows its end after a line feed; anchors are the starts of words and, in long
words or scripts without spaces, every ``STRIDE``-th character of a run.  The
similarity is the Jaccard index of the two sets of distinct shingles.

1. Equal lines are grouped by a 64-bit key; a second key shows where different lines
   share one, and those get keys of another hash, so 128 bits decide.  Each distinct line's
   shingles are dealt by their hash to parts, four for each row of a band, each with a few minima.
   Each minimum deals the parts anew into four blocks, and the minima of a block are a band, so no
   two bands share a minimum.  Bands are the line's buckets; bits of the minima are its sketch.
   Only buckets and sketches are stored, no minima and no texts.
2. Lines that share a bucket with others meet its smallest key.  Pairs whose
   sketches are too far apart are dropped; of the others each line first has
   one pair verified on the whole shingle sets, and after a union-find those
   pairs that still lie in different components.
3. In buckets that then hold several components lines meet across these.  Each such
   line whose sketch is near another's has a bitmap of its shingles' hashes, and the join itself leaves out pairs
   whose bitmaps bound the similarity below the threshold, which loses none; the
   others are verified.  Buckets with many open lines are replaced first by deeper ones of
   minima of their own, and these by still deeper ones while that parts the lines.
4. A distributed union-find gives components; of each, the occurrence with the
   smallest (doc_id, line number) stays and all others are removed.

Bands get longer as the corpus grows, so that unlike lines seldom share one, and
more numerous, so that a pair of similarity 0.8 is missed by all with a probability
of at most ``MISS``, a more similar one more rarely (:func:`shape`).  From ``DEEP`` rows on
every band has hashes of its own.  Lines of up to ``TINY``
characters also have buckets of two whole parts each, those under ``SHORT`` no others.

Blank lines are neither compared nor removed.  A document keeps its row even if
no line is left.  Null text stays null.  A null doc_id sorts first.  Rows that
repeat doc_id and text are one document and keep the same lines; rows that repeat a
doc_id with another text are documents of their own.  An empty table gives an
empty table.  All columns are carried through, whatever their names.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, publish, table
from .components import components

CHARACTERS = 5
SHINGLE, STRIDE = 12, 8
#: Blocks of parts that the bands of one minimum share out, and parts that tiny lines know by their remainder.
BLOCKS = COARSE = 4
#: Bands of so many rows or more have minima of their own.
DEEP = 13
#: Parts and minima of each whose bits make the sketch.
SKETCHED_PARTS, SKETCHED = 32, 4
#: Rows of a band at least, and by how many characters of text per further row.
LEAST_ROWS, GROWTH, CHARACTERS_A_LINE = 7, 16, 64
#: Probability that all bands miss a pair of similarity 0.8, the same for bands of DEEP rows or more, and the similarity that deeper buckets tell from it.
MISS, DEEP_MISS, TEMPLATE = 0.03, 0.01, 0.6
TINY, SHORT = 15, 12
#: Bits of 128 in which the sketches of similar lines differ at most: 12.8 are expected at 0.8 and 29 were the most of
#: one in a thousand such pairs of 25 characters; some 60 of unlike lines.
FAR_BITS, UNSKETCHED = 36, 24
#: Open lines of a bucket from which on it is replaced by deeper ones, as long as those leave at most so large a share.
HOT, PARTED = 400, 0.8
#: Rows of two or three numbers sent to all tasks at once at most, some 8 MB; beyond it a shuffled join does the same.
BROADCAST_ROWS = 200_000
#: Characters of a line up to which its shingles are compared as one array; those of longer lines are rows.
ARRAY = 1 << 18
#: Words of 64 bits of a bitmap, and so many of them in a row of the first sums.
WORDS, SLOTS = 96, 8
BLANK = " \t\r\f\x0b"
ANCHORED = rf"(?s)(?=(.{{{SHINGLE}}}))[^ \t\r\f\x0B\n]{{1,{STRIDE}}}"
FIRST = -(1 << 63)


def _salt(k: int, minima: int) -> int:
    """Salts differ in their highest bits, so each leads to another region of the hashes first."""
    low = 64 - (minima - 1).bit_length()
    return ((k % minima) << low | random.Random(f"line {k}").getrandbits(low)) - (1 << 63)


def _normal(lowered: Column) -> Column:
    plain = F.trim(lowered)
    edged = F.lit(False)
    for c in BLANK[1:]:
        edged = edged | plain.startswith(c) | plain.endswith(c)
    return F.when(edged, F.trim(lowered, F.lit(BLANK))).otherwise(plain)


def every_shingle(line: Column) -> Column:
    """All runs of CHARACTERS characters of a normal line, with repeats; a shorter line is its own shingle."""
    runs = F.regexp_extract_all(line, F.lit(rf"(?s)(?=(.{{{CHARACTERS}}}))."), F.lit(1))
    return F.when(F.length(line) < CHARACTERS, F.array(line)).otherwise(runs)


def shingles(line: Column) -> Column:
    """The shingles at the anchors of a normal line, with repeats."""
    round_ = F.concat(line, F.lit("\n"), F.rpad(F.left(line, F.lit(SHINGLE - 1)), SHINGLE - 1, "\n"))
    return F.regexp_extract_all(round_, F.lit(ANCHORED), F.lit(1))


def _identity(doc_id: Column, text: Column) -> list[Column]:
    return [F.coalesce(doc_id.cast("long"), F.lit(FIRST)).alias("doc"), F.xxhash64(text).alias("body")]


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc, body, pos, line) of all lines that aren't blank; line is normal."""
    lines = docs.select(*_identity(F.col("doc_id"), F.col("text")), F.posexplode(F.split(F.lower("text"), "\n", -1)).alias("pos", "raw"))
    return lines.select("doc", "body", "pos", _normal(F.col("raw")).alias("line")).where("line <> ''")


def _key(line: Column) -> Column:
    return F.xxhash64(line, F.length(line)).alias("key")


def _check(line: Column) -> Column:
    """A second key, of another seed; also the key of lines that share the first with others."""
    return F.xxhash64(F.lit("second"), line)


def keyed(docs: DataFrame, clashes: DataFrame | None = None) -> DataFrame:
    """The occurrences of lines with their keys; ``clashes`` (key, of few rows) has those of several lines."""
    rows = occurrences(docs).withColumn("key", _key(F.col("line")))
    if clashes is None:
        return rows
    told = rows.join(_small(clashes.withColumn("clash", F.lit(True)), clashes.count()), "key", "left")
    return told.withColumn("key", F.when(F.col("clash"), _check(F.col("line"))).otherwise(F.col("key"))).drop("clash")


@lru_cache(maxsize=64)
def shape(rows: int) -> int:
    """The number of bands of so many rows, which is a multiple of BLOCKS below DEEP rows."""
    chance = 0.8**rows
    if rows >= DEEP:
        return math.ceil(math.log(DEEP_MISS) / math.log1p(-chance))
    return BLOCKS * math.ceil(math.log(MISS) / math.log1p(-chance) / BLOCKS)


def depth(docs: DataFrame) -> int:
    """Rows of a band for a corpus of this size."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(LEAST_ROWS, math.ceil(math.log(max(1, size / CHARACTERS_A_LINE), GROWTH)))


def _hashed(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """The columns of ``lines`` but line, with len and h, the hash of each run of characters; and all but h."""
    own = [c for c in lines.columns if c != "line"]
    # four bytes a character, so that a run is found without counting from the line's start
    coded = lines.select(*own, F.length("line").alias("len"), F.encode("line", "UTF-32").alias("units"))
    own = [*own, "len"]
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("len") - CHARACTERS))
    units = coded.select(*own, "units", F.explode(starts).alias("i"))
    return units.select(*own, F.xxhash64(F.substring("units", F.col("i") * 4 + 1, F.lit(4 * CHARACTERS))).alias("h")), own


def _cut(lines: DataFrame, cut: Callable[[Column], Column]) -> tuple[DataFrame, list[str]]:
    """As :func:`_hashed`, for shingles of any kind."""
    if cut is every_shingle:
        return _hashed(lines)
    own = [c for c in lines.columns if c != "line"]
    return lines.select(*own, F.explode(cut(F.col("line"))).alias("shingle")).select(*own, F.xxhash64("shingle").alias("h")), own


def signed(lines: DataFrame, rows: int, tiny: bool = True) -> DataFrame:
    """The columns of ``lines`` (key, line and others) but line, with len, sketch and buckets; lines are distinct and dealt by key."""
    hashed, own = _hashed(lines)
    narrow = min(rows, DEEP - 1)
    parts, minima = BLOCKS * narrow, max(SKETCHED, shape(narrow) // BLOCKS) if rows < DEEP else SKETCHED
    dealt = hashed.select(*own, F.pmod("h", F.lit(parts)).cast("int").alias("part"), "h")
    # a line's shingles are in one partition already, so neither step shuffles
    least = dealt.groupBy(*own, "part").agg(*[F.min(F.col("h").bitwiseXOR(F.lit(_salt(k, minima)))).alias(f"m{k}") for k in range(minima)])
    m = [F.col(f"m{k}") for k in range(minima)]
    bit = lambda k, up: F.shiftright(m[k], 8).bitwiseAND(1) * F.expr(f"shiftleft(1L, part + {up})")
    sketched = F.col("part") < SKETCHED_PARTS
    halves = [F.when(sketched, bit(k, 0).bitwiseOR(bit(k + 1, SKETCHED_PARTS))).otherwise(F.lit(0).cast("long")) for k in range(0, SKETCHED, 2)]
    told = least.select(*own, "part", *[h.alias(n) for h, n in zip(halves, ("low", "high"), strict=True)], *([F.when(F.col("len") <= TINY, F.xxhash64("part", *m)).alias("whole")] if tiny else []), *[F.xxhash64(F.lit(k), "part", m[k]).alias(f"x{k}") for k in range(minima)])
    bands = []
    for k in range(shape(rows) // BLOCKS if rows < DEEP else 0):
        places = random.Random(f"band {rows} {k}").sample(range(parts), parts)
        for b in range(BLOCKS):
            block = sum(1 << p for p in places[b * rows : (b + 1) * rows])
            bands.append(F.bit_xor(F.expr(f"if((shiftrightunsigned({block}L, part) & 1L) = 1L, x{k}, 0L)")))
    wholes = [F.bit_xor(F.when(F.col("part") % COARSE == c, F.col("whole"))) for c in range(COARSE)] if tiny else []
    each = told.groupBy(*own).agg(F.bit_or("low").alias("low"), F.bit_or("high").alias("high"), *[x.alias(f"b{b}") for b, x in enumerate(bands)], *[x.alias(f"w{c}") for c, x in enumerate(wholes)])
    # where none of a band's parts holds a shingle, it says nothing
    buckets = [F.when((F.col("len") >= (SHORT if tiny else 0)) & (F.col(f"b{b}") != 0), F.xxhash64(F.lit(b), F.col(f"b{b}"))) for b in range(len(bands))]
    if tiny:
        whole = [F.col(f"w{c}") for c in range(COARSE)]
        pairs = [(p, q) for p in range(COARSE) for q in range(p + 1, COARSE)]
        buckets += [F.when((F.col("len") <= TINY) & (whole[p].isNotNull() | whole[q].isNotNull()), F.xxhash64(F.lit(f"{p} {q}"), *[F.coalesce(whole[c], F.lit(0)) for c in (p, q)])) for p, q in pairs]
    out = each.select(*own, F.struct("low", "high").alias("sketch"), F.array_compact(F.array(*buckets)).alias("buckets") if buckets else F.lit(None).cast("array<bigint>").alias("buckets"))
    if rows < DEEP:
        return out
    # few lines come here; each band has hashes of its own
    apart = hashed.select(*own, "h", F.explode(F.sequence(F.lit(0), F.lit(shape(rows) - 1))).alias("band"))
    lone = apart.groupBy(*own, "band").agg(*[F.min(F.xxhash64(F.lit(k), "band", "h")).alias(f"m{k}") for k in range(rows)])
    deep = lone.groupBy(*own).agg(F.collect_list(F.xxhash64("band", *[f"m{k}" for k in range(rows)])).alias("buckets"))
    return out.drop("buckets").join(deep.select("key", "buckets"), "key")


def _distinct(lines: DataFrame) -> DataFrame:
    """(key, line, n, clash) of the lines of (key, line); a clash is a key of several lines."""
    check = _check(F.col("line"))
    return lines.groupBy("key").agg(F.first("line").alias("line"), F.count("*").alias("n"), (F.min(check) != F.max(check)).alias("clash"))


def _small(df: DataFrame, count: int) -> DataFrame:
    return F.broadcast(df) if count <= BROADCAST_ROWS else df.hint("shuffle_hash")


def _near(left: Column, right: Column, length: Column) -> Column:
    differ = lambda c: F.bit_count(left.getField(c).bitwiseXOR(right.getField(c)))
    return (length <= UNSKETCHED) | (differ("low") + differ("high") <= FAR_BITS)


def _set(line: Column, cut: Callable[[Column], Column]) -> Column:
    """The hashes of a line's distinct shingles."""
    if cut is not every_shingle:
        return F.array_distinct(F.transform(cut(line), lambda x: F.xxhash64(x)))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(line) - CHARACTERS))
    each = lambda units: F.transform(starts, lambda i: F.xxhash64(F.substring(units, i * 4 + 1, F.lit(4 * CHARACTERS))))
    # the array of one makes the code points a variable, which is computed once
    return F.array_distinct(F.element_at(F.transform(F.array(F.encode(line, "UTF-32")), each), 1))


def _long(texts: DataFrame) -> bool:
    return (texts.agg(F.max(F.length("line")).alias("n")).first()["n"] or 0) > ARRAY


def _verified(texts: DataFrame, pairs: DataFrame, percent: int, cut: Callable[[Column], Column]) -> DataFrame:
    """Pairs of keys whose whole shingle sets have 100 * intersection >= percent * union."""
    texts_of = lambda n: texts.select(F.col("key").alias(n), F.col("line").alias(f"line_{n}"))
    # pairs that share a line are dealt apart
    both = pairs.join(texts_of("a"), "a").join(texts_of("b"), "b").repartition("a", "b")
    close = lambda s: F.size(F.array_intersect(s.x, s.y)).cast("long") * (100 + percent) >= (F.size(s.x).cast("long") + F.size(s.y)) * percent
    alike = F.exists(F.array(F.struct(_set(F.col("line_a"), cut).alias("x"), _set(F.col("line_b"), cut).alias("y"))), close)
    if not _long(texts):
        return both.where(alike).select("a", "b")
    short = F.greatest(F.length("line_a"), F.length("line_b")) <= ARRAY
    sides = F.array(F.struct(F.lit(1).alias("side"), F.col("line_a").alias("line")), F.struct(F.lit(2).alias("side"), F.col("line_b").alias("line")))
    cuts, _ = _cut(both.where(~short).select("a", "b", F.explode(sides).alias("s")).select("a", "b", "s.side", "s.line"), cut)
    held = cuts.groupBy("a", "b", "h").agg(F.bit_or("side").alias("sides")).groupBy("a", "b").agg(F.count("*").alias("either"), F.count_if(F.col("sides") == 3).alias("common"))
    return both.where(F.when(short, alike)).select("a", "b").unionByName(held.where(F.expr(f"100 * common >= {percent} * either")).select("a", "b"))


def _texts(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, line) of some keys."""
    found = lines.select("key", "line").join(_small(keys, keys.count()), "key", "left_semi")
    return found.groupBy("key").agg(F.first("line").alias("line"))


def _shared(told: DataFrame, kept: Scratch, label: str) -> DataFrame:
    """(bucket, b, sketch, len, a, hub): the lines of buckets with several, and the smallest key there with its sketch."""
    bands = told.select(F.col("key").alias("b"), F.explode("buckets").alias("bucket"))
    # most buckets hold one line: only their numbers are exchanged
    again = kept.publish(bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket"), f"{label}-again")
    # the rest of a line follows for those that stay
    met = kept.publish(bands.join(_small(again, again.count()), "bucket").join(told.select(F.col("key").alias("b"), "sketch", "len"), "b"), f"{label}-met")
    least = met.groupBy("bucket").agg(F.min(F.struct("b", "sketch")).alias("least")).select("bucket", F.col("least.b").alias("a"), F.col("least.sketch").alias("hub"))
    return met.join(least.select(F.when(F.col("bucket").isNotNull(), F.col("bucket")).alias("bucket"), "a", "hub"), "bucket")


def _open(shared: DataFrame, known: DataFrame) -> DataFrame:
    """(bucket, node, sketch, len, component, open): lines of buckets with several components, and their number there."""
    rows = shared.select("bucket", F.col("b").alias("node"), "sketch", "len").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("open")).where("low <> high").select("bucket", "open")
    return rows.join(mixed, "bucket")


def links(lines: DataFrame, told: DataFrame, percent: int, cut: Callable[[Column], Column], rows: int, kept: Scratch) -> DataFrame:
    """(node, component) of all keys that are linked with another key; ``lines`` are occurrences (key, line)."""
    shared = kept.publish(_shared(told, kept, "line"), "line-shared")
    met = shared.where(F.col("a") != F.col("b")).where(_near(F.col("sketch"), F.col("hub"), F.col("len")))
    near = kept.publish(met.select("a", "b").distinct(), "line-near")
    texts = kept.publish(_texts(lines, kept.publish(near.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "line-keys")), "line-texts")
    first = kept.publish(_verified(texts, near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), percent, cut), "line-links")
    apart = _apart(near, components(first, "line-components", kept)).join(near.groupBy("b").agg(F.min("a").alias("a")), ["a", "b"], "left_anti")
    found = first.unionByName(kept.publish(_verified(texts, apart, percent, cut), "line-links"))
    known = components(found, "line-components", kept)
    return components(found.unionByName(_rest(lines, shared, known, near, percent, cut, rows, kept)), "line-components", kept)


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    of = lambda n: known.select(F.col("node").alias(n), F.col("component").alias(f"c{n}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _rest(lines: DataFrame, shared: DataFrame, known: DataFrame, near: DataFrame, percent: int, cut: Callable[[Column], Column], rows: int, kept: Scratch) -> DataFrame:
    """Links across components of one bucket that go through other lines than its smallest."""
    open_ = kept.publish(_open(shared, known), "line-open")
    most = open_.agg(F.max("open").alias("n")).first()["n"] or 0
    meeting = open_.where(F.col("open") <= HOT)
    while most > HOT:
        # lines of hot buckets are signed again, so deeply that lines under TEMPLATE seldom meet
        rows = max(DEEP, rows + math.ceil(math.log(most / HOT) / -math.log(TEMPLATE)))
        hot = kept.publish(open_.where(F.col("open") > HOT).select(F.col("node").alias("key")).distinct(), "line-hot")
        again = kept.publish(signed(_texts(lines, hot), rows, tiny=False), "line-deep")
        open_ = kept.publish(_open(kept.publish(_shared(again, kept, "line-deep"), "line-shared"), known), "line-open")
        last, most = most, open_.agg(F.max("open").alias("n")).first()["n"] or 0
        # lines that deeper buckets don't part are alike indeed and meet as they are
        if most > PARTED * last:
            most = 0
            meeting = meeting.unionByName(open_)
        else:
            meeting = meeting.unionByName(open_.where(F.col("open") <= HOT))
    meeting = kept.publish(meeting.select("bucket", "node", "sketch", "len", "component"), "line-meeting")
    other = meeting.select("bucket", F.col("component").alias("c"), F.col("sketch").alias("s"), F.col("len").alias("l"))
    meeting = meeting.alias("m").join(other.alias("o"), (F.col("m.bucket") == F.col("o.bucket")) & (F.col("component") != F.col("c")) & _near(F.col("sketch"), F.col("s"), F.greatest("len", "l")), "left_semi")
    meeting = kept.publish(meeting.select("bucket", "node", "component"), "line-meeting")
    texts = kept.publish(_texts(lines, kept.publish(meeting.select(F.col("node").alias("key")).distinct(), "line-keys")), "line-texts")
    rows_ = kept.publish(meeting.join(_bitmaps(texts, cut).withColumnRenamed("key", "node"), "node"), "line-bitmaps")
    left, right = (rows_.select("bucket", *[F.col(c).alias(f"{c}_{n}") for c in rows_.columns if c != "bucket"]) for n in ("a", "b"))
    l, r = left.alias("l"), right.alias("r")
    shared_bits = sum((F.bit_count(F.col(f"w{k}_a").bitwiseAND(F.col(f"w{k}_b"))) for k in range(1, WORDS)), F.bit_count(F.col("w0_a").bitwiseAND(F.col("w0_b"))))
    # of a line's shingles at least so many are not the other's as its bits that the other lacks
    common = F.least(F.col("n_a") - F.col("bits_a"), F.col("n_b") - F.col("bits_b")) + shared_bits
    meet = (F.col("l.bucket") == F.col("r.bucket")) & (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")) & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (common * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent)
    pairs = l.join(r, meet).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct().join(near, ["a", "b"], "left_anti")
    return kept.publish(_verified(texts, kept.publish(pairs, "line-rest"), percent, cut), "line-links")


def _bitmaps(texts: DataFrame, cut: Callable[[Column], Column]) -> DataFrame:
    """(key, n, bits, w0, ...): a line's number of distinct shingles, and the bits that their hashes set."""
    dealt = texts.repartition("key")
    short = F.length("line") <= ARRAY
    each = dealt.where(short).select("key", F.explode(_set(F.col("line"), cut)).alias("h"))
    if _long(texts):
        each = each.unionByName(_cut(dealt.where(~short), cut)[0].select("key", "h").distinct())
    bit = F.expr("shiftleft(1L, int(shiftright(h, 40) & 63))")
    # few columns for the many shingles, all of them for few rows
    word = F.pmod("h", F.lit(WORDS)).cast("int")
    slots = each.groupBy("key", F.floor(word / SLOTS).cast("int").alias("place")).agg(F.count("*").alias("n"), *[F.coalesce(F.bit_or(F.when(word % SLOTS == k, bit)), F.lit(0)).cast("long").alias(f"s{k}") for k in range(SLOTS)])
    bits = sum((F.bit_count(f"s{k}") for k in range(1, SLOTS)), F.bit_count("s0"))
    maps = slots.groupBy("key").agg(F.sum("n").cast("int").alias("n"), F.sum(bits).cast("int").alias("bits"), *[F.coalesce(F.max(F.when(F.col("place") == k // SLOTS, F.col(f"s{k % SLOTS}"))), F.lit(0)).cast("long").alias(f"w{k}") for k in range(WORDS)])
    return maps


def removals(docs: DataFrame, percent: int = 80, cut: Callable[[Column], Column] = shingles) -> DataFrame:
    """(doc, body, dropped): the numbers of the lines to remove, for each document that has any."""
    kept = Scratch(docs.sparkSession)
    rows = depth(docs)
    told = kept.publish(signed(_distinct(keyed(docs)), rows), "line-table")
    clashes = told.where("clash").select("key")
    few = clashes.count()
    if few:
        # lines that share a key are signed again under their second keys
        clashes = kept.publish(clashes, "line-clashes")
        some = occurrences(docs).withColumn("key", _key(F.col("line"))).join(_small(clashes, few), "key", "left_semi").withColumn("key", _check(F.col("line")))
        told = told.where("not clash").unionByName(kept.publish(signed(_distinct(some), rows), "line-table"))
    lines = keyed(docs, clashes if few else None)
    found = links(lines, told, percent, cut, rows, kept).withColumnRenamed("node", "key")
    alone = told.where("n > 1").select("key").join(found, "key", "left_anti").select("key", F.col("key").alias("component"))
    decided = kept.publish(found.select("key", "component").unionByName(alone), "line-decided")
    # one number orders occurrences by document and line; a part of the text's hash tells texts of one doc_id apart
    number = lambda c, bits: c.cast("decimal(20,0)") * F.lit(1 << bits).cast("decimal(19,0)")
    place = (number(F.col("doc"), 62) + number(F.col("pos"), 31) + F.col("body").bitwiseAND((1 << 31) - 1)).cast("decimal(38,0)")
    places = lines.select("key", "doc", "body", "pos", place.alias("place"))
    hits = kept.publish(places.join(_small(decided, decided.count()), "key").drop("key"), "line-hits")
    best = kept.publish(hits.groupBy("component").agg(F.min("place").alias("best")), "line-best")
    gone = hits.join(_small(best, best.count()), "component").where("place <> best")
    out = publish(gone.groupBy("doc", "body").agg(F.array_sort(F.collect_set("pos")).alias("dropped")), "line-removals")
    kept.remove()
    return out


def _without(text: Column, dropped: Column) -> Column:
    """The text without the lines of these ascending numbers: the runs of lines between them, joined."""

    def runs(lines: Column) -> Column:
        begin = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda x: x + 1))
        end = F.concat(dropped, F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(begin, end, lambda a, b: F.slice(lines, a + 1, b - a))), "\n")

    # the array of one makes the lines a variable, which is computed once
    return F.element_at(F.transform(F.array(F.split(text, "\n", -1)), runs), 1)


def dedup_lines(docs: DataFrame, percent: int = 80, counts: tuple[str, str] | None = None, cut: Callable[[Column], Column] = shingles) -> DataFrame:
    """Remove repeated lines from the column text; optionally add the numbers of lines before and after."""
    gone = removals(docs, percent, cut)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *_identity(F.col("doc_id"), F.col("text")))
    size = gone.agg(F.count("*").alias("n"), F.sum(F.size("dropped")).alias("lines")).first()
    few = size["n"] <= BROADCAST_ROWS // 4 and (size["lines"] or 0) <= BROADCAST_ROWS
    both = rows.join(F.broadcast(gone) if few else gone.hint("shuffle_hash"), ["doc", "body"], "left")
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(_without(F.col("row.text"), F.col("dropped")))
    out = [(text if c == "text" else F.col("row").getField(c)).alias(c) for c in names]
    if counts:
        n = F.coalesce(F.regexp_count(F.col("row.text"), F.lit(r"[^ \t\r\f\x0B\n][^\n]*+")), F.lit(0)).cast("long")
        out += [n.alias(counts[0]), (n - F.coalesce(F.size("dropped"), F.lit(0))).cast("long").alias(counts[1])]
    return both.select(*out)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(docs, counts=("n_lines", "n_kept"), cut=every_shingle)
    return kept.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_kept", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
