"""Media columns: lossless audio frames in the FLAC format (operator 10).

A payload of bytes is stored as 8-bit mono samples (byte minus 128) in a native
FLAC stream: marker, STREAMINFO, SEEKTABLE, then frames of ``BLOCK_SIZE``
samples.  Each frame holds one subframe, constant, verbatim, fixed or linear
prediction, whichever takes the fewest bits; residuals are Rice-coded.

Reading decodes Rice residuals and linear predictors, verifies the CRC-8 of each
frame header, the CRC-16 of each frame and the MD5 of the samples, and yields
PCM blocks with their sample offsets, so that a reader can seek.  Both
directions work on all frames of a slice of rows at once: a step of numpy
handles one sample, or one byte of a checksum, of every frame.

The decoder reads mono streams of 8 or 16 bits with any of the four subframe
kinds, Rice methods 0 and 1, escaped partitions and wasted bits; other streams,
cut streams and wrong checksums raise ValueError.

Null text counts as empty, whose payload is 64 zero bytes.  Equal texts have
equal values.  Rows are independent; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import publish, table, text_slices

BLOCK_SIZE = 1024
SAMPLE_RATE = 8000
ORDERS = (0, 1, 2)
PRECISION = 12
LPC_ORDER = 4
SEEK_EVERY = 8
SLICE = 4 << 20
#: Coefficients of the fixed predictors of the format, by order.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


# ---------------------------------------------------------------- checksums


@lru_cache(maxsize=2)
def _crc_table(bits: int, poly: int) -> np.ndarray:
    value = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        value = np.where(value >> (bits - 1) & 1, value << 1 ^ poly, value << 1) & ((1 << bits) - 1)
    return value


def checksums(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
    """CRC-8 (polynomial 0x07) or CRC-16 (0x8005) of runs of bytes, a byte of every run at a time."""
    each = _crc_table(bits, 0x07 if bits == 8 else 0x8005)
    if len(begin) and int((begin + size).max()) > len(flat):
        raise ValueError("a stream ends within a frame")
    out, order = np.zeros(len(begin), np.int64), np.argsort(-size, kind="stable")
    begin, size, crc = begin[order], size[order], np.zeros(len(begin), np.int64)
    live = len(begin) - np.searchsorted(size[::-1], np.arange(1, int(size.max(initial=0)) + 1))
    mask = (1 << bits) - 1
    for k, n in enumerate(live.tolist()):
        now = crc[:n]
        crc[:n] = (now << 8 & mask) ^ each[now >> (bits - 8) ^ flat[begin[:n] + k]]
    out[order] = crc
    return out


# ---------------------------------------------------------------- writing


def _utf8_number(n: int) -> bytes:
    """A number in the extended UTF-8 form of frame headers."""
    if n < 0x80:
        return bytes([n])
    more = 1
    while n >> (6 * more + 6 - more):
        more += 1
    lead = (0xFF << (7 - more) & 0xFF) | n >> 6 * more
    return bytes([lead, *(0x80 | n >> 6 * k & 0x3F for k in range(more - 1, -1, -1))])


def _frame_header(number: int, samples: int) -> bytes:
    """Header without checksum: fixed block size, 16-bit sample count, mono, 8 bits a sample."""
    return b"\xff\xf8\x70" + bytes([0 << 4 | 1 << 1]) + _utf8_number(number) + (samples - 1).to_bytes(2, "big")


def _rice_bits(residual: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best Rice parameter of each row and the bits of its residuals."""
    folded = np.where(residual < 0, -2 * residual - 1, 2 * residual) * valid
    count = valid.sum(1)
    every = np.stack([(folded >> k).sum(1) + count * (k + 1) for k in range(15)])
    best = every.argmin(0)
    return best, every[best, np.arange(len(best))]


def _predictor(grid: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients of a linear predictor of each row, and their shift, by Levinson and Durbin."""
    x = grid * valid
    auto = np.stack([(x[:, : x.shape[1] - k] * x[:, k:]).sum(1) for k in range(LPC_ORDER + 1)]).astype(np.float64)
    error = auto[0] * (1 + 1e-9) + 1e-9
    a = np.zeros((LPC_ORDER + 1, len(grid)))
    for i in range(1, LPC_ORDER + 1):
        k = (auto[i] - sum(a[j] * auto[i - j] for j in range(1, i))) / error
        previous = a.copy()
        a[i] = k
        for j in range(1, i):
            a[j] = previous[j] - k * previous[i - j]
        error = error * (1 - k * k) + 1e-12
    coefficient = np.nan_to_num(a[1:])
    largest = np.abs(coefficient).max(0)
    shift = np.clip(PRECISION - 2 - np.floor(np.log2(np.maximum(largest, 1e-9))), 0, 14).astype(np.int64)
    quantised = np.clip(np.rint(coefficient * 2.0**shift), -(1 << PRECISION - 1), (1 << PRECISION - 1) - 1)
    return quantised.astype(np.int64), shift


def _residual(grid: np.ndarray, coefficient: np.ndarray, shift: np.ndarray) -> np.ndarray:
    out = grid.copy()
    total = np.zeros_like(grid)
    for k, c in enumerate(coefficient):
        total[:, k + 1 :] += c[:, None] * grid[:, : -k - 1]
    return out - (total >> shift[:, None])


def _put(fields: list[tuple[np.ndarray, np.ndarray, np.ndarray]], total: int) -> np.ndarray:
    """Bits from fields (position, width, value); positions not covered stay zero."""
    bits = np.zeros(total, np.uint8)
    for position, width, value in fields:
        for b in range(int(width.max(initial=0))):
            rows = width > b
            bits[position[rows] + width[rows] - 1 - b] = value[rows] >> b & 1
    return np.packbits(bits)


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload; payloads are not empty."""
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    samples = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int64) - 128
    frames = -(-sizes // BLOCK_SIZE)
    owner = np.repeat(np.arange(len(sizes)), frames)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(frames) - frames, frames)
    first = np.repeat(np.cumsum(sizes) - sizes, frames) + number * BLOCK_SIZE
    length = np.minimum(BLOCK_SIZE, sizes[owner] - number * BLOCK_SIZE)
    bodies: list[np.ndarray] = []
    step = max(1, SLICE // 4 // BLOCK_SIZE)
    for at in range(0, len(owner), step):
        bodies += _subframes(samples, first[at : at + step], length[at : at + step])
    parts = [_frame_header(int(n), int(k)) for n, k in zip(number, length, strict=True)]
    heads = _sealed(parts, 8)
    whole = _sealed([h + b.tobytes() for h, b in zip(heads, bodies, strict=True)], 16)
    out, k = [], 0
    for row, n in enumerate(frames.tolist()):
        mine = whole[k : k + n]
        k += n
        out.append(_stream(payloads[row], int(sizes[row]), mine))
    return out


def _sealed(parts: list[bytes], bits: int) -> list[bytes]:
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    crc = checksums(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size, bits)
    return [p + c.to_bytes(bits // 8, "big") for p, c in zip(parts, crc.tolist(), strict=True)]


def _stream(payload: bytes, size: int, frames: list[bytes]) -> bytes:
    least, most = min(map(len, frames)), max(map(len, frames))
    signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
    packed = SAMPLE_RATE << 44 | 0 << 41 | 7 << 36 | size
    info = BLOCK_SIZE.to_bytes(2, "big") * 2 + least.to_bytes(3, "big") + most.to_bytes(3, "big") + packed.to_bytes(8, "big") + hashlib.md5(signed).digest()
    points, offset = [], 0
    for k, f in enumerate(frames):
        if k % SEEK_EVERY == 0:
            points.append((k * BLOCK_SIZE).to_bytes(8, "big") + offset.to_bytes(8, "big") + min(BLOCK_SIZE, size - k * BLOCK_SIZE).to_bytes(2, "big"))
        offset += len(f)
    seek = b"".join(points)
    return b"".join([b"fLaC", b"\x00", len(info).to_bytes(3, "big"), info, b"\x83", len(seek).to_bytes(3, "big"), seek, *frames])


def _subframes(samples: np.ndarray, first: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """The subframe bytes of each frame, padded to whole bytes."""
    column = np.arange(BLOCK_SIZE)
    valid = column < length[:, None]
    grid = np.where(valid, samples[np.minimum(first[:, None] + column, len(samples) - 1)], 0)
    coefficient, shift = _predictor(grid, valid)
    choices: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for order in ORDERS:
        fixed = np.repeat(np.array(FIXED[order], np.int64)[:, None], len(grid), 1)
        residual = _residual(grid, fixed, np.zeros(len(grid), np.int64)) if order else grid
        k, bits = _rice_bits(residual, valid & (column >= order))
        choices.append((8 + 8 * order + 10 + bits, k, residual))
    residual = _residual(grid, coefficient, shift)
    k, bits = _rice_bits(residual, valid & (column >= LPC_ORDER))
    choices.append((8 + 8 * LPC_ORDER + 9 + PRECISION * LPC_ORDER + 10 + bits, k, residual))
    cost = np.stack([c[0] for c in choices])
    cost[-1][length <= LPC_ORDER] = 1 << 40
    best = cost.argmin(0)
    verbatim = cost.min(0) >= 8 + 8 * length
    constant = (np.where(valid, grid, grid[:, :1]) == grid[:, :1]).all(1)
    kind = np.where(constant, -1, np.where(verbatim, -2, best))
    order = np.where(kind == len(ORDERS), LPC_ORDER, np.where(kind >= 0, np.maximum(kind, 0), 0))
    rows = np.arange(len(grid))
    residual = np.stack([c[2] for c in choices])[np.maximum(best, 0), rows]
    rice = np.stack([c[1] for c in choices])[best, rows]
    code = np.where(kind == -1, 0, np.where(kind == -2, 1, np.where(kind == len(ORDERS), 31 + LPC_ORDER, 8 + order)))
    predicted = kind >= 0
    plain = np.where(kind == -1, 1, np.where(kind == -2, length, order))  # samples that stand as they are
    linear = kind == len(ORDERS)
    size = 8 + 8 * plain + np.where(linear, 9 + PRECISION * LPC_ORDER, 0) + np.where(predicted, 10, 0)
    coded = valid & (column >= order[:, None]) & predicted[:, None]
    folded = np.where(residual < 0, -2 * residual - 1, 2 * residual)
    quotient = np.where(coded, folded >> rice[:, None], 0)
    width = np.where(coded, quotient + 1 + rice[:, None], 0)
    total = size + width.sum(1)
    whole = -(-total // 8) * 8
    base = np.cumsum(whole) - whole
    fields = [(base, np.full(len(base), 8), code << 1)]
    r, c = np.nonzero(column < plain[:, None])
    fields.append((base[r] + 8 + 8 * c, np.full(len(r), 8), grid[r, c] & 0xFF))
    at = base + 8 + 8 * plain
    l = np.flatnonzero(linear)
    if len(l):
        fields += [(at[l], np.full(len(l), 4), np.full(len(l), PRECISION - 1)), (at[l] + 4, np.full(len(l), 5), shift[l])]
        for j in range(LPC_ORDER):
            fields.append((at[l] + 9 + PRECISION * j, np.full(len(l), PRECISION), coefficient[j][l] & ((1 << PRECISION) - 1)))
        at[l] += 9 + PRECISION * LPC_ORDER
    p = np.flatnonzero(predicted)
    fields.append((at[p], np.full(len(p), 10), rice[p]))  # method 0, one partition, its parameter
    bits_total = int(whole.sum())
    r, c = np.nonzero(coded)
    start = (at[:, None] + 10 + np.cumsum(width, 1) - width)[r, c]
    q, k = quotient[r, c], rice[r]
    # the unary part is zeros and a one; one and remainder together are one field
    fields.append((start + q, k + 1, 1 << k | folded[r, c] & ((1 << k) - 1)))
    packed = _put(fields, bits_total)
    cuts = np.cumsum(whole // 8)
    return np.split(packed, cuts[:-1])


# ---------------------------------------------------------------- reading


class _Bits:
    """Reads fields at arbitrary bit positions of a byte array, for many positions at once."""

    def __init__(self, flat: np.ndarray):
        padded = np.concatenate([flat, np.zeros(16, np.uint8)]).astype(np.uint64)
        self.window = np.zeros(len(padded) - 7, np.uint64)  # eight bytes from each byte on
        for k in range(8):
            self.window |= padded[k : len(padded) - 7 + k] << np.uint64(56 - 8 * k)
        self.end = 8 * len(flat)

    def word(self, at: np.ndarray) -> np.ndarray:
        """At least 57 bits from each position, in the high bits."""
        if len(at) and int(at.max()) > self.end:
            raise ValueError("a stream ends within a frame")
        return self.window[at >> 3] << (at & 7).astype(np.uint64)

    def unsigned(self, at: np.ndarray, width) -> np.ndarray:
        width = np.broadcast_to(np.asarray(width, np.int64), at.shape)
        value = self.word(at) >> np.minimum(64 - width, 63).astype(np.uint64)
        return np.where(width > 0, value.astype(np.int64), 0)

    def signed(self, at: np.ndarray, width) -> np.ndarray:
        value, half = self.unsigned(at, width), np.int64(1) << np.maximum(np.asarray(width, np.int64) - 1, 0)
        return (value ^ half) - half

    def unary(self, at: np.ndarray) -> np.ndarray:
        """Zeros before the next one."""
        out, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
        while len(open_):
            word = self.word(at[open_] + out[open_]) & ~np.uint64(127)
            high = (word >> np.uint64(32)).astype(np.float64)
            low = (word & np.uint64(0xFFFFFFFF)).astype(np.float64)
            zeros = np.where(high > 0, 32 - np.frexp(high)[1], np.where(low > 0, 64 - np.frexp(low)[1], 57))
            out[open_] += zeros
            open_ = open_[word == 0]
        return out


def parse(stream: bytes) -> dict:
    """Metadata of one stream, and where its frames begin."""
    if stream[:4] != b"fLaC" or len(stream) < 42:
        raise ValueError("not a FLAC stream")
    at, last, info, seek = 4, False, b"", b""
    while not last:
        if at + 4 > len(stream):
            raise ValueError("the metadata is cut")
        last, kind, size = bool(stream[at] & 0x80), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        body = stream[at + 4 : at + 4 + size]
        info, seek = (body if kind == 0 else info), (body if kind == 3 else seek)
        at += 4 + size
    packed = int.from_bytes(info[10:18], "big")
    if packed >> 41 & 7:
        raise ValueError("only mono streams are read")
    return {
        "rate": packed >> 44, "bits": (packed >> 36 & 31) + 1, "samples": packed & ((1 << 36) - 1), "md5": info[18:34], "begin": at,
        "seek": [(int.from_bytes(seek[k : k + 8], "big"), int.from_bytes(seek[k + 8 : k + 16], "big")) for k in range(0, len(seek) - 17, 18)],
    }


def decode(streams: list[bytes]) -> list[np.ndarray]:
    """The samples of each stream.

    A frame's end is known once it is decoded, so the streams advance together, a frame each at a time; long
    streams are entered at every point of their seek tables at once.
    """
    if not streams:
        return []
    heads = [parse(s) for s in streams]
    flat = np.frombuffer(b"".join(streams), np.uint8)
    size = np.fromiter(map(len, streams), np.int64, len(streams))
    base = np.cumsum(size) - size
    bits = _Bits(flat)
    total = np.array([h["samples"] for h in heads], np.int64)
    out = np.zeros(int(total.sum()), np.int64)
    place = np.cumsum(total) - total
    # one lane for each entry point: where it starts and before which sample it stops
    lanes = []
    for k, h in enumerate(heads):
        points = sorted({(s, o) for s, o in h["seek"] if s < h["samples"]} | {(0, 0)})
        stops = [s for s, _ in points[1:]] + [h["samples"]]
        lanes += [(k, s, stop, h["begin"] + o) for (s, o), stop in zip(points, stops, strict=True)]
    stream, sample, stop, at = (np.array(x, np.int64) for x in zip(*lanes, strict=True))
    at = at + base[stream]
    depth = np.array([h["bits"] for h in heads], np.int64)
    live = np.flatnonzero(sample < stop)
    while len(live):
        count, end, values = _frames(flat, bits, at[live], depth[stream[live]])
        if ((end - base[stream[live]] > size[stream[live]]) | (sample[live] + count > stop[live])).any():
            raise ValueError("a stream's frames do not fit its metadata")
        column = np.arange(values.shape[1])
        r, c = np.nonzero(column < count[:, None])
        out[(place[stream[live]] + sample[live])[r] + c] = values[r, c]
        sample[live] += count
        at[live] = end
        live = live[sample[live] < stop[live]]
    result = np.split(out, np.cumsum(total)[:-1]) if len(streams) else []
    for h, x in zip(heads, result, strict=True):
        raw = x.astype(np.int8 if h["bits"] == 8 else "<i2").tobytes()
        if h["md5"] != bytes(16) and hashlib.md5(raw).digest() != h["md5"]:
            raise ValueError("the samples' checksum is wrong")
    return result


def _frames(flat: np.ndarray, bits: _Bits, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decode the frame at each byte position: sample counts, ends and samples."""
    begin, position = at, at * 8
    if (bits.unsigned(position, 15) != 0x7FFC).any():
        raise ValueError("a frame does not start with the sync code")
    size_code, lead = bits.unsigned(position + 16, 4), bits.unsigned(position + 32, 8)
    more = np.maximum(8 - np.frexp((~lead & 0xFF).astype(np.float64))[1], 1)  # bytes of the coded number
    position = position + 32 + 8 * np.where(lead < 0x80, 1, more)
    table_size = np.array([0, 192, *[576 << k for k in range(4)], 0, 0, *[256 << k for k in range(8)]], np.int64)
    count = table_size[size_code]
    for code, width in ((6, 8), (7, 16)):
        rows = size_code == code
        count[rows] = bits.unsigned(position[rows], width) + 1
        position[rows] += width
    if (count == 0).any():
        raise ValueError("a frame has no block size")
    head = (position >> 3) - begin
    if (checksums(flat, begin, head, 8) != bits.unsigned(position, 8)).any():
        raise ValueError("a frame header's checksum is wrong")
    position = position + 8
    kind, wasted = bits.unsigned(position + 1, 6), bits.unsigned(position + 7, 1)
    position = position + 8
    rows = wasted > 0
    if rows.any():
        wasted[rows] = bits.unary(position[rows]) + 1
        position[rows] += wasted[rows]
    depth = depth - wasted
    fixed, linear = (kind >= 8) & (kind <= 12), kind >= 32
    if not (fixed | linear | (kind < 2)).all():
        raise ValueError("a subframe's kind is reserved")
    order = np.where(fixed, kind - 8, np.where(linear, kind - 31, 0))
    grid = np.zeros((len(at), int(count.max())), np.int64)
    plain = np.where(kind == 0, 1, np.where(kind == 1, count, order))
    r, c = np.nonzero(np.arange(grid.shape[1]) < plain[:, None])
    grid[r, c] = bits.signed(position[r] + depth[r] * c, depth[r])
    position = position + depth * plain
    grid[kind == 0] = grid[kind == 0][:, :1]
    coded = np.flatnonzero(fixed | linear)
    if len(coded):
        position[coded] = _predicted(bits, grid, coded, position[coded], order[coded], count[coded], linear[coded])
    end = -(-position // 8)
    if (checksums(flat, begin, end - begin, 16) != bits.unsigned(end * 8, 16)).any():
        raise ValueError("a frame's checksum is wrong")
    return count, end + 2, grid << wasted[:, None]


def _predicted(bits: _Bits, grid: np.ndarray, rows: np.ndarray, at: np.ndarray, order: np.ndarray, count: np.ndarray, linear: np.ndarray) -> np.ndarray:
    """Fill in the samples of predicted subframes; returns where each ends."""
    most = max(1, int(order.max()))
    coefficient, shift = np.zeros((len(rows), most), np.int64), np.zeros(len(rows), np.int64)
    for k, c in enumerate(FIXED[: most + 1]):
        coefficient[(order == k) & ~linear, :k] = c
    l = np.flatnonzero(linear)
    if len(l):
        precision = bits.unsigned(at[l], 4) + 1
        shift[l] = bits.signed(at[l] + 4, 5)
        if (shift[l] < 0).any() or (precision > 15).any():
            raise ValueError("a predictor is not valid")
        for j in range(most):
            has = order[l] > j
            coefficient[l[has], j] = bits.signed(at[l[has]] + 9 + precision[has] * j, precision[has])
        at[l] += 9 + precision * order[l]
    method, power = bits.unsigned(at, 2), bits.unsigned(at + 2, 4)
    if (method > 1).any() or (count % (1 << power)).any():
        raise ValueError("a residual is not valid")
    at = at + 6
    width = 4 + method
    part = count >> power
    parameter, escaped = np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
    # longest first, so that the rows still open are always a prefix
    by = np.argsort(-count, kind="stable")
    rows, at, order, count, coefficient, shift, width, part, parameter, escaped = (x[by] for x in (rows, at, order, count, coefficient, shift, width, part, parameter, escaped))
    values = np.ascontiguousarray(grid[rows].T)
    open_at = len(count) - np.searchsorted(count[::-1], np.arange(1, int(count.max()) + 1))
    split = (part < count).any()
    for k, n in enumerate(open_at.tolist()):
        begins = np.flatnonzero((k % part[:n] == 0) | (k == order[:n])) if split or k <= most else ()
        if len(begins):
            # a partition begins at its first sample, the first one after the warm-up samples
            begins = begins[((k >= order[begins]) & ((k % part[begins] == 0) & (k > 0) | (k == order[begins]) & (k < part[begins])))]
            parameter[begins] = bits.unsigned(at[begins], width[begins])
            at[begins] += width[begins]
            special = parameter[begins] == (1 << width[begins]) - 1
            escaped[begins] = -1
            if special.any():
                e = begins[special]
                escaped[e] = bits.unsigned(at[e], 5)
                at[e] += 5
        if k < most:
            now = np.flatnonzero(order[:n] <= k)
            if not len(now):
                continue
        else:
            now = slice(0, n)
        where, p = at[now], parameter[now]
        if (escaped[now] >= 0).any():
            raw = escaped[now]
            zeros = np.where(raw >= 0, 0, bits.unary(where))
            rest = bits.unsigned(where + zeros + 1, p)
            folded = zeros << p | rest
            residual = np.where(raw >= 0, np.where(raw > 0, bits.signed(where, np.maximum(raw, 1)), 0), folded >> 1 ^ -(folded & 1))
            at[now] = where + np.where(raw >= 0, raw, zeros + 1 + p)
        else:
            word = bits.word(where)
            top = (word >> np.uint64(32)).astype(np.float64)
            zeros = 32 - np.frexp(top)[1].astype(np.int64)
            far = zeros + p > 30
            folded = zeros << p | (word << (zeros + 1).astype(np.uint64) >> np.uint64(1) >> (63 - p).astype(np.uint64)).astype(np.int64)
            if far.any():
                f = np.flatnonzero(far)
                zeros[f] = bits.unary(where[f])
                folded[f] = zeros[f] << p[f] | bits.unsigned(where[f] + zeros[f] + 1, p[f])
            residual = folded >> 1 ^ -(folded & 1)
            at[now] = where + zeros + 1 + p
        total = np.zeros(len(residual), np.int64)
        for j in range(min(most, k)):
            total += coefficient[now, j] * values[k - 1 - j, now]
        values[k, now] = residual + (total >> shift[now])
    grid[rows] = values.T
    out = np.empty_like(at)
    out[by] = at
    return out


# ---------------------------------------------------------------- Spark


def payload(text: str | None) -> tuple[bytes, int]:
    """The text as UTF-8 and zero bytes up to a positive multiple of 64, and the size without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % 64 or (64 if not raw else 0)), len(raw)


def to_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: the stored form of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text, SLICE):
                made = [payload(t) for t in part.column(text).to_pylist()]
                media = encode([p for p, _ in made])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([n for _, n in made], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _media_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    yield from text_slices(batch, "media", SLICE)


def pcm_blocks(media: DataFrame, block: int = 4096) -> DataFrame:
    """Decode media columns to PCM blocks: doc_id, block, sample_offset, n_samples and pcm (signed samples)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _media_slices(batch.filter(batch.column("media").is_valid())):
                rows = []
                for doc_id, x in zip(part.column("doc_id").to_pylist(), decode(part.column("media").to_pylist()), strict=True):
                    rows += [(doc_id, k // block, k, len(y := x[k : k + block]), y.astype("<i2").tobytes()) for k in range(0, len(x), block)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "block", "sample_offset", "n_samples", "pcm"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, block long, sample_offset long, n_samples long, pcm binary")


def features(x: np.ndarray) -> str:
    """Peak, energy and zero crossings of signed samples, as whole numbers."""
    sign = x < 0
    return f"n={len(x)};peak={int(np.abs(x).max())};energy={int((x * x).sum())};crossings={int((sign[1:] != sign[:-1]).sum())}"


def digests(media: DataFrame) -> DataFrame:
    """Read the stored bytes back and compute digests and features, one row per media column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _media_slices(batch):
                stored = part.column("media").to_pylist()
                samples = decode(stored)
                raw = [(x + 128).astype(np.uint8).tobytes() for x in samples]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_bytes": part.column("n_bytes"),
                        "payload_bytes": pa.array([len(x) for x in raw], pa.int64()),
                        "payload_sha256": [hashlib.sha256(x).hexdigest() for x in raw],
                        "tail_crc32": pa.array([zlib.crc32(x[-64:]) for x in raw], pa.int64()),
                        "media_bytes": pa.array([len(x) for x in stored], pa.int64()),
                        "media_sha256": [hashlib.sha256(x).hexdigest() for x in stored],
                        "feature": [features(x) for x in samples],
                    }
                )

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op10_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    # stored in the shared folder, then read back: a lost executor costs no encoding, and the media stay as a table
    return digests(publish(to_media(table(spark, sf_dir, "documents")), "media", compression="zstd"))
