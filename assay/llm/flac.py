"""A FLAC codec for 8-bit mono samples, vectorised over the frames of many streams.

The encoder writes fixed-block streams of constant, verbatim, fixed-predictor and linear-predictor subframes
with one Rice partition; the decoder reads those kinds of any order with any Rice partitioning, and checks every
header's CRC-8 and every frame's CRC-16. A frame begins where the decoded one before it ends.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np

BLOCK = 576
SEEK_EVERY = 16
#: Frames that are coded at a time; 2.4 MB of payload.
RUN = 4096
#: Order, bits and shift of the linear predictors that ``encode`` writes.
_ORDER, _PRECISION, _SHIFT = 4, 12, 8
#: A linear predictor is the costliest to decode and hides repeats from the files' own compression: it is written
#: where its residuals add up to at most this share of those of the best fixed predictor.
_GAIN = 0.75
#: Zeros after the data, so that the fixed-width parts of a frame can be looked at wherever it begins.
_PAD = bytes(64)
#: Zeros of a Rice code beyond which a frame counts as broken; residuals of 8-bit samples stay far below.
_MOST_ZEROS = 1 << 20


def _crc_table(poly: int, bits: int) -> np.ndarray:
    table = []
    for c in range(256):
        c <<= bits - 8
        for _ in range(8):
            c = ((c << 1) ^ poly if c >> (bits - 1) else c << 1) & ((1 << bits) - 1)
        table.append(c)
    return np.array(table, np.uint32)


#: Fixed values of the format: the polynomials of its header and frame checksums.
_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
_CRC8_LIST = _CRC8.tolist()


class FlacError(ValueError):
    """A stream that breaks the format or a checksum."""


def _crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8_LIST[c ^ b]
    return c


def _crc16(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-16 of many ranges at once; zeros before a range leave its checksum alone, so all end together."""
    most = int(length.max(initial=0))
    crc = np.zeros(len(start), np.uint32)
    end = start + length
    for j in range(most, 0, -1):
        at = end - j
        byte = np.where(at >= start, buf[np.maximum(at, 0)], 0)
        crc = ((crc << 8) & 0xFFFF) ^ _CRC16[(crc >> 8) ^ byte]
    return crc


def _coded_number(n: int) -> bytes:
    """A frame number in the format's UTF-8-like code."""
    if n < 0x80:
        return bytes([n])
    more = next(m for m in range(1, 6) if n < 1 << (6 * m + 6 - m))
    lead = (0xFF00 >> (more + 1)) & 0xFF | n >> (6 * more)
    return bytes([lead, *((0x80 | n >> (6 * k) & 0x3F) for k in range(more - 1, -1, -1))])


def _header(number: int) -> bytes:
    head = bytes([0xFF, 0xF8, 0x20, 0x02]) + _coded_number(number)
    return head + bytes([_crc8(head)])


def _metadata(samples: bytes, frame_bytes: list[int]) -> bytes:
    n = len(samples)
    digest = hashlib.md5((np.frombuffer(samples, np.uint8) ^ 0x80).tobytes()).digest()
    info = struct.pack(">HH", BLOCK, BLOCK) + bytes(6) + (8000 << 44 | 0 << 41 | 7 << 36 | n).to_bytes(8, "big") + digest
    at, points = 0, []
    for k, size in enumerate(frame_bytes):
        if k % SEEK_EVERY == 0:
            points.append(struct.pack(">QQH", k * BLOCK, at, BLOCK))
        at += size
    table = b"".join(points)
    return b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + bytes([0x83]) + len(table).to_bytes(3, "big") + table


def _linear(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients of a linear predictor of each frame (latest sample first) and its residuals after the warm-up.

    Levinson-Durbin on exact autocorrelations, one element-wise step at a time, so equal frames give equal bits everywhere.
    """
    wide = x.astype(np.int64)
    r = [(wide[:, : BLOCK - k] * wide[:, k:]).sum(axis=1).astype(float) for k in range(_ORDER + 1)]
    error = r[0] * (1 + 1e-9) + 1e-6
    a: list[np.ndarray] = []
    for i in range(_ORDER):
        turn = (r[i + 1] - sum((a[j] * r[i - j] for j in range(i)), np.zeros(len(x)))) / error
        a = [a[j] - turn * a[i - 1 - j] for j in range(i)] + [turn]
        error = np.maximum(error * (1 - turn * turn), 1e-6)
    top = 1 << (_PRECISION - 1)
    coefs = np.clip(np.rint(np.stack(a, axis=1) * (1 << _SHIFT)), -top, top - 1).astype(np.int64)
    guess = sum(coefs[:, j, None] * wide[:, _ORDER - 1 - j : BLOCK - 1 - j] for j in range(_ORDER)) >> _SHIFT
    return coefs, wide[:, _ORDER:] - guess


def _coded(x: np.ndarray, numbers: list[int]) -> tuple[bytes, np.ndarray]:
    """The frames of rows of samples with these numbers, end to end, and their lengths.

    Each is coded by the shortest of a constant, the fixed predictors of order 0 to 2, a linear predictor and the plain samples.
    """
    frames = len(x)
    heads = [_header(k) for k in numbers]
    head_len = np.array([len(h) for h in heads])

    fold = lambda r: np.where(r < 0, -2 * r - 1, 2 * r)
    coefs, residual = _linear(x)
    # of each way of prediction: its warm-up samples, the bits of its coefficients, its residuals
    ways = [(0, 0, x), (1, 0, np.diff(x, axis=1)), (2, 0, np.diff(x, n=2, axis=1)), (_ORDER, 9 + _ORDER * _PRECISION, residual)]
    cost = np.stack([fold(r).sum(axis=1) + 24 * w for w, _, r in ways])
    cost[-1] += 2 * ways[-1][1]
    cost[-1, cost[-1] > _GAIN * cost[:-1].min(axis=0)] = 1 << 40
    way = np.argmin(cost, axis=0)
    constant = (x == x[:, :1]).all(axis=1)
    mean = np.take_along_axis(cost, way[None], 0)[0] / BLOCK
    guess = np.clip(np.floor(np.log2(np.maximum(mean, 1))).astype(int), 0, 13)
    param, bits = guess.copy(), np.full(frames, 1 << 30)
    folded = {}
    for o, (warm, more, r) in enumerate(ways):
        at = np.flatnonzero(way == o)
        u = folded[o] = fold(r[at]).astype(np.int64)
        for step in (-1, 0, 1):
            k = np.clip(guess[at] + step, 0, 14)
            size = (u >> k[:, None]).sum(axis=1) + u.shape[1] * (1 + k) + 10 + 8 * warm + more
            better = size < bits[at]
            bits[at[better]], param[at[better]] = size[better], k[better]
    verbatim = ~constant & (bits >= 8 * BLOCK)
    bits[constant], bits[verbatim] = 8, 8 * BLOCK
    body = (8 + bits + 7) // 8
    length = head_len + body + 2
    start = np.cumsum(length) - length
    stream = np.zeros(int(length.sum()) * 8, np.uint8)
    data_bit = (start + head_len) * 8
    put = lambda at, value, n: [stream.__setitem__(at + b, (value >> (n - 1 - b)) & 1) for b in range(n)]
    kind = np.where(constant, 0, np.where(verbatim, 1, np.where(way < 3, 8 + way, 31 + _ORDER)))
    put(data_bit, kind << 1, 8)
    at = np.flatnonzero(constant)
    put(data_bit[at] + 8, x[at, 0] & 0xFF, 8)
    at = np.flatnonzero(verbatim)
    put(data_bit[at][:, None] + 8 + 8 * np.arange(BLOCK), x[at] & 0xFF, 8)
    for o, (warm, more, _) in enumerate(ways):
        owners = np.flatnonzero(way == o)
        coded = ~(constant | verbatim)[owners]
        for k in np.unique(param[owners[coded]]):
            pick = coded & (param[owners] == k)
            at, u = owners[pick], folded[o][pick]
            begin = data_bit[at] + 8
            for w in range(warm):
                put(begin + 8 * w, x[at, w] & 0xFF, 8)
            begin = begin + 8 * warm
            if more:
                put(begin, np.full(len(at), _PRECISION - 1), 4)
                put(begin + 4, np.full(len(at), _SHIFT), 5)
                for j in range(_ORDER):
                    put(begin + 9 + _PRECISION * j, coefs[at, j], _PRECISION)
                begin = begin + more
            put(begin, np.full(len(at), int(k)), 10)  # method 0, one partition, parameter
            q = u >> k
            size = q + 1 + k
            pos = (begin + 10)[:, None] + np.cumsum(size, axis=1) - size + q
            stream[pos] = 1
            put(pos + 1, u & ((1 << int(k)) - 1), int(k))
    out = np.packbits(stream)
    flat = np.frombuffer(b"".join(heads), np.uint8)
    shift = np.repeat(start - (np.cumsum(head_len) - head_len), head_len)
    out[np.arange(len(flat)) + shift] = flat
    crc = _crc16(out, start, length - 2)
    out[start + length - 2], out[start + length - 1] = crc >> 8, crc & 0xFF
    return out.tobytes(), length


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of payloads whose lengths are positive multiples of the block; byte b is the sample b - 128.

    Frames are coded in runs of at most ``RUN``, so what is held besides payloads and streams is bounded.
    """
    if any(not p or len(p) % BLOCK for p in payloads):
        raise ValueError("payloads must be positive multiples of the block")
    pieces: list[list[bytes]] = [[] for _ in payloads]
    lengths: list[list[np.ndarray]] = [[] for _ in payloads]
    run: list[tuple[int, int, int]] = []  # payload, first frame, frames
    room = RUN

    def flush() -> None:
        x = np.frombuffer(b"".join(payloads[k][f * BLOCK : (f + n) * BLOCK] for k, f, n in run), np.uint8).reshape(-1, BLOCK).astype(np.int32) - 128
        data, size = _coded(x, [f + i for _, f, n in run for i in range(n)])
        ends = np.append(0, np.cumsum(size))
        at = 0
        for k, _, n in run:
            pieces[k].append(data[ends[at] : ends[at + n]])
            lengths[k].append(size[at : at + n])
            at += n
        run.clear()

    for k, p in enumerate(payloads):
        f, n = 0, len(p) // BLOCK
        while f < n:
            take = min(room, n - f)
            run.append((k, f, take))
            f, room = f + take, room - take
            if not room:
                flush()
                room = RUN
    if run:
        flush()
    return [b"".join([_metadata(p, np.concatenate(size).tolist()), *parts]) for p, parts, size in zip(payloads, pieces, lengths)]


# ---- reading


def stream_info(stream: bytes) -> dict:
    """Block size, sample count, MD5, seek points ``(sample, byte offset, samples)`` and where frames begin."""
    if stream[:4] != b"fLaC":
        raise FlacError("no FLAC marker")
    at, last, info = 4, False, {"seek": []}
    while not last:
        if at + 4 > len(stream):
            raise FlacError("the metadata runs over the stream")
        kind, size = stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        last, body = bool(stream[at] & 0x80), stream[at + 4 : at + 4 + size]
        if len(body) < size or kind == 0 and size != 34 or kind == 3 and size % 18:
            raise FlacError("a metadata block has a wrong size")
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            if packed >> 41 & 7 or packed >> 36 & 31 != 7:
                raise FlacError("only 8-bit mono streams are read")
            info |= {"block": int.from_bytes(body[2:4], "big"), "samples": packed & ((1 << 36) - 1), "md5": body[18:34]}
            if body[:2] != body[2:4] or info["block"] < 16:
                raise FlacError("only streams of one block size are read")
        elif kind == 3:
            info["seek"] = [struct.unpack(">QQH", body[k : k + 18]) for k in range(0, size, 18)]
        at += 4 + size
    if "samples" not in info:
        raise FlacError("no stream information")
    if info["samples"] > (len(stream) - at) * info["block"]:
        raise FlacError("more samples than the stream can hold")
    return info | {"first": at}


def _frame_head(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(frame number, samples, header length) of a frame header with a right checksum, else None."""
    if at + 6 > end or data[at] != 0xFF or data[at + 1] != 0xF8 or data[at + 4] == 0xFF:
        return None
    lead = data[at + 4]
    more = 0 if lead < 0x80 else 7 - (lead ^ 0xFF).bit_length()
    number = lead if not more else lead & (0x3F >> more)
    if at + 10 + more > end:
        return None
    for k in range(more):
        number = number << 6 | data[at + 5 + k] & 0x3F
    n, code = at + 5 + more, data[at + 2] >> 4
    if code in (6, 7):
        wide = code - 5
        block, n = int.from_bytes(data[n : n + wide], "big") + 1, n + wide
    else:
        block = 192 if code == 1 else 576 << (code - 2) if 2 <= code <= 5 else 256 << (code - 8) if code else 0
    n += {12: 1, 13: 2, 14: 2}.get(data[at + 2] & 15, 0)
    return (number, block, n + 1 - at) if n < end and _crc8(data[at:n]) == data[n] else None


def _samples_of(info: dict, number: int) -> int:
    """Samples that a frame of this number must have; 0 beyond the last."""
    return min(info["block"], max(0, info["samples"] - number * info["block"]))


def _likely_frames(data: bytes, first: int, end: int, info: dict, number: int = 0) -> list[tuple[int, int, int]]:
    """Frames ``(at, samples, header length)`` by their headers in turn: right unless coded samples look like a header."""
    found, at = [], first
    while want := _samples_of(info, number):
        head = _frame_head(data, at, end)
        if head and head[:2] == (number, want):
            found.append((at, want, head[2]))
            number += 1
        elif not found:
            break
        if _samples_of(info, number):
            at = data.find(b"\xff\xf8", at + 1, end)
            if at < 0:
                break
    return found


class _Bits:
    """A bit reader for one frame, for the rare kinds; reading past ``end`` is an error."""

    def __init__(self, data: bytes, bit: int, end: int):
        self.data, self.bit, self.end = data, bit, 8 * end

    def take(self, n: int, signed: bool = False) -> int:
        if self.bit + n > self.end:
            raise FlacError("a frame runs over its stream")
        lo, hi = self.bit >> 3, (self.bit + n + 7) >> 3
        v = int.from_bytes(self.data[lo:hi], "big") >> (8 * hi - self.bit - n) & ((1 << n) - 1)
        self.bit += n
        return v - (1 << n) if signed and n and v >> (n - 1) else v

    def zeros(self) -> int:
        """Zeros up to the next one, which is read too."""
        begin = self.bit
        at, left = self.bit >> 3, 8 - (self.bit & 7)
        byte = self.data[at] & ((1 << left) - 1) if 8 * at < self.end else 0
        while not byte:
            at += 1
            if 8 * at >= self.end or 8 * at - begin > _MOST_ZEROS:
                raise FlacError("a code without end")
            byte = self.data[at]
        self.bit = 8 * at + 9 - byte.bit_length()
        return self.bit - 1 - begin


def _predict(warm: list[int], residual: list[int], coefs: list[int], shift: int) -> list[int]:
    s = list(warm)
    for r in residual:
        s.append(r + (sum(c * s[-1 - j] for j, c in enumerate(coefs)) >> shift))
        if not -128 <= s[-1] < 128:
            raise FlacError("a sample out of range")
    return s


#: Fixed values of the format: the coefficients of its fixed predictors, latest sample first.
_FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def decode_frame(data: bytes, at: int, block: int, head: int, end: int) -> tuple[list[int], int]:
    """The samples of one frame and the byte after it, a value at a time; the plain form of what ``decode`` does for many."""
    b = _Bits(data, 8 * (at + head), end)
    kind = b.take(8)
    if kind & 0x80:
        raise FlacError("a subframe begins with a one")
    wasted = b.zeros() + 1 if kind & 1 else 0
    kind, depth = kind >> 1, 8 - wasted
    if depth < 1:
        raise FlacError("no bits left of a sample")
    if kind == 0:
        s = [b.take(depth, True)] * block
    elif kind == 1:
        s = [b.take(depth, True) for _ in range(block)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        if order > block:
            raise FlacError("more warm-up samples than a frame has")
        warm = [b.take(depth, True) for _ in range(order)]
        coefs, shift = _FIXED[order] if kind < 32 else [], 0
        if kind >= 32:
            precision, shift = b.take(4) + 1, b.take(5, True)
            if precision > 15 or shift < 0:
                raise FlacError("a reserved precision or shift")
            coefs = [b.take(precision, True) for _ in range(order)]
        method, parts = b.take(2), b.take(4)
        wide = 4 + method
        if method > 1 or block % (1 << parts) or block >> parts < order:
            raise FlacError("a reserved or uneven division of residuals")
        residual = []
        for p in range(1 << parts):
            k = b.take(wide)
            count = (block >> parts) - (order if p == 0 else 0)
            if k == (1 << wide) - 1:
                raw = b.take(5)
                residual += [b.take(raw, True) for _ in range(count)]
                continue
            for _ in range(count):
                u = b.zeros() << k | b.take(k)
                residual.append(u >> 1 ^ -(u & 1))
        s = _predict(warm, residual, coefs, shift)
    else:
        raise FlacError("reserved subframe")
    stop = ((b.bit + 7) >> 3) + 2
    if stop > end:
        raise FlacError("a frame runs over its stream")
    return [v << wasted for v in s], stop


def _rice(words: np.ndarray, pos: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One Rice code at each bit position: signed values and the positions after them. A code that meets the end stops there."""
    last = 8 * len(words) - 8
    look = lambda p: words[np.minimum(p, last) >> 3].astype(np.uint64) << (p & 7).astype(np.uint64)
    word = look(pos)
    q = np.zeros(len(pos), np.int64)
    while (long := word < 1 << 22).any():  # zeros beyond the window
        at = np.flatnonzero(long)
        q[at] += 42
        pos = pos.copy()
        pos[at] += 42
        over = (pos[at] >= last) | (q[at] > _MOST_ZEROS)
        pos[at[over]] = last + 8  # past every stream, so the frame is found out
        word[at] = np.where(over, np.uint64(1 << 63), look(pos[at]))
    zeros = 1075 - ((word >> np.uint64(11)).astype(np.float64).view(np.int64) >> 52)
    q += zeros
    pos = pos + zeros + 1
    rest = look(pos)
    u = q << k | np.where(k > 0, rest >> (64 - k).astype(np.uint64) % np.uint64(64), 0).astype(np.int64)
    return u >> 1 ^ -(u & 1), pos + k


def _decode_many(data: bytes, at: np.ndarray, block: int, head: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples (frames x block) and ends of what should be frames of one block size; the end is 0 where it can't be one."""
    buf = np.frombuffer(data + _PAD, np.uint8)
    words = np.ndarray(len(data) + len(_PAD) - 8, ">u8", buf.tobytes(), strides=(1,))
    out = np.zeros((len(at), block), np.int64)
    end = np.zeros(len(at), np.int64)
    kind = buf[at + head].astype(int)
    slow = (kind & 0x81 != 0) | ((kind >> 1 > 1) & (kind >> 1 < 8)) | ((kind >> 1 > 12) & (kind >> 1 < 32))
    body = at + head + 1
    signed = lambda v: v.astype(np.int8).astype(np.int64)
    for f in np.flatnonzero(~slow & (kind == 0)):
        out[f], end[f] = signed(buf[body[f] : body[f] + 1])[0], body[f] + 3
    if len(f := np.flatnonzero(~slow & (kind == 2))):
        out[f] = signed(buf[np.minimum(body[f][:, None] + np.arange(block), len(buf) - 1)])
        end[f] = body[f] + block + 2
    bits = lambda pos, n: (words[np.minimum(pos >> 3, len(words) - 1)].astype(np.uint64) << (pos & 7).astype(np.uint64) >> np.uint64(64 - n)).astype(np.int64)
    for code in np.unique(kind[~slow & (kind > 2)]):
        f = np.flatnonzero(~slow & (kind == code))
        lpc, order = code >= 64, (code >> 1) - (31 if code >= 64 else 8)
        warm = signed(buf[body[f][:, None] + np.arange(order)])
        pos = (body[f] + order) * 8
        coefs = shift = None
        if lpc:
            precision, shift = bits(pos, 4) + 1, bits(pos + 4, 5)
            if (precision != precision[0]).any() or (shift > 15).any() or precision[0] > 15:
                slow[f] = True
                continue
            pos, n = pos + 9, int(precision[0])
            c = [bits(pos + n * j, n) for j in range(order)]
            coefs, pos = np.stack([v - (v >> (n - 1) << n) for v in c], axis=1), pos + n * order
        mode = bits(pos, 6)
        for m in np.unique(mode):
            pick = np.flatnonzero(mode == m)
            g, p = f[pick], pos[pick] + 6
            wide, parts = 4 + (int(m) >> 4), int(m) & 15
            if wide > 5 or block % (1 << parts) or block >> parts < order:
                slow[g] = True
                continue
            residual = np.zeros((len(g), block), np.int64)
            odd = np.zeros(len(g), bool)
            for i in range(order, block):
                if i == order or i % (block >> parts) == 0:
                    k = bits(p, wide)
                    p = p + wide
                    odd |= k == (1 << wide) - 1
                residual[:, i], nxt = _rice(words, np.where(odd, pos[pick], p), np.where(odd, 0, k))
                p = np.where(odd, p, nxt)
            slow[g[odd]] = True
            s = residual
            s[:, :order] = warm[pick]
            if lpc:
                for i in range(order, block):
                    s[:, i] += (coefs[pick] * s[:, i - order : i][:, ::-1]).sum(axis=1) >> shift[pick]
            else:
                d = s[:, order:]
                for level in range(order - 1, -1, -1):
                    # the difference of this level at its last warm-up place, then the running sum
                    base = np.diff(s[:, :order], n=level, axis=1)[:, -1:]
                    d = np.cumsum(np.concatenate([base, d], axis=1), axis=1)[:, 1:]
                s[:, order:] = d
            out[g], end[g] = s, (p + 7 >> 3) + 2
    for f in np.flatnonzero(slow):
        try:
            out[f], end[f] = decode_frame(data, int(at[f]), block, int(head[f]), int(limit[f]))
        except FlacError:
            end[f] = 0
    end[(end > limit) | ((out < -128) | (out > 127)).any(axis=1)] = 0
    return out, end


def _in_turn(data: bytes, first: int, limit: int, info: dict, number: int = 0, count: int | None = None) -> np.ndarray:
    """Samples of a stream's frames one after the other, each found where the one before it ends."""
    at, parts = first, []
    while (want := _samples_of(info, number)) and (count is None or len(parts) < count):
        head = _frame_head(data, at, limit)
        if not head or head[:2] != (number, want):
            raise FlacError(f"no frame {number} where it should be")
        samples, end = decode_frame(data, at, want, head[2], limit)
        if _crc16(np.frombuffer(data, np.uint8), np.array([at]), np.array([end - 2 - at]))[0] != int.from_bytes(data[end - 2 : end], "big"):
            raise FlacError("a frame checksum is wrong")
        parts.append(np.array(samples, np.int64))
        at, number = end, number + 1
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _runs(streams: list[bytes], infos: list[dict], runs: list[tuple[int, int, int | None]]) -> list[np.ndarray]:
    """For each stream the samples of ``count`` frames (None: all) from frame ``number`` at byte ``offset`` of its frames.

    All frames that the headers show are decoded together. Where they don't join, each ending where the next begins,
    with right checksums, the stream is read again frame by frame.
    """
    data = b"".join(streams)
    frames, owner, base = [], [], 0
    bases = []
    for k, (s, info, (number, offset, count)) in enumerate(zip(streams, infos, runs)):
        found = _likely_frames(data, base + info["first"] + offset, base + len(s), info, number)[:count]
        frames += [(*f, base + len(s)) for f in found]
        owner += [k] * len(found)
        bases.append(base)
        base += len(s)
    at, block, head, limit = (np.array(c, np.int64) for c in zip(*frames)) if frames else [np.empty(0, np.int64)] * 4
    parts: list[np.ndarray] = [None] * len(at)  # type: ignore[list-item]
    end = np.zeros(len(at), np.int64)
    for b in np.unique(block):
        f = np.flatnonzero(block == b)
        samples, end[f] = _decode_many(data, at[f], int(b), head[f], limit[f])
        for j, g in enumerate(f):
            parts[g] = samples[j]
    good = end >= at + 8
    buf = np.frombuffer(data, np.uint8)
    g = np.flatnonzero(good)
    good[g] = _crc16(buf, at[g], end[g] - at[g] - 2) == (buf[end[g] - 2].astype(np.uint32) << 8 | buf[end[g] - 1])
    owners = np.array(owner, np.int64)
    follows = np.append((owners[1:] != owners[:-1]) | (end[:-1] == at[1:]), True) if len(at) else np.empty(0, bool)
    counts = np.bincount(owners, minlength=len(streams))
    wrong = np.bincount(owners, ~(good & follows), minlength=len(streams)) > 0
    out, f = [], 0
    for k, (info, (number, offset, count)) in enumerate(zip(infos, runs)):
        n = int(counts[k])
        whole = -(-info["samples"] // info["block"]) - number
        if wrong[k] or n < (whole if count is None else min(count, whole)):
            pcm = _in_turn(data, bases[k] + info["first"] + offset, bases[k] + len(streams[k]), info, number, count)
        else:
            pcm = np.concatenate(parts[f : f + n]) if n else np.empty(0, np.int64)
        out.append(pcm.astype(np.int8))
        f += n
    return out


def decode(streams: list[bytes]) -> list[np.ndarray]:
    """Signed samples (int8) of each stream. Raises FlacError where a checksum, a count or the MD5 is wrong."""
    infos = [stream_info(s) for s in streams]
    out = _runs(streams, infos, [(0, 0, None)] * len(streams))
    for info, pcm in zip(infos, out):
        if len(pcm) != info["samples"] or any(info["md5"]) and hashlib.md5(pcm.tobytes()).digest() != info["md5"]:
            raise FlacError("samples differ from the stream's MD5")
    return out


def decode_runs(stream: bytes) -> Iterator[np.ndarray]:
    """The samples of one stream in runs of about ``RUN`` frames, by its seek table, with the checks of ``decode``; without a table, all at once."""
    info = stream_info(stream)
    first, block = info["first"], info["block"]
    cuts = [(s // block, first + at) for s, at, _ in info["seek"] if s % block == 0 and 0 < s < info["samples"]]
    digest, n = hashlib.md5(), 0
    number, at = 0, first
    for next_number, end in [*sorted(cuts), (-(-info["samples"] // block), len(stream))]:
        last = end == len(stream)
        if next_number - number < RUN and not last:
            continue
        part = stream[at:end]
        pcm = _runs([part], [info | {"first": 0}], [(number, 0, None if last else next_number - number)])[0]
        digest.update(pcm.tobytes())
        n += len(pcm)
        yield pcm
        number, at = next_number, end
    if n != info["samples"] or any(info["md5"]) and digest.digest() != info["md5"]:
        raise FlacError("samples differ from the stream's MD5")


def read_samples(streams: list[bytes], offsets: list[int], counts: list[int]) -> list[np.ndarray]:
    """``counts`` samples of each stream from ``offsets`` on, fewer where the stream ends.

    Only the frames from the last seek point before the offset up to the last sample asked for are decoded.
    """
    infos, runs, skip = [stream_info(s) for s in streams], [], []
    for info, offset, count in zip(infos, offsets, counts):
        offset = min(max(0, offset), info["samples"])
        count = min(max(0, count), info["samples"] - offset)
        points = [p for p in info["seek"] if p[0] <= offset and p[0] % info["block"] == 0 and p[0] < info["samples"]]
        sample, byte, _ = max(points, default=(0, 0, 0))
        runs.append((sample // info["block"], byte, -(-(offset + count - sample) // info["block"]) if count else 0))
        skip.append((offset - sample, count))
    return [pcm[lo : lo + n] for pcm, (lo, n) in zip(_runs(streams, infos, runs), skip)]
