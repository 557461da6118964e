"""Payloads as FLAC streams in a binary column, and FLAC streams as PCM blocks.

The encoder writes mono streams of 8 bits; the decoder reads up to eight channels, independent or side-coded, of up to
24 bits. Many frames are coded at a time: the decoder steps through the samples of all frames of a batch together,
reading one Rice code of each, so its work per sample is a few vector operations. Frames are taken in groups of bounded
size, so a long stream takes little more memory than its own bytes and samples.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import joined_bytes, slices, text_or_empty

BLOCK = 1024
#: Order, coefficient bits and shift of the encoder's own linear predictor.
ORDER, PRECISION, SHIFT = 4, 12, 9
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
#: Bytes that one call encodes, and decodes; the decoder's steps pay off over many frames.
ENCODED, DECODED = 1 << 18, 1 << 21
#: Frames that are coded together.
FRAMES = {"encode": ENCODED // BLOCK, "decode": DECODED // BLOCK}


def crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        out = np.where(out >> (bits - 1) & 1, out << 1 ^ poly, out << 1) & ((1 << bits) - 1)
    return out


CRC8, CRC16 = crc_table(0x07, 8), crc_table(0x8005, 16)


@functools.lru_cache(65536)
def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = int(CRC8[crc ^ b])
    return crc


def crc16(flat: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Frame checksums of the byte spans [start, stop), all spans stepping together."""
    order = np.argsort(start - stop, kind="stable")
    s, n = start[order], (stop - start)[order]
    crc = np.zeros(len(s), np.uint32)
    live = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), "left")
    for i, k in enumerate(live.tolist()):
        c = crc[:k]
        crc[:k] = (c << 8 & 0xFFFF) ^ CRC16[c >> 8 ^ flat[s[:k] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def coded_number(n: int) -> bytes:
    """A frame number in the variable-length form of frame headers."""
    if n < 128:
        return bytes([n])
    more = next(k for k in range(1, 6) if n < 1 << (6 * k + 6 - k))
    return bytes([(0xFF00 >> (more + 1) & 0xFF) | n >> (6 * more)]) + bytes([0x80 | n >> (6 * i) & 63 for i in reversed(range(more))])


@functools.lru_cache(65536)
def frame_header(number: int, size: int) -> bytes:
    head = b"\xff\xf8\x70\x02" + coded_number(number) + (size - 1).to_bytes(2, "big")
    return head + bytes([crc8(head)])


def predictors(x: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each frame (row) the best of fixed orders 0 to 2 and a fitted linear predictor: kind (3: fitted), order, coefficients, residuals."""
    width = x.shape[1]
    lags = np.stack([np.einsum("ij,ij->i", x[:, k:], x[:, : width - k]) for k in range(ORDER + 1)], 1).astype(float)
    lags[:, 0] = lags[:, 0] * 1.0001 + 1.0
    toeplitz = lags[:, np.abs(np.subtract.outer(np.arange(ORDER), np.arange(ORDER)))]
    fitted = np.linalg.solve(toeplitz, lags[:, 1:, None])[:, :, 0]
    fitted = np.clip(np.rint(fitted * (1 << SHIFT)), -(1 << PRECISION - 1), (1 << PRECISION - 1) - 1).astype(np.int32)
    ahead = np.zeros_like(x)
    for j in range(ORDER):
        ahead[:, ORDER:] += fitted[:, j : j + 1] * x[:, ORDER - 1 - j : width - 1 - j]
    once = x.copy()
    once[:, 1:] -= x[:, :-1]
    twice = once.copy()
    twice[:, 1:] -= once[:, :-1]
    found = [x, once, twice, x - (ahead >> SHIFT)]
    for r in found[1:]:
        r *= valid
    cost = np.stack([np.abs(r[:, o:]).sum(1) for r, o in zip(found, (0, 1, 2, ORDER))], 1)
    kind = cost.argmin(1)
    residual = found[3]
    for o in range(3):
        residual[kind == o] = found[o][kind == o]
    return kind, np.array([0, 1, 2, ORDER])[kind], fitted, residual


def put_bits(words: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray | int) -> None:
    """Adds values of 1 to 57 bits at bit positions of big-endian 64-bit words, where nothing stands yet."""
    width = np.asarray(width, np.int64)
    over = (at & 63) + width - 64
    value = value.astype(np.uint64)
    np.add.at(words, at >> 6, value >> np.maximum(over, 0).astype(np.uint64) << np.maximum(-over, 0).astype(np.uint64))
    cut = np.flatnonzero(over > 0)
    np.add.at(words, (at[cut] >> 6) + 1, value[cut] << (64 - over[cut]).astype(np.uint64))


def encode_frames(flat: np.ndarray, number: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes one after another, bytes of each) of the frames of 8-bit samples that start at ``start`` in ``flat``."""
    column = np.arange(BLOCK)
    valid = column < length[:, None]
    x = np.where(valid, flat[np.minimum(start[:, None] + column, len(flat) - 1)].astype(np.int32) - 128, 0).astype(np.int32)
    same = (np.where(valid, x, x[:, :1]) == x[:, :1]).all(1)
    kind, order, fitted, residual = predictors(x, valid)
    parts = np.where(length % 4 == 0, 4, 1)
    parts[(length // 4 <= order)] = 1
    size = length // parts
    folded = residual << 1 ^ residual >> 31
    coded = valid & (column >= order[:, None]) & ~same[:, None]
    part = sum((column >= j * size[:, None]).view(np.int8) for j in (1, 2, 3)) * (parts == 4)[:, None]
    cell = (np.arange(len(x)) * 4).astype(np.int32)[:, None] + part
    at_coded = np.flatnonzero(coded)
    own = cell.ravel()[at_coded]
    code = folded.ravel()[at_coded].astype(np.int64)
    total = np.bincount(own, code, 4 * len(x))
    count = np.bincount(own, minlength=4 * len(x))
    # the parameter of fewest bits lies next to the one for the mean
    mean = np.clip(np.ceil(np.log2(np.maximum(total, 1) / np.maximum(count, 1) / 1.4)), 0, 14).astype(np.int64)
    near = np.clip(mean + np.array([[-1], [0], [1]]), 0, 14)
    bits = np.stack([np.bincount(own, code >> k[own], 4 * len(x)) + (k + 1) * count for k in near])
    k = near[bits.argmin(0), np.arange(4 * len(x))]
    rice = k[own]
    width = np.where(valid & ~same[:, None], np.int32(8), np.int32(0))
    warm = np.flatnonzero(width.ravel() * (column < order[:, None]).ravel())
    width.ravel()[at_coded] = (code >> rice) + 1 + rice
    width[same, 0] = 8
    warm = np.concatenate([warm, np.flatnonzero(same) * BLOCK])
    rows = np.flatnonzero(~same)
    split = rows[parts[rows] == 4]
    p = np.concatenate([rows * BLOCK + order[rows], *(split * BLOCK + j * size[split] for j in (1, 2, 3))])
    extra = np.zeros(x.shape, np.int32)
    extra.ravel()[p] = 4
    extra[rows, order[rows]] += 6 + np.where(kind[rows] == 3, 9 + PRECISION * ORDER, 0)
    heads = [frame_header(a, b) for a, b in zip(number.tolist(), length.tolist())]
    head = np.fromiter(map(len, heads), np.int64, len(heads))
    ends = np.cumsum(width + extra, 1)
    bytes_of = head + 1 + (ends[:, -1] + 7 >> 3) + 2
    frame_at = np.cumsum(bytes_of) - bytes_of
    words = np.zeros(int(bytes_of.sum()) + 7 >> 3, np.uint64)
    at = (frame_at + head + 1)[:, None] * 8 + ends - width
    put_bits(words, at.ravel()[warm], x.ravel()[warm] & 255, 8)
    put_bits(words, at.ravel()[at_coded] + (code >> rice), code & (1 << rice) - 1 | 1 << rice, rice + 1)
    put_bits(words, at.ravel()[p] - 4, k[cell.ravel()[p]], 4)
    lead = at[rows, order[rows]] - extra[rows, order[rows]]
    lpc = kind[rows] == 3
    r, b = rows[lpc], lead[lpc]
    put_bits(words, b, np.full(len(r), PRECISION - 1), 4)
    put_bits(words, b + 4, np.full(len(r), SHIFT), 5)
    for j in range(ORDER):
        put_bits(words, b + 9 + j * PRECISION, fitted[r, j].astype(np.int64) & (1 << PRECISION) - 1, PRECISION)
    put_bits(words, lead + np.where(lpc, 9 + PRECISION * ORDER, 0) + 2, np.where(parts[rows] == 4, 2, 0), 4)
    out = words.astype(">u8").view(np.uint8)[: int(bytes_of.sum())]
    type_byte = np.where(same, 0, np.where(kind == 3, 0x40 | (ORDER - 1) << 1, (8 | order) << 1)).astype(np.uint8)
    out[frame_at + head] = type_byte
    most = int(head.max())
    padded = np.frombuffer(b"".join(h.ljust(most, b"\0") for h in heads), np.uint8).reshape(len(heads), most)
    inside = np.arange(most) < head[:, None]
    out[(frame_at[:, None] + np.arange(most))[inside]] = padded[inside]
    crc = crc16(out, frame_at, frame_at + bytes_of - 2)
    out[frame_at + bytes_of - 2], out[frame_at + bytes_of - 1] = crc >> 8, crc & 255
    return out, bytes_of


def encode(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A stream for each payload of 8-bit samples; a payload's byte b is the sample b - 128. Payloads are not empty."""
    sizes = np.diff(offsets)
    frames = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(sizes)), frames)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(frames) - frames, frames)
    start = offsets[doc] + number * BLOCK
    length = np.minimum(BLOCK, offsets[doc + 1] - start)
    step = FRAMES["encode"]
    coded = [encode_frames(flat, number[a : a + step], start[a : a + step], length[a : a + step]) for a in range(0, len(doc), step)]
    out, bytes_of = (np.concatenate([c[i] for c in coded]) if coded else np.zeros(0, np.int64) for i in (0, 1))
    frame_at = np.cumsum(bytes_of) - bytes_of
    signed = flat ^ 0x80
    streams, first = [], np.cumsum(frames) - frames
    for d in range(len(sizes)):
        a, b = int(first[d]), int(first[d] + frames[d])
        low, high = int(bytes_of[a:b].min()), int(bytes_of[a:b].max())
        info = BLOCK.to_bytes(2, "big") * 2 + low.to_bytes(3, "big") + high.to_bytes(3, "big")
        info += (8000 << 44 | 7 << 36 | int(sizes[d])).to_bytes(8, "big") + hashlib.md5(signed[offsets[d] : offsets[d + 1]].tobytes()).digest()
        points = np.zeros((b - a, 18), np.uint8)
        points[:, :8] = (number[a:b] * BLOCK).astype(">u8").view(np.uint8).reshape(-1, 8)
        points[:, 8:16] = (frame_at[a:b] - frame_at[a]).astype(">u8").view(np.uint8).reshape(-1, 8)
        points[:, 16:] = length[a:b].astype(">u2").view(np.uint8).reshape(-1, 2)
        end = int(frame_at[b - 1] + bytes_of[b - 1])
        streams.append(b"fLaC\x00" + (34).to_bytes(3, "big") + info + b"\x83" + (18 * (b - a)).to_bytes(3, "big") + points.tobytes() + out[int(frame_at[a]) : end].tobytes())
    return streams


class Bits:
    """Big-endian bit reading at many positions of one buffer."""

    def __init__(self, flat: np.ndarray):
        self.padded = np.concatenate([flat, np.zeros(16, np.uint8)])
        self.words = np.ndarray((len(flat) + 8,), ">u8", self.padded, 0, (1,))

    def window(self, at: np.ndarray) -> np.ndarray:
        """At least 57 bits from each bit position, at the top."""
        return self.words[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64)

    def take(self, at: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        """Unsigned values of at most 32 bits, of width 0 also."""
        width = np.asarray(width, np.uint64)
        return (self.window(at) >> np.uint64(32) >> (np.uint64(32) - width)).astype(np.int64)

    def signed(self, at: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        v, width = self.take(at, width), np.asarray(width, np.int64)
        return np.where((width > 0) & (v >> np.maximum(width - 1, 0) & 1 == 1), v - (1 << width), v)

    def unary(self, at: np.ndarray) -> np.ndarray:
        """Number of zeros before the next one."""
        top = self.window(at) >> np.uint64(11)
        n = 53 - np.frexp(top.astype(float))[1].astype(np.int64)
        none = np.flatnonzero(top == 0)
        if len(none):
            n[none] = 53 + self.unary(at[none] + 53)
        return n


def utf8_length(first: int) -> int:
    return 1 if first < 128 else 8 - (255 - first).bit_length()


def read_header(data: bytes, at: int) -> tuple[int, int, int]:
    """(sample count, header bytes, channel assignment) of the frame at ``at``, whose checksum is verified."""
    if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
        raise ValueError("no frame starts here")
    code, rate = data[at + 2] >> 4, data[at + 2] & 15
    p = at + 4 + utf8_length(data[at + 4])
    if code == 6:
        size, p = data[p] + 1, p + 1
    elif code == 7:
        size, p = int.from_bytes(data[p : p + 2], "big") + 1, p + 2
    else:
        size = 192 if code == 1 else 576 << code - 2 if code < 6 else 256 << code - 8
    p += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[at:p]) != data[p]:
        raise ValueError("a frame header's checksum is wrong")
    return size, p + 1 - at, data[at + 3] >> 4


def decode_frames(flat: np.ndarray, start: np.ndarray, size: np.ndarray, head: np.ndarray, depth: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(samples: frame, channel, time; end bytes) of frames, channel by channel, stepping through all of them together.

    ``kind`` is the channel assignment: channels less one, or 8 to 10 for a left, right or middle channel with a side one.
    """
    if (kind > 10).any():
        raise ValueError("unknown channel assignment")
    bits, at = Bits(flat), (start + head) * 8
    channels = np.where(kind < 8, kind + 1, 2)
    out = np.zeros((len(start), int(channels.max()), int(size.max())), np.int32)
    for c in range(out.shape[1]):
        on = np.flatnonzero(channels > c)
        side = (kind[on] == 9) if c == 0 else (kind[on] == 8) | (kind[on] == 10)
        x, at[on] = decode_subframes(bits, at[on], size[on], depth[on] + side)
        out[on, c, : x.shape[1]] = x
    for k in (8, 9, 10):
        on = np.flatnonzero(kind == k)
        a, b = out[on, 0], out[on, 1] if out.shape[1] > 1 else out[on, 0]
        if k == 8 and len(on):
            out[on, 1] = a - b
        elif k == 9 and len(on):
            out[on, 0] = a + b
        elif len(on):
            middle = a << 1 | b & 1
            out[on, 0], out[on, 1] = (middle + b) >> 1, (middle - b) >> 1
    return out, (at + 7 >> 3) + 2


def decode_subframes(bits: Bits, at: np.ndarray, size: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(samples: one row a subframe, end bits) of subframes that begin at the bits ``at``."""
    n, most = len(at), int(size.max())
    out, stop = np.zeros((n, most), np.int32), np.zeros(n, np.int64)
    kinds = bits.take(at, 8)
    if (kinds & 0x80).any():
        raise ValueError("no subframe starts here")
    kind, body, waste = kinds >> 1, at + 8, np.zeros(n, np.int64)
    wasted = np.flatnonzero(kinds & 1)
    if len(wasted):
        waste[wasted] = bits.unary(body[wasted]) + 1
        body = body + waste
        depth = depth - waste
    for f in np.flatnonzero(kind == 0):
        out[f, : size[f]] = bits.signed(body[f : f + 1], depth[f])[0]
        stop[f] = body[f] + depth[f]
    for f in np.flatnonzero(kind == 1):
        out[f, : size[f]] = bits.signed(body[f] + np.arange(size[f]) * depth[f], depth[f])
        stop[f] = body[f] + size[f] * depth[f]
    # The others go from the longest to the shortest, so that those with a sample i are always the first ones.
    sel = np.flatnonzero(kind >= 8)
    sel = sel[np.argsort(-size[sel], kind="stable")]
    size, depth, at, kind = size[sel], depth[sel], body[sel], kind[sel]
    lpc = kind >= 32
    order = np.where(lpc, kind - 31, kind - 8)
    deep = int(order.max()) if len(sel) else 0
    x = np.zeros((most + deep, len(sel)), np.int64)  # the first ``deep`` rows are zeros before the first sample
    coef = np.zeros((deep, len(sel)), np.int64)
    for o in range(1, 5):
        same = kind == 8 + o
        if same.any():
            coef[:o, same] = np.array(FIXED[o])[:, None]
    shift, k = np.zeros(len(sel), np.int64), np.zeros(len(sel), np.int64)
    raw, param = np.zeros(len(sel), bool), np.full(len(sel), 4)
    live = np.searchsorted(-size, -np.arange(most), "left").tolist()
    opens: dict[int, list[int]] = {}

    def parameter(f: np.ndarray) -> None:
        k[f] = bits.take(at[f], param[f])
        at[f] += param[f]
        raw[f] = k[f] == (1 << param[f]) - 1
        r = f[raw[f]]
        k[r] = bits.take(at[r], 5)
        at[r] += 5

    for i in range(most):
        m = live[i]
        if not m:
            break
        f = np.arange(m)
        if i <= deep:
            w = f[order[:m] > i]
            x[deep + i, w] = bits.signed(at[w], depth[w])
            at[w] += depth[w]
            first = f[order[:m] == i]
            if len(first):
                q = first[lpc[first]]
                precision = bits.take(at[q], 4) + 1
                shift[q] = bits.signed(at[q] + 4, 5)
                at[q] += 9
                for j in range(int(order[q].max()) if len(q) else 0):
                    on = order[q] > j
                    coef[j, q[on]] = bits.signed(at[q[on]], precision[on])
                    at[q[on]] += precision[on]
                param[first] = 4 + bits.take(at[first], 2)
                parts = 1 << bits.take(at[first] + 2, 4)
                at[first] += 6
                parameter(first)
                for c, s, p, o in zip(first.tolist(), size[first].tolist(), parts.tolist(), order[first].tolist()):
                    for j in range(1, p):
                        opens.setdefault(max(j * (s // p), o), []).append(c)
        if i in opens:
            again = opens.pop(i)
            parameter(np.array(again))
        on = slice(0, m) if i >= deep else f[order[:m] <= i]
        own, rice = at[on], k[on]
        window = bits.window(own)
        top = window >> np.uint64(11)
        if top.all():
            zeros = 53 - np.frexp(top.astype(float))[1].astype(np.int64)
        else:
            zeros = bits.unary(own)
        used = zeros + 1 + rice
        if len(used) and used.max() <= 57:
            low = (window << (zeros + 1).astype(np.uint64) >> np.uint64(32) >> (32 - rice).astype(np.uint64)).astype(np.int64)
        else:
            low = bits.take(own + zeros + 1, rice)
        u = zeros << rice | low
        value = u >> 1 ^ -(u & 1)
        rough = raw[on]
        if rough.any():
            value = np.where(rough, bits.signed(own, np.where(rough, rice, 0)), value)
            used = np.where(rough, rice, used)
        at[on] = own + used
        if deep:
            ahead = coef[0, on] * x[deep + i - 1, on]
            for j in range(1, deep):
                ahead += coef[j, on] * x[deep + i - 1 - j, on]
            value += ahead >> shift[on]
        x[deep + i, on] = value
    out[sel] = x[deep:].T
    stop[sel] = at
    return out << waste[:, None].astype(np.int32), stop


def parse_stream(data: bytes) -> dict:
    """STREAMINFO and seek table of a stream, and where its frames begin."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, info, seek = 4, False, b"", []
    while not last:
        last, kind, n = bool(data[at] & 0x80), data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + n]
        at += 4 + n
        if kind == 0:
            info = body
        elif kind == 3:
            table = np.frombuffer(body, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("size", ">u2")]))
            seek = table[table["sample"] != 0xFFFFFFFFFFFFFFFF]
    packed = int.from_bytes(info[10:18], "big")
    return {"block": int.from_bytes(info[2:4], "big"), "channels": (packed >> 41 & 7) + 1, "depth": (packed >> 36 & 31) + 1, "samples": packed & (1 << 36) - 1, "md5": info[18:34], "seek": seek, "at": at}


def decode(streams: list[bytes]) -> list[tuple[np.ndarray, list[tuple[int, int]]]]:
    """For each stream its samples (a row a sample where there are several channels) and its blocks (sample offset, sample count).

    Every checksum is verified. Streams whose seek table names every frame decode all frames at once; others go frame
    by frame, all streams together.
    """
    flat = np.frombuffer(b"".join(streams), np.uint8)
    base = np.cumsum([0, *map(len, streams)])
    infos = [parse_stream(s) for s in streams]
    out = [(np.zeros((i["samples"], i["channels"]), np.int32), []) for i in infos]
    todo: list[tuple[int, int, int]] = []  # stream, first sample, byte
    for d, i in enumerate(infos):
        whole = len(i["seek"]) and int(i["seek"]["size"].sum()) == i["samples"]
        todo += [(d, int(s["sample"]), i["at"] + int(s["offset"])) for s in i["seek"]] if whole else [(d, 0, i["at"])] * (i["samples"] > 0)
        i["whole"] = bool(whole)
    while todo:
        group, todo = todo[: FRAMES["decode"]], todo[FRAMES["decode"] :]
        heads = [read_header(streams[d], at) for d, _, at in group]
        size, head, kind = (np.array([h[c] for h in heads]) for c in range(3))
        start = np.array([base[d] + at for d, _, at in group])
        depth = np.array([infos[d]["depth"] for d, _, _ in group])
        x, stop = decode_frames(flat, start, size, head, depth, kind)
        crc = crc16(flat, start, stop - 2)
        if (crc != flat[stop - 2].astype(np.uint32) * 256 + flat[stop - 1]).any():
            raise ValueError("a frame's checksum is wrong")
        for f, (d, sample, at) in enumerate(group):
            out[d][0][sample : sample + size[f]] = x[f, : infos[d]["channels"], : size[f]].T
            out[d][1].append((sample, int(size[f])))
            if not infos[d]["whole"] and sample + size[f] < infos[d]["samples"]:
                todo.append((d, int(sample + size[f]), int(stop[f] - base[d])))
    for (x, _), i in zip(out, infos):
        wide = (i["depth"] + 7) // 8
        raw = x.astype(np.int8).tobytes() if wide == 1 else x.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :wide].tobytes()
        if i["md5"] != bytes(16) and hashlib.md5(raw).digest() != i["md5"]:
            raise ValueError("the samples' checksum is wrong")
    return [(x[:, 0] if x.shape[1] == 1 else x, blocks) for x, blocks in out]


def decoded(streams: list[bytes]) -> list[tuple[np.ndarray, list[tuple[int, int]], str]]:
    """``decode`` with "ok" for each stream, or no samples and what is wrong with a damaged one, which spoils no other."""
    try:
        return [(x, blocks, "ok") for x, blocks in decode(streams)]
    except (ValueError, IndexError, OverflowError, RecursionError, MemoryError) as e:
        if len(streams) == 1:
            return [(np.zeros(0, np.int32), [], f"damaged: {e}")]
        return [decoded([s])[0] for s in streams]


def feature(samples: np.ndarray) -> str:
    """Length, peak, energy, zero crossings and a hash of the coarse loudness curve, all from whole numbers."""
    samples = samples.astype(np.int64)
    peak, energy = int(np.abs(samples).max(initial=0)), int((samples * samples).sum())
    crossings = int(((samples[1:] >= 0) != (samples[:-1] >= 0)).sum())
    curve = np.abs(samples.reshape(-1, 64)).sum(1) if len(samples) % 64 == 0 else np.abs(samples)
    return f"n={len(samples)};peak={peak};energy={energy};zero={crossings};curve={zlib.crc32(curve.astype('<i8').tobytes()):08x}"


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media, the document's text as a FLAC stream.

    The text's UTF-8 bytes (a null text has none) get zero bytes up to a positive multiple of 64 and become 8-bit
    samples. Null doc_ids and repeated rows stay; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", ENCODED):
                flat, off = joined_bytes(part.column("text"))
                sizes = np.diff(off)
                padded = np.maximum(64, -(-sizes // 64) * 64)
                ends = np.concatenate([[0], np.cumsum(padded)])
                payload = np.zeros(int(ends[-1]), np.uint8)
                payload[np.repeat(ends[:-1] - off[:-1], sizes) + np.arange(len(flat))] = flat
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "media": pa.array(encode(payload, ends), pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """doc_id, block, sample_offset, n_samples, pcm, status of the streams in ``media``.

    ``pcm`` has the samples as bytes, channels interleaved, little-endian beyond 8 bits. A damaged stream has one row
    without a block whose status says what is wrong, sound ones have "ok"; null streams give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "media", DECODED):
                rows = {k: [] for k in ("doc_id", "block", "sample_offset", "n_samples", "pcm", "status")}
                streams = part.column("media").to_pylist()
                for doc, stream, (x, blocks, status) in zip(part.column("doc_id").to_pylist(), streams, decoded(streams)):
                    depth = parse_stream(stream)["depth"] if blocks else 8
                    kind = "<i1" if depth <= 8 else "<i2" if depth <= 16 else "<i4"
                    for b, (at, n) in enumerate(sorted(blocks)):
                        for key, v in zip(rows, (doc, b, at, n, x[at : at + n].astype(kind).tobytes(), status)):
                            rows[key].append(v)
                    if status != "ok":
                        for key, v in zip(rows, (doc, None, None, None, None, status)):
                            rows[key].append(v)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.string()))})

    return media.select("doc_id", "media").where("media is not null").mapInArrow(run, "doc_id long, block int, sample_offset long, n_samples int, pcm binary, status string")


def media_digests(media: DataFrame) -> DataFrame:
    """What is read back from the stored mono streams of 8 bits: lengths, hashes, a feature string of the decoded samples, and a status.

    A damaged stream has its length, its hash and a status that says what is wrong, sound ones have "ok"; null streams
    give no rows, an empty table neither.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "media", DECODED):
                streams = part.column("media").to_pylist()
                found = decoded(streams)
                back = [(x + 128).astype(np.uint8).tobytes() if status == "ok" else None for x, _, status in found]
                each = lambda f: [None if b is None else f(b) for b in back]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    "n_bytes": part.column("n_bytes"),
                    "payload_bytes": pa.array(each(len), pa.int64()),
                    "payload_sha256": pa.array(each(lambda b: hashlib.sha256(b).hexdigest()), pa.string()),
                    "tail_crc32": pa.array(each(lambda b: zlib.crc32(b[-64:])), pa.int64()),
                    "media_bytes": pa.array(map(len, streams), pa.int64()),
                    "media_sha256": pa.array([hashlib.sha256(s).hexdigest() for s in streams]),
                    "feature": pa.array([feature(x) if status == "ok" else None for x, _, status in found], pa.string()),
                    "status": pa.array([status for _, _, status in found]),
                })

    return media.where("media is not null").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, status string")
