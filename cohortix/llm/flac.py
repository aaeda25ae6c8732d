"""Media columns: lossless FLAC streams of 8-bit mono samples, with a seek point for every frame.

The encoder writes frames of BLOCK samples with fixed linear predictors of order 0 to 2 and one Rice
partition, all frames of many rows at once in numpy.  Such streams are decoded in the same way: the seek table gives where
each frame starts, so the decoder steps
through the samples of all frames in parallel.  Any other stream goes through a decoder of the whole format, frame by frame: constant, verbatim,
fixed and quantized linear predictors, both Rice codes with partitions and escapes, wasted bits, any block size, 4 to 32 bits and joint stereo.  Both check the CRC-8 of every
frame header, the CRC-16 of every frame and the MD5 of the samples.  What is decoded comes as PCM blocks, each with its sample offset.

Edge cases: null text is an empty text, whose payload is one block of spaces; very
long texts have as many frames as they need (the frame number takes up to six
bytes, and seek points stand further apart where they would not fit the table); equal texts give equal streams; repeated rows give equal rows; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_as_text, id_restored

BLOCK = 192
PAD = b" "
RATE = 8000
HIGHEST_ORDER = 2
#: Payload bytes that are encoded or decoded together.
CHUNK = 1 << 20
#: Seek points of a stream at most: the table's length has 24 bits.
MOST_POINTS = 900_000
#: Frames of a PCM block.
PCM_FRAMES = 64


def crc_table(polynomial: int, bits: int) -> np.ndarray:
    out = []
    for byte in range(256):
        value = byte << (bits - 8)
        for _ in range(8):
            value = (value << 1) ^ (polynomial if value >> (bits - 1) & 1 else 0)
            value &= (1 << bits) - 1
        out.append(value)
    return np.array(out, np.uint32)


def crc_of_frames(data: np.ndarray, start: np.ndarray, length: np.ndarray, bits: int) -> np.ndarray:
    """CRC-8 (polynomial 0x07) or CRC-16 (0x8005) of many byte ranges, a byte of each at a time."""
    table = crc_table(0x07 if bits == 8 else 0x8005, bits)
    order = np.argsort(-length, kind="stable")
    at, n = start[order], length[order]
    crc = np.zeros(len(at), np.uint32)
    for step in range(int(n[0]) if len(n) else 0):
        live = int(np.searchsorted(-n, -step, "left"))  # ranges longer than step come first
        here = data[at[:live] + step]
        if bits == 8:
            crc[:live] = table[crc[:live] ^ here]
        else:
            c = crc[:live]
            crc[:live] = ((c << 8) & 0xFF00) ^ table[(c >> 8) ^ here]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def coded_number(n: int) -> bytes:
    """A frame number in the format's extension of UTF-8 (up to 31 bits here)."""
    if n < 0x80:
        return bytes([n])
    size = 2
    while n >> (5 * size + 1):
        size += 1
    out = [0x80 | (n >> (6 * i)) & 0x3F for i in range(size - 1)][::-1]
    return bytes([(0xFF << (8 - size)) & 0xFF | n >> (6 * (size - 1)), *out])


def encode_frames(samples: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all frames, start of each and the end of the last) for rows of BLOCK signed samples."""
    m = len(samples)
    residuals = [samples.astype(np.int16)]
    for _ in range(HIGHEST_ORDER):
        residuals.append(np.diff(residuals[-1], axis=1))
    order = np.argmin(np.stack([np.abs(r).sum(axis=1, dtype=np.int32) for r in residuals]), axis=0)
    u = np.zeros((m, BLOCK), np.int16)
    for o, r in enumerate(residuals):
        rows = np.flatnonzero(order == o)
        u[rows, o:] = (r[rows] << 1) ^ (r[rows] >> 15)
    mean = u.sum(axis=1, dtype=np.int32) / (BLOCK - order)
    k = np.clip(np.floor(np.log2(np.maximum(mean * 0.69, 1.0))), 0, 14).astype(np.int16)
    q = u >> k[:, None]
    bits = (q + 1 + k[:, None]).astype(np.int32)
    for o in range(HIGHEST_ORDER):
        bits[order > o, o] = 0  # warm-up samples have no code
    coded = [coded_number(int(n)) for n in numbers]
    head = np.array([5 + len(c) for c in coded], np.int64)  # bytes up to the subframe, CRC-8 included
    ends = np.cumsum(bits, axis=1)
    body = 18 + 8 * order.astype(np.int64) + ends[:, -1]
    size = head + (body + 7) // 8 + 2
    edge = np.r_[0, np.cumsum(size)]
    rice = edge[:-1] + head
    first = rice * 8 + 18 + 8 * order
    # a code's zeros need no writing; its 1 and its k low bits are one word, placed in the 24 bits from the byte it begins in
    stop = first[:, None] + (ends - bits) + q
    word = ((1 << k[:, None].astype(np.int32)) | (u & ((1 << k[:, None].astype(np.int32)) - 1))) << (23 - k[:, None] - (stop & 7).astype(np.int32))
    for o in range(HIGHEST_ORDER):
        word[order > o, o] = 0
    # no two words share a bit, so sums of words are exact
    sums = np.bincount((stop >> 3).reshape(-1), word.reshape(-1), int(edge[-1]) + 2).astype(np.int64)
    out = ((sums >> 16) + np.r_[0, (sums[:-1] >> 8) & 255] + np.r_[0, 0, sums[:-2] & 255])[: int(edge[-1])].astype(np.uint8)
    out[rice + 1 + order] = k >> 2  # method 00, partition order 0000 and the Rice parameter follow the warm-up samples
    out[rice + 2 + order] |= ((k & 3) << 6).astype(np.uint8)
    begin = edge[:-1]
    out[begin], out[begin + 1] = 0xFF, 0xF8
    out[begin + 2], out[begin + 3] = 0x14, 0x02  # 192 samples at 8 kHz; mono, 8 bits
    for i, c in enumerate(coded):
        out[begin[i] + 4 : begin[i] + 4 + len(c)] = np.frombuffer(c, np.uint8)
    out[rice] = (0b001000 | order) << 1
    for o in range(HIGHEST_ORDER):
        rows = np.flatnonzero(order > o)
        out[rice[rows] + 1 + o] = samples[rows, o].astype(np.int8).view(np.uint8)
    out[rice - 1] = crc_of_frames(out, begin, head - 1, 8)
    crc = crc_of_frames(out, begin, size - 2, 16)
    out[edge[1:] - 2], out[edge[1:] - 1] = crc >> 8, crc & 0xFF
    return out, edge


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A complete stream for each payload, whose length is a positive multiple of BLOCK."""
    frames = [len(p) // BLOCK for p in payloads]
    samples = (np.frombuffer(b"".join(payloads), np.uint8) ^ 0x80).view(np.int8).reshape(-1, BLOCK)
    numbers = np.concatenate([np.arange(n) for n in frames]) if frames else np.zeros(0, int)
    data, edge = encode_frames(samples, numbers)
    out, low = [], 0
    for p, n in zip(payloads, frames, strict=True):
        at = edge[low : low + n + 1]
        sizes = np.diff(at)
        md5 = hashlib.md5(samples[low : low + n].tobytes()).digest()
        info = struct.pack(">HH", BLOCK, BLOCK) + int(sizes.min()).to_bytes(3, "big") + int(sizes.max()).to_bytes(3, "big")
        info += ((RATE << 44) | (0 << 41) | (7 << 36) | len(p)).to_bytes(8, "big") + md5
        marked = np.arange(0, n, -(-n // MOST_POINTS))
        points = np.zeros(len(marked), POINT)
        points["sample"], points["offset"], points["n"] = marked * BLOCK, at[marked] - at[0], BLOCK
        table = points.tobytes()
        out.append(b"fLaC" + struct.pack(">I", len(info)) + info + struct.pack(">I", (0x83 << 24) | len(table)) + table + data[at[0] : at[-1]].tobytes())
        low += n
    return out


POINT = [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]


class OtherKind(ValueError):
    """A stream that the parallel decoder does not take."""


class Head(NamedTuple):
    md5: bytes
    total: int
    points: np.ndarray
    first: int
    bits: int
    channels: int
    blocks: tuple[int, int]


def parse(stream: bytes) -> Head:
    """What the metadata say, and the start of the first frame."""
    if stream[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, info, points = 4, False, None, np.zeros(0, POINT)
    while not last:
        word = int.from_bytes(stream[at : at + 4], "big")
        last, kind, size = bool(word >> 31), word >> 24 & 0x7F, word & 0xFFFFFF
        block = stream[at + 4 : at + 4 + size]
        if len(block) < size or at + 4 > len(stream):
            raise ValueError("metadata end early")
        if kind == 0:
            packed = int.from_bytes(block[10:18], "big")
            info = (block[18:34], packed & ((1 << 36) - 1), (packed >> 36 & 31) + 1, (packed >> 41 & 7) + 1, struct.unpack(">HH", block[:4]))
        elif kind == 3:
            points = np.frombuffer(block, POINT)
            points = points[points["sample"] != 0xFFFFFFFFFFFFFFFF]
        at += 4 + size
    if info is None:
        raise ValueError("no stream information")
    return Head(info[0], info[1], points, at, *info[2:])


def frame_starts(head: Head, data: np.ndarray, low: int, end: int, number: int, count: int) -> np.ndarray:
    """Starts of count frames of this encoder's kind from data[low], the first of them with this number: from the seek table, or where that is sparse by the headers' marks, numbers and CRC-8."""
    if (head.bits, head.channels, head.blocks) != (8, 1, (BLOCK, BLOCK)) or head.total % BLOCK or not len(head.points):
        raise OtherKind("stream of another kind")
    if len(head.points) * BLOCK == head.total:
        return head.points["offset"][number : number + count].astype(np.int64) + low - int(head.points["offset"][number])
    part, out = data[low:end], []
    marks = np.flatnonzero((part[:-3] == 0xFF) & (part[1:-2] == 0xF8) & (part[2:-1] == 0x14) & (part[3:] == 0x02)) if len(part) > 3 else []
    for at in marks:
        coded = coded_number(number + len(out))
        size = 4 + len(coded)
        if part[at + 4 : at + size].tobytes() == coded and at + size < len(part) and crc8(part[at : at + size].tobytes()) == part[at + size]:
            out.append(low + int(at))
            if len(out) == count:
                return np.array(out, np.int64)
    raise OtherKind("frames not found")


def decode_frames(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows of BLOCK signed samples of frames at [start, end) in data, after checking both checksums of each."""
    m = len(start)
    head = data[start[:, None] + np.arange(4)[None, :]]
    if not (head == np.array([0xFF, 0xF8, 0x14, 0x02], np.uint8)).all():
        raise OtherKind("frame header is damaged or of another kind")
    lead = data[start + 4].astype(np.int32)
    extra = np.where(lead < 0x80, 1, 8 - np.floor(np.log2(np.maximum(255 - lead, 1) + 0.5)).astype(np.int32) - 1)
    body = start + 5 + extra
    if not (crc_of_frames(data, start, body - 1 - start, 8) == data[body - 1]).all():
        raise ValueError("CRC-8 of a frame header differs")
    if not (crc_of_frames(data, start, end - start - 2, 16) == (data[end - 2].astype(np.uint32) << 8 | data[end - 1])).all():
        raise ValueError("CRC-16 of a frame differs")
    order = (data[body] >> 1).astype(np.int32) - 0b001000
    if m and not ((order >= 0) & (order <= 4) & (data[body] & 1 == 0)).all():
        raise OtherKind("other predictors")
    padded = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint32)
    window = padded[:-4] << 24 | padded[1:-3] << 16 | padded[2:-2] << 8 | padded[3:-1]  # 32 bits from each byte
    zeros = np.full(1 << 16, 16, np.int64)  # leading zeros of 16 bits
    for bit in range(16):
        zeros[1 << bit : 1 << (bit + 1)] = 15 - bit

    def peek(at: np.ndarray) -> np.ndarray:
        return (window[at >> 3] << (at & 7).astype(np.uint32)) >> 8  # 24 valid bits

    r = np.zeros((m, BLOCK), np.int32)
    for o in np.unique(order):
        rows = np.flatnonzero(order == o)
        for j in range(o):
            r[rows, j] = data[body[rows] + 1 + j].view(np.int8)
        at = (body[rows] + 1 + o) * 8
        intro = peek(at) >> 14  # method (2 bits), partition order (4), Rice parameter (4)
        if (intro >> 4).any():
            raise OtherKind("more Rice partitions")
        k = (intro & 15).astype(np.int64)
        if (k == 15).any():
            raise OtherKind("escaped residuals")
        at = at + 10
        for j in range(int(o), BLOCK):
            q = zeros[peek(at) >> 8]
            long = np.flatnonzero(q == 16)
            while len(long):  # more than 16 zeros: go on from there
                more = zeros[peek(at[long] + q[long]) >> 8]
                q[long] += more
                long = long[more == 16]
            at += q + 1
            low = (peek(at) >> (24 - k).astype(np.uint32)).astype(np.int64)
            u = q << k | low
            at += k
            r[rows, j] = (u >> 1) ^ -(u & 1)
        x = r[rows]
        for level in range(int(o), 0, -1):  # undo one difference at a time; the warm-up samples give each sum its start
            tail = np.cumsum(np.c_[initial_last(x[:, :o], level), x[:, o:]], axis=1, dtype=np.int32)[:, 1:]
            x = np.c_[x[:, :o], tail]
        r[rows] = x
    return r


def initial_last(warm: np.ndarray, level: int) -> np.ndarray:
    """The last (level - 1)-th difference of the warm-up samples."""
    return np.diff(warm, n=level - 1, axis=1)[:, -1:]


def decode_streams(streams: list[bytes]) -> list[bytes]:
    """The payload of each stream of 8-bit mono samples, after all checksums have been verified."""
    try:
        return decode_together(streams)
    except OtherKind:
        return [payload_from(*decode_any(s)) for s in streams]


def decode_together(streams: list[bytes]) -> list[bytes]:
    heads = [parse(s) for s in streams]
    base = np.cumsum([0, *map(len, streams)])
    data = np.frombuffer(b"".join(streams), np.uint8)
    starts = [frame_starts(h, data, int(base[i]) + h.first, int(base[i + 1]), 0, h.total // BLOCK) for i, h in enumerate(heads)]
    ends = [np.r_[s[1:], base[i + 1]] for i, s in enumerate(starts)]
    samples = decode_frames(data, np.concatenate(starts), np.concatenate(ends))
    out, low = [], 0
    for h, own_starts in zip(heads, starts, strict=True):
        own = samples[low : low + len(own_starts)].astype(np.int8).reshape(-1)
        if len(own) != h.total or hashlib.md5(own.tobytes()).digest() != h.md5:
            raise ValueError("decoded samples differ from the stream's MD5")
        out.append((own.view(np.uint8) ^ 0x80).tobytes())
        low += len(own_starts)
    return out


def decode_range(stream: bytes, sample: int, count: int) -> bytes:
    """Payload bytes [sample, sample + count), decoding only from the seek point before them."""
    head = parse(stream)
    count = min(count, head.total - sample)
    if count <= 0:
        return b""
    data = np.frombuffer(stream, np.uint8)
    low, high = sample // BLOCK, -(-(sample + count) // BLOCK)
    try:
        at = max(0, int(np.searchsorted(head.points["sample"].astype(np.int64), sample, "right")) - 1)
        number = int(head.points["sample"][at]) // BLOCK if len(head.points) else 0
        begin = head.first + (int(head.points["offset"][at]) if len(head.points) else 0)
        more = high < head.total // BLOCK
        starts = frame_starts(head, data, begin, len(data), number, high - number + more)
        ends = np.r_[starts[1:], len(stream)][: high - number]
        samples = decode_frames(data, starts[low - number : high - number], ends[low - number :])
        payload = (samples.astype(np.int8).reshape(-1).view(np.uint8) ^ 0x80).tobytes()
        return payload[sample - low * BLOCK :][:count]
    except OtherKind:
        return payload_from(*decode_any(stream))[sample : sample + count]


def payload_from(samples: np.ndarray, bits: int) -> bytes:
    if bits != 8 or samples.shape[1] != 1:
        raise ValueError("8-bit mono samples only")
    return (samples[:, 0].astype(np.int8).view(np.uint8) ^ 0x80).tobytes()


# The whole format, one frame after the other


class Bits:
    """Reader of big-endian bit fields."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def read(self, n: int) -> int:
        first, last = self.at >> 3, (self.at + n + 7) >> 3
        if last > len(self.data):
            raise ValueError("stream ends early")
        value = int.from_bytes(self.data[first:last], "big") >> (last * 8 - self.at - n) & ((1 << n) - 1)
        self.at += n
        return value

    def signed(self, n: int) -> int:
        value = self.read(n)
        return value - (1 << n) if n and value >> (n - 1) else value

    def zeros(self) -> int:
        """Zeros before the next 1, which is read too."""
        n = 0
        while not self.read(1):
            n += 1
        return n


def crc8(data: bytes) -> int:
    value = 0
    for byte in data:
        value = CRC8[value ^ byte]
    return value


def crc16(data: bytes) -> int:
    value = 0
    for byte in data:
        value = ((value << 8) & 0xFF00) ^ CRC16[(value >> 8) ^ byte]
    return value


CRC8, CRC16 = crc_table(0x07, 8).tolist(), crc_table(0x8005, 16).tolist()
# Fixed values of the format: bits of a sample by their code.
SAMPLE_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


def decode_any(stream: bytes) -> tuple[np.ndarray, int]:
    """(samples by channel, bits of a sample) of any stream, after all checksums have been verified."""
    head = parse(stream)
    parts, at = [], head.first
    while at < len(stream):
        samples, at = decode_frame(stream, at, head)
        parts.append(samples)
    out = np.concatenate(parts) if parts else np.zeros((0, head.channels), np.int64)
    if head.total and len(out) != head.total:
        raise ValueError("number of samples differs")
    width = (head.bits + 7) // 8
    plain = out.astype("<i8").reshape(-1).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    if any(head.md5) and hashlib.md5(plain).digest() != head.md5:
        raise ValueError("decoded samples differ from the stream's MD5")
    return out, head.bits


def decode_frame(stream: bytes, at: int, head: Head) -> tuple[np.ndarray, int]:
    """(samples by channel, start of the next frame)."""
    r = Bits(stream, at)
    if r.read(15) != 0x7FFC:
        raise ValueError("frame header is damaged")
    r.read(1)
    size_code, rate_code, layout, bits_code = r.read(4), r.read(4), r.read(4), r.read(3)
    r.read(1)
    lead = r.read(8)
    r.read(8 * (max(1, 8 - (0xFF ^ lead).bit_length()) - 1))  # the rest of the frame's or sample's number
    n = 192 if size_code == 1 else 576 << (size_code - 2) if size_code < 6 else r.read(8 if size_code == 6 else 16) + 1 if size_code < 8 else 256 << (size_code - 8)
    r.read({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
    if crc8(stream[at : r.at >> 3]) != r.read(8):
        raise ValueError("CRC-8 of a frame header differs")
    bits = SAMPLE_BITS.get(bits_code, head.bits)
    channels = layout + 1 if layout < 8 else 2
    wide = {8: 1, 9: 0, 10: 1}.get(layout)  # the channel that holds a difference
    parts = [decode_subframe(r, n, bits + (c == wide)) for c in range(channels)]
    if layout == 8:
        parts[1] = parts[0] - parts[1]
    elif layout == 9:
        parts[0] = parts[0] + parts[1]
    elif layout == 10:
        twice = (parts[0] << 1) | (parts[1] & 1)
        parts = [(twice + parts[1]) >> 1, (twice - parts[1]) >> 1]
    end = (r.at + 7) >> 3
    if crc16(stream[at:end]) != int.from_bytes(stream[end : end + 2], "big") or end + 2 > len(stream):
        raise ValueError("CRC-16 of a frame differs")
    return np.stack(parts, axis=1), end + 2


def decode_subframe(r: Bits, n: int, bits: int) -> np.ndarray:
    if r.read(1):
        raise ValueError("subframe is damaged")
    kind, wasted = r.read(6), r.read(1)
    if wasted:
        wasted += r.zeros()
        bits -= wasted
    if kind == 0:
        out = [r.signed(bits)] * n
    elif kind == 1:
        out = [r.signed(bits) for _ in range(n)]
    elif 8 <= kind <= 12:
        order = kind - 8
        out = [r.signed(bits) for _ in range(order)]
        weights = [(-1) ** j * math.comb(order, j + 1) for j in range(order)]
        extend(out, weights, 0, residuals(r, n, order))
    elif kind >= 32:
        order = kind - 31
        out = [r.signed(bits) for _ in range(order)]
        precision, shift = r.read(4) + 1, r.signed(5)
        if precision == 16 or shift < 0:
            raise ValueError("subframe is damaged")
        weights = [r.signed(precision) for _ in range(order)]
        extend(out, weights, shift, residuals(r, n, order))
    else:
        raise ValueError("subframe of a reserved kind")
    return np.array(out, np.int64) << wasted


def extend(out: list[int], weights: list[int], shift: int, rest: list[int]) -> None:
    """Adds a sample for each residual: the prediction from the last samples, the latest first, and the residual."""
    for x in rest:
        out.append((sum(w * out[-1 - j] for j, w in enumerate(weights)) >> shift) + x)


def residuals(r: Bits, n: int, order: int) -> list[int]:
    method, partitions = r.read(2), 1 << r.read(4)
    if method > 1 or n % partitions or n // partitions < order:
        raise ValueError("residuals are damaged")
    width, out = (4, 5)[method], []
    for p in range(partitions):
        count, k = n // partitions - (order if p == 0 else 0), r.read(width)
        if k == (1 << width) - 1:
            raw = r.read(5)
            out += [r.signed(raw) for _ in range(count)]
            continue
        for _ in range(count):
            u = r.zeros() << k | r.read(k)
            out.append((u >> 1) ^ -(u & 1))
    return out


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, the text as UTF-8 and filled up with spaces to a positive multiple of BLOCK)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + PAD * (-len(raw) % BLOCK if raw else BLOCK)


def chunks(sizes: list[int]) -> Iterator[slice]:
    low, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > CHUNK:
            yield slice(low, i)
            low, total = i, 0
        total += n
    if low < len(sizes):
        yield slice(low, len(sizes))


def to_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): the text of each document as a FLAC stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["text"].str.len().fillna(0).astype(int).tolist()
            for part in chunks(sizes):
                pairs = [payload_of(t) for t in batch["text"].iloc[part]]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[part].values, "n_bytes": [n for n, _ in pairs], "media": encode_streams([p for _, p in pairs])})

    return id_restored(id_as_text(docs.select("doc_id", "text")).mapInPandas(run, "doc_id string, n_bytes long, media binary"), docs)


def features(payload: bytes) -> str:
    """Frames, sum, energy, peak and changes (samples unlike the one before) as a short text of integers."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    changes = int(np.count_nonzero(np.diff(x)))
    return f"frames={len(x) // BLOCK};sum={int(x.sum())};energy={int((x * x).sum())};peak={int(np.abs(x).max())};changes={changes}"


def blocks_of(payload: bytes, frames: int = PCM_FRAMES) -> list[tuple[int, bytes]]:
    """(sample offset, samples) of the PCM blocks of a decoded stream."""
    return [(at, payload[at : at + frames * BLOCK]) for at in range(0, len(payload), frames * BLOCK)]


def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes], list[bytes]]]:
    """(rows, their streams, their payloads), some at a time."""
    for batch in batches:
        for part in chunks([len(s) for s in batch["media"]]):
            rows = batch.iloc[part]
            streams = [bytes(s) for s in rows["media"]]
            yield rows, streams, decode_streams(streams)


def read_media(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_blocks, last_offset) from the stored streams; the last two tell their PCM blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, streams, payloads in decoded(batches):
            blocks = [blocks_of(p) for p in payloads]
            yield pd.DataFrame({
                "doc_id": rows["doc_id"].values, "n_bytes": rows["n_bytes"].values, "payload_bytes": [b[-1][0] + len(b[-1][1]) for b in blocks],
                "payload_sha256": [sha256_of(x for _, x in b) for b in blocks], "tail_crc32": [zlib.crc32(b[-1][1][-16:]) for b in blocks],
                "media_bytes": [len(s) for s in streams], "media_sha256": [hashlib.sha256(s).hexdigest() for s in streams], "feature": [features(p) for p in payloads],
                "n_blocks": [len(b) for b in blocks], "last_offset": [b[-1][0] for b in blocks],
            })

    kind = "doc_id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks long, last_offset long"
    return id_restored(id_as_text(media.select("doc_id", "n_bytes", "media")).mapInPandas(run, kind), media)


def sha256_of(parts) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def pcm_blocks(media: DataFrame, frames: int = PCM_FRAMES) -> DataFrame:
    """(doc_id, block, sample_offset, n_samples, pcm): the decoded samples in blocks of so many frames, each with its offset."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, _, payloads in decoded(batches):
            for doc_id, payload in zip(rows["doc_id"], payloads, strict=True):
                offsets, cut = zip(*blocks_of(payload, frames), strict=True)
                yield pd.DataFrame({"doc_id": [doc_id] * len(cut), "block": range(len(cut)), "sample_offset": offsets, "n_samples": [len(c) for c in cut], "pcm": cut})

    return id_restored(id_as_text(media.select("doc_id", "media")).mapInPandas(run, "doc_id string, block int, sample_offset long, n_samples int, pcm binary"), media)
