"""Media columns: progressive JPEG.

``decode`` reads progressive JPEG files in numpy: every scan (spectral selection and successive approximation) is
accumulated into one coefficient array, which is then dequantised, inverse-transformed, its chroma upsampled and turned
into full-resolution RGB tensors. ``encode_payload`` stores bytes losslessly in the same format: the unit of the format is
the quantised coefficient, so each 64 bytes become one 8x8 block (quantiser 1), dealt over Y, Cb and Cr planes at 4:2:0.

Entropy-coded data is sequential only within a restart interval. The decoder runs over all intervals of all images
of a batch in step, one numpy operation for each symbol position, and the encoder puts a restart marker after each
block. Files without restart markers decode too, with one lane for each scan.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from perilframe.llm.common import mapped, pieces, whole_text


def _zigzag() -> np.ndarray:
    """Natural index of each zigzag position."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


ZIGZAG = _zigzag()
#: Bits of fixed point in the inverse transform: sums of whole numbers below 2**53 are exact in any order.
IDCT_BITS = 12


def _idct_matrix() -> np.ndarray:
    """64 coefficients in zigzag order to 64 samples, as whole numbers scaled by 2**IDCT_BITS."""
    x, u = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    one = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(0.5), 1) / 2
    both = np.einsum("yv,xu->vuyx", one, one).reshape(64, 64)
    return np.rint(both[ZIGZAG] * (1 << IDCT_BITS))


IDCT = _idct_matrix()

# ---------------------------------------------------------------------------------------------------------------- encode

#: Coefficient of each payload byte. Its size is 2 or more, so that every coefficient is non-zero from the first scan on.
COEF_OF_BYTE = np.where(np.arange(256) >= 96, np.arange(256) - 94, np.arange(256) - 97).astype(np.int16)
BYTE_OF_COEF = {int(c): b for b, c in enumerate(COEF_OF_BYTE)}
#: Scans as (components, first and last spectral index, high and low bit of successive approximation).
SCRIPT = [((0, 1, 2), 0, 0, 0, 1), ((0,), 1, 5, 0, 1), ((1,), 1, 63, 0, 1), ((2,), 1, 63, 0, 1), ((0,), 6, 63, 0, 1), ((0, 1, 2), 0, 0, 1, 0), ((1,), 1, 63, 1, 0), ((2,), 1, 63, 1, 0), ((0,), 1, 63, 1, 0)]
#: Every code has 4 bits: DC sizes 0 to 11; AC end of block, then sizes 1 to 9 after no zeros.
DC_SYMBOLS, AC_SYMBOLS = bytes(range(12)), bytes(range(10))


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each value: the size's 4-bit code, then the magnitude bits."""
    size = np.frexp(np.abs(values).astype(np.float64))[1]
    return (size << size) | np.where(values < 0, values + (1 << size) - 1, values), 4 + size


def _segments(bits: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of codes as bytes, each row filled up with ones; and the number of bytes of each row."""
    n, k = bits.shape
    if k % 4:
        bits, lens = (np.pad(x, ((0, 0), (0, -k % 4))) for x in (bits, lens))
    lens = lens.astype(np.int64).reshape(n, -1, 4)
    bits = bits.astype(np.uint64).reshape(n, -1, 4)
    joined = bits[:, :, 0]
    for j in range(1, 4):
        joined = (joined << lens[:, :, j].astype(np.uint64)) | bits[:, :, j]
    total = lens.sum(2)
    ends = np.cumsum(total, 1)
    used = ends[:, -1] if ends.size else np.zeros(n, np.int64)
    size = (used + 7) // 8
    first = np.cumsum(size) - size
    at = (ends - total + first[:, None] * 8).ravel()
    window = (joined.ravel() << (np.uint64(56) - (at & 7).astype(np.uint64) - total.ravel().astype(np.uint64))).astype(">u8").view(np.uint8).reshape(-1, 8)
    out = np.zeros(int(size.sum()) + 8, np.uint8)
    low = at >> 3
    keep = total.ravel() > 0
    low, window = low[keep], window[keep]
    for j in range(7):  # neighbours share a byte: those of even and of odd place are put down apart
        np.bitwise_or.at(out, low + j, window[:, j + 1])
    last = first + size - 1
    fill = (size * 8 - used).astype(np.int64)
    out[last[size > 0]] |= ((1 << fill[size > 0]) - 1).astype(np.uint8)
    return out[: int(size.sum())], size


def _marked(data: np.ndarray, size: np.ndarray, owner: np.ndarray, n_owners: int) -> list[bytes]:
    """Entropy-coded segments with stuffed zeros and restart markers, joined for each owner (an image)."""
    first = np.cumsum(size) - size
    seg = np.repeat(np.arange(len(size)), size)
    ff = data == 255
    stuffed = np.cumsum(ff)
    pos = np.arange(len(data)) + stuffed - ff + 2 * seg
    start = pos[first] if len(size) else np.zeros(0, np.int64)
    total = len(data) + int(ff.sum()) + 2 * len(size)
    out = np.zeros(total, np.uint8)
    out[pos] = data
    end = np.append(start[1:], total)
    count = np.bincount(owner, minlength=n_owners)
    place = np.arange(len(size)) - np.repeat(np.cumsum(count) - count, count)
    out[end - 2], out[end - 1] = 255, 0xD0 + place % 8
    cuts = np.append(start, total)[np.append(0, np.cumsum(count))]
    raw = out.tobytes()
    return [raw[a : max(a, b - 2)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]  # no marker after the last


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


def _table(cls: int, symbols: bytes) -> bytes:
    return bytes([cls << 4, 0, 0, 0, len(symbols)] + [0] * 12) + symbols


def encode_payload(payloads: list[bytes]) -> list[bytes]:
    """Progressive JPEG files that hold the payloads (each a positive multiple of 64 bytes) as coefficients."""
    n_blocks = np.array([len(p) // 64 for p in payloads])
    mcus = -(-n_blocks // 6)
    cols = np.maximum(np.minimum(mcus, 64), -(-mcus // 4095))
    rows = -(-mcus // cols)
    mcus = rows * cols
    data = np.frombuffer(b"".join(p + bytes(int(m) * 384 - len(p)) for p, m in zip(payloads, mcus)), np.uint8).reshape(-1, 64)
    base = (np.cumsum(mcus) - mcus) * 6
    full = np.arange(len(data)) - np.repeat(base, mcus * 6) < np.repeat(n_blocks, mcus * 6)
    owner = {c: np.repeat(np.arange(len(payloads)), mcus * (4 if c == 0 else 1)) for c in range(3)}
    index = {c: np.concatenate([np.arange(m * (4 if c == 0 else 1)) + b + (0, 4 * m, 5 * m)[c] for b, m in zip(base.tolist(), mcus.tolist())]) for c in range(3)}
    grid = np.concatenate([_mcu_order(int(r), int(c)) + b for b, r, c in zip(base.tolist(), rows.tolist(), cols.tolist())])
    head = [
        b"\xff\xd8" + _segment(0xFE, struct.pack(">Q", len(p))) + _segment(0xDB, bytes([0]) + b"\1" * 64)
        + _segment(0xC2, struct.pack(">BHHB", 8, int(r) * 16, int(c) * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        + _segment(0xDD, b"\0\1") + _segment(0xC4, _table(0, DC_SYMBOLS) + _table(1, AC_SYMBOLS))
        for p, r, c in zip(payloads, rows, cols)
    ]
    out = [[h] for h in head]
    bits_of, lens_of = _coded(np.sign(COEF_OF_BYTE) * (np.abs(COEF_OF_BYTE) >> 1))
    bits_of, lens_of = bits_of.astype(np.uint16), lens_of.astype(np.uint8)
    low_of = (np.abs(COEF_OF_BYTE) & 1).astype(np.uint8)
    dc = np.where(full, COEF_OF_BYTE[data[:, 0]], 0).astype(np.int64)[grid].reshape(-1, 6)
    by_mcu = np.repeat(np.arange(len(payloads)), mcus)
    for comps, ss, se, ah, al in SCRIPT:
        if ss == 0 and ah == 0:
            half = dc >> 1
            coded = _segments(*_coded(np.concatenate([half[:, :1], np.diff(half[:, :4]), half[:, 4:]], 1)))
            who = by_mcu
        elif ss == 0:
            ones = np.ones((len(dc), 8), np.uint8)
            ones[:, :6] = dc & 1
            coded, who = (np.packbits(ones), np.ones(len(dc), np.int64)), by_mcu
        else:
            own = index[comps[0]]
            block, there, who = data[own, ss : se + 1], full[own][:, None], owner[comps[0]]
            if ah == 0:
                bits, lens = bits_of[block] * there, lens_of[block] * there
                lens[:, 0] = np.where(there[:, 0], lens[:, 0], 4)  # an empty block: end of block
                coded = _segments(bits, lens)
            else:  # all coefficients are there: end of block, then a correction bit for each
                wide = np.ones((len(own), 72), np.uint8)
                wide[:, :4] = 0
                wide[:, 4 : 5 + se - ss] = low_of[block] | ~there
                size = np.where(there[:, 0], (4 + se - ss + 8) // 8, 1)
                raw = np.packbits(wide, axis=1)
                coded = raw[np.arange(9) < size[:, None]], size
        for parts, body in zip(out, _marked(*coded, who, len(payloads))):
            parts.append(_segment(0xDA, bytes([len(comps)]) + b"".join(bytes([c + 1, 0]) for c in comps) + bytes([ss, se, ah << 4 | al])))
            parts.append(body)
    return [b"".join(parts) + b"\xff\xd9" for parts in out]


def _mcu_order(rows: int, cols: int) -> np.ndarray:
    """Blocks of a 4:2:0 image, stored plane by plane, in the order of its interleaved scans."""
    y = np.arange(rows * cols * 4).reshape(rows, 2, cols, 2).transpose(0, 2, 1, 3).reshape(-1, 4)
    c = np.arange(rows * cols)[:, None]
    return np.concatenate([y, c + rows * cols * 4, c + rows * cols * 5], 1).ravel()


# ---------------------------------------------------------------------------------------------------------------- decode


@lru_cache(256)
def _huffman(counts: bytes, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each 16 bits that can come next: the symbol and the length of its code (0: no such code)."""
    sym, length, code, k = np.zeros(65536, np.uint8), np.zeros(65536, np.uint8), 0, 0
    for n, c in enumerate(counts, 1):
        for _ in range(c):
            sym[code << (16 - n) : (code + 1) << (16 - n)] = symbols[k]
            length[code << (16 - n) : (code + 1) << (16 - n)] = n
            code, k = code + 1, k + 1
        code <<= 1
    return sym, length


@lru_cache(256)
def _lookup(counts: bytes, symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 16 bits: the symbol, the bits that it takes with its magnitude, and the value, if all fit in 16 bits (else
    the length is 0)."""
    sym, length = _huffman(counts, symbols)
    size = (sym & 15).astype(np.int64)
    total = length + size
    mag = (np.arange(65536) >> np.maximum(16 - total, 0)) & ((1 << size) - 1)
    value = np.where(mag < (1 << size) >> 1, mag - (1 << size) + 1, mag)
    total[(total > 16) | (length == 0)] = 0
    return sym, total.astype(np.int64), np.where(size > 0, value, 0).astype(np.int32)


class _Bits:
    """Bits of many lanes; ``at`` is the bit position of each."""

    def __init__(self, data: np.ndarray, start: np.ndarray):
        d = np.concatenate([data, np.full(16, 255, np.uint8)]).astype(np.uint32)
        self.data = d.astype(np.uint8)
        self.window = (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]
        self.at = start.astype(np.int64) * 8

    def peek(self, lanes, n: int = 16) -> np.ndarray:
        """The next ``n`` (at most 24) bits."""
        at = self.at[lanes]
        return (self.window[np.minimum(at >> 3, len(self.window) - 1)] >> (32 - n - (at & 7)).astype(np.uint32)).astype(np.int64) & ((1 << n) - 1)

    def take(self, lanes, n: np.ndarray) -> np.ndarray:
        got = self.peek(lanes) >> (16 - n)
        self.at[lanes] += n
        return got

    def bits(self, at: np.ndarray) -> np.ndarray:
        return (self.data[np.minimum(at >> 3, len(self.data) - 1)] >> (7 - (at & 7)).astype(np.uint8)) & 1


def _dc_scan(coef, bits, blocks, lens, comp, tables, ah, al):
    """blocks: rows of ``coef`` lane after lane; lens: how many each lane has; comp: the component's place, as blocks."""
    first = np.cumsum(lens) - lens
    if ah:
        lane = np.repeat(np.arange(len(lens)), lens)
        coef[blocks, 0] |= bits.bits(bits.at[lane] + np.arange(len(blocks)) - first[lane]).astype(np.int32) << al
        return
    pred = np.zeros((len(lens), comp.max() + 1), np.int64)
    for j in range(int(lens.max(initial=0))):
        lanes = np.nonzero(lens > j)[0]
        at = first[lanes] + j
        which = comp[at]
        for c in np.unique(which):
            own = lanes[which == c]
            sym, length = tables[c]
            peek = bits.peek(own)
            size = sym[peek].astype(np.int64)
            bits.at[own] += length[peek]
            mag = bits.take(own, size)
            pred[own, c] += np.where(size == 0, 0, np.where(mag < (1 << size) >> 1, mag - (1 << size) + 1, mag))
            coef[blocks[first[own] + j], 0] = pred[own, c] << al


def _ac_first(coef, bits, blocks, lens, lookup, ss, se, al):
    sym, total, value = lookup
    first = np.cumsum(lens) - lens
    flat, row = coef.reshape(-1), blocks * 64
    done, k, run = np.zeros(len(lens), np.int64), np.full(len(lens), ss), np.zeros(len(lens), np.int64)
    lanes = np.nonzero(lens > 0)[0]
    while len(lanes):
        peek = bits.peek(lanes)
        s = sym[peek]
        n = total[peek]
        size, zeros = s & 15, (s >> 4).astype(np.int64)
        v = value[peek]
        if (long := n == 0).any():  # code and magnitude over 16 bits
            own = lanes[long]
            length = _code_length(lookup, peek[long])
            bits.at[own] += length
            z = size[long].astype(np.int64)
            mag = bits.take(own, z)
            v = v.copy()
            v[long] = np.where(mag < (1 << z) >> 1, mag - (1 << z) + 1, mag)
        bits.at[lanes] += n
        at = k[lanes] + zeros
        hit = size > 0
        cell = row[first[lanes] + done[lanes]] + at
        if hit.all():
            flat[cell] = v << al
        else:
            flat[cell[hit]] = v[hit] << al
            end = ~hit & (zeros < 15)
            own = lanes[end]
            run[own] = (1 << zeros[end]) - 1 + bits.take(own, zeros[end])
            at[end] = se
        at += 1
        k[lanes] = at
        if (over := at > se).any():
            own = lanes[over]
            done[own] += 1 + run[own]
            run[own], k[own] = 0, ss
            lanes = lanes[~over | (done[lanes] < lens[lanes])]


def _code_length(lookup, peek):
    return _LENGTHS[id(lookup[0])][peek].astype(np.int64)


def _ac_refine(coef, bits, blocks, lens, table, ss, se, al):
    sym, length = table
    first = np.cumsum(lens) - lens
    done, k, run = np.zeros(len(lens), np.int64), np.full(len(lens), ss), np.zeros(len(lens), np.int64)
    lanes = np.nonzero(lens > 0)[0]
    unit = 1 << al
    span = np.arange(ss, se + 1)

    def rest(own):
        """The blocks' remaining known coefficients take a correction bit each."""
        rows = blocks[first[own] + done[own]]
        part = coef[rows, ss : se + 1]
        known = part != 0
        if (k[own] > ss).any():
            known &= span >= k[own][:, None]
        rank = np.cumsum(known, 1)
        bit = bits.bits(bits.at[own][:, None] + rank - 1)
        bits.at[own] += rank[:, -1]
        coef[rows, ss : se + 1] = part + np.where(known & (bit == 1), np.sign(part) * unit, 0)
        done[own] += 1
        k[own] = ss

    while len(lanes):
        inside = run[lanes] > 0
        if inside.any():
            own = lanes[inside]
            rest(own)
            run[own] -= 1
        fresh = lanes[~inside]
        if len(fresh):
            peek = bits.peek(fresh)
            s = sym[peek]
            bits.at[fresh] += length[peek]
            zeros, size = (s >> 4).astype(np.int64), s & 15
            end = (size == 0) & (zeros < 15)
            own = fresh[end]
            run[own] = (1 << zeros[end]) - 1 + bits.take(own, zeros[end])
            if len(own):
                rest(own)
            own, left, new = fresh[~end], zeros[~end], np.zeros(int((~end).sum()), np.int64)
            has = size[~end] > 0
            if has.any():
                new[has] = np.where(bits.take(own[has], np.ones(int(has.sum()), np.int64)) == 1, unit, -unit)
            while len(own):  # step over known coefficients and the given number of zeros, then place the new one
                rows = blocks[first[own] + done[own]]
                cur = coef[rows, k[own]]
                known = cur != 0
                if known.any():
                    bit = bits.take(own[known], np.ones(int(known.sum()), np.int64))
                    coef[rows[known], k[own[known]]] = cur[known] + np.where(bit == 1, np.sign(cur[known]) * unit, 0)
                place = ~known & (left == 0)
                coef[rows[place], k[own[place]]] = new[place]
                left = left - (~known & (left > 0))
                k[own] += 1
                over = k[own] > se
                done[own[over]] += 1
                k[own[over]] = ss
                keep = ~place & ~over
                own, left, new = own[keep], left[keep], new[keep]
        lanes = lanes[done[lanes] < lens[lanes]]


_LENGTHS: dict[int, np.ndarray] = {}


def _segments_of(raw: bytes, marks: list[int]):
    """(kind, position, size, end of the entropy-coded data behind it) of the segments of a file, in order.

    From segment to segment by their lengths, so that nothing in a body (comment, thumbnail, profile) counts as a marker;
    only behind a scan's header does the next of ``marks``, positions of two bytes that can be a marker, end the data.
    """
    at = 2
    while at + 4 <= len(raw):
        if raw[at] != 255:
            raise ValueError("a marker is missing")
        kind = raw[at + 1]
        if kind == 0xD9:
            return
        if kind == 255 or kind == 0x01:  # a fill byte, or a marker without a body
            at += 1 if kind == 255 else 2
            continue
        size = int.from_bytes(raw[at + 2 : at + 4], "big")
        end = at + 2 + size
        if kind == 0xDA:
            i = bisect_left(marks, end)
            end = marks[i] if i < len(marks) else len(raw)
        yield kind, at, size, end
        at = end


def _parse(raw: bytes, marks: list[int]) -> dict:
    """Frame, tables and scans of one file. marks: as in ``_segments_of``."""
    image, dri, quant, huff, scans = {"comment": b""}, 0, {}, {}, []
    if raw[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    for kind, at, size, end in _segments_of(raw, marks):
        body = raw[at + 4 : at + 2 + size]
        if kind == 0xDB:
            while body:
                n = 128 if body[0] >> 4 else 64
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if n == 128 else np.uint8).astype(np.float64)
                body = body[1 + n :]
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                huff[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif kind == 0xC2:
            image["h"], image["w"] = struct.unpack(">HH", body[1:5])
            image["comps"] = tuple((body[6 + 3 * j], body[7 + 3 * j] >> 4, body[7 + 3 * j] & 15, body[8 + 3 * j]) for j in range(body[5]))
        elif 0xC0 <= kind <= 0xCF and kind != 0xC8:
            raise ValueError("only progressive Huffman-coded files (SOF2) are read")
        elif kind == 0xDD:
            dri = int.from_bytes(body, "big")
        elif kind == 0xFE:
            image["comment"] = body
        elif kind == 0xDA:
            n = body[0]
            order = [next(j for j, c in enumerate(image["comps"]) if c[0] == body[1 + 2 * x]) for x in range(n)]
            last = body[1 + 2 * n :]
            used = tuple((huff.get(body[2 + 2 * x] >> 4), huff.get(16 | body[2 + 2 * x] & 15)) for x in range(n))
            scans.append((tuple(order), used, last[0], last[1], last[2] >> 4, last[2] & 15, dri, at + 2 + size, end))
    hmax, vmax = max(c[1] for c in image["comps"]), max(c[2] for c in image["comps"])
    mx, my = -(-image["w"] // (8 * hmax)), -(-image["h"] // (8 * vmax))
    image["grid"] = tuple((my * v, mx * h, -(-(-(-image["h"] * v // vmax)) // 8), -(-(-(-image["w"] * h // hmax)) // 8)) for _, h, v, _ in image["comps"])
    return image | {"scans": scans, "quant": quant, "max": (hmax, vmax), "mcus": (my, mx)}


@lru_cache(4096)
def _scan_order(mcus: tuple, comps: tuple, grid: tuple, order: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the image's coefficients in the order of a scan, and the place of each one's component in it."""
    base = np.cumsum([0] + [a * b for a, b, _, _ in grid])
    if len(order) == 1:
        rows, cols, h, w = grid[order[0]]
        return base[order[0]] + (np.arange(h)[:, None] * cols + np.arange(w)).ravel(), np.zeros(h * w, np.int64)
    my, mx = mcus
    parts, places = [], []
    for x, j in enumerate(order):
        _, h, v, _ = comps[j]
        parts.append(base[j] + np.arange(my * v * mx * h).reshape(my, v, mx, h).transpose(0, 2, 1, 3).reshape(my * mx, -1))
        places.append(np.full((my * mx, h * v), x))
    return np.concatenate(parts, 1).ravel(), np.concatenate(places, 1).ravel()


def coefficients(files: list[bytes]) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """The parsed images, one array (blocks, 64) of coefficients in zigzag order, and each image's first row in it."""
    raw = b"".join(files) + b"\0\0"
    data = np.frombuffer(raw, np.uint8)
    ff = np.nonzero(data[:-1] == 255)[0]
    after = data[ff + 1]
    restart = (after >= 0xD0) & (after <= 0xD7)
    marks, rst, stuffed = ff[(after != 0) & (after != 255) & ~restart], ff[restart], ff[after == 0] + 1
    ends = np.cumsum([len(f) for f in files])
    cut = np.searchsorted(marks, ends).tolist()
    images, base, n = [], [], 0
    for i, f in enumerate(files):
        off = int(ends[i]) - len(f)
        images.append(_parse(f, (marks[cut[i - 1] if i else 0 : cut[i]] - off).tolist()))
        base.append(n)
        n += sum(a * b for a, b, _, _ in images[-1]["grid"])
    coef = np.zeros((n, 64), np.int32)
    keep = np.ones(len(data), bool)
    keep[stuffed] = False
    kept = np.cumsum(keep) - keep  # place of each byte once stuffed zeros are gone
    plain = data[keep]
    for step in range(max((len(x["scans"]) for x in images), default=0)):
        groups: dict = {}
        for i, x in enumerate(images):
            if step < len(x["scans"]):
                s = x["scans"][step]
                groups.setdefault(s[1:6] + (len(s[0]) > 1,), []).append(i)
        for (used, ss, se, ah, al, _), own in groups.items():
            blocks, places, full = [], [], []
            for i in own:
                x = images[i]
                order, dri = x["scans"][step][0], x["scans"][step][6]
                rows, place = _scan_order(x["mcus"], x["comps"], x["grid"], order)
                per = sum(x["comps"][j][1] * x["comps"][j][2] for j in order) if len(order) > 1 else 1
                blocks.append(rows + base[i])
                if ss == 0:
                    places.append(place)
                full.append(dri * per or len(rows))
            n_rows, full = np.array([len(r) for r in blocks]), np.array(full)
            count = -(-n_rows // full)
            off = (ends - [len(f) for f in files])[own]
            begin = off + [images[i]["scans"][step][7] for i in own]
            low = np.searchsorted(rst, begin)
            if (np.searchsorted(rst, off + [images[i]["scans"][step][8] for i in own]) - low < count - 1).any():
                raise ValueError("restart markers are missing")
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            marker = rst[np.minimum(np.repeat(low, count) + np.maximum(nth - 1, 0), len(rst) - 1)] + 2 if len(rst) else 0
            starts = np.where(nth == 0, np.repeat(begin, count), marker)
            lens = np.repeat(full, count)
            lens[np.cumsum(count) - 1] = n_rows - full * (count - 1)
            rows, place = np.concatenate(blocks), np.concatenate(places) if places else None
            bits = _Bits(plain, kept[starts])
            if ss == 0:
                _dc_scan(coef, bits, rows, lens, place, [t[0] and _huffman(*t[0]) for t in used], ah, al)
            elif ah == 0:
                look = _lookup(*used[0][1])
                _LENGTHS[id(look[0])] = _huffman(*used[0][1])[1]
                _ac_first(coef, bits, rows, lens, look, ss, se, al)
            else:
                _ac_refine(coef, bits, rows, lens, _huffman(*used[0][1]), ss, se, al)
    return images, coef, np.array(base, np.int64)


def tensors(images: list[dict], coef: np.ndarray, base: np.ndarray):
    """RGB (or grey, one channel) tensors of 8-bit samples at full resolution, one for each image."""
    scaled = coef.astype(np.float64)
    for x, first in zip(images, base.tolist()):
        for (rows, cols, _, _), (*_, q) in zip(x["grid"], x["comps"]):
            if (x["quant"][q] != 1).any():
                scaled[first : first + rows * cols] *= x["quant"][q]
            first += rows * cols
    sums = scaled @ IDCT
    sums += 128 * (1 << IDCT_BITS) + (1 << (IDCT_BITS - 1))
    sums *= 1 / (1 << IDCT_BITS)  # a power of two: exact
    np.floor(sums, out=sums)
    np.clip(sums, 0, 255, out=sums)
    samples = sums.astype(np.int32)
    for x, first in zip(images, base.tolist()):
        planes = []
        for (rows, cols, _, _), (_, h, v, _) in zip(x["grid"], x["comps"]):
            plane = samples[first : first + rows * cols].reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
            first += rows * cols
            hmax, vmax = x["max"]
            if (hmax, vmax) != (h, v):
                plane = plane.repeat(vmax // v, 0).repeat(hmax // h, 1)
            planes.append(plane[: x["h"], : x["w"]])
        if len(planes) < 3:
            yield planes[0][:, :, None].astype(np.uint8)
            continue
        y, cb, cr = planes[0] * 65536 + 32768, planes[1] - 128, planes[2] - 128
        rgb = np.stack([y + 91881 * cr, y - 22554 * cb - 46802 * cr, y + 116130 * cb], 2) >> 16
        yield np.clip(rgb, 0, 255).astype(np.uint8)


def decode(files: list[bytes]) -> list[np.ndarray]:
    """RGB tensors (height, width, 3) of progressive JPEG files."""
    return list(tensors(*coefficients(files))) if files else []


_BYTE_TABLE = np.zeros(512, np.uint8)
_BYTE_TABLE[COEF_OF_BYTE.astype(int) + 256] = np.arange(256)


def payload_and_feature(files: list[bytes]):
    """For each file of ``encode_payload``: the payload, its RGB tensor, and a feature of that (size, CRC-32, channel means)."""
    images, coef, base = coefficients(files)
    bytes_of = _BYTE_TABLE[coef + 256]
    for x, first, rgb in zip(images, base.tolist(), tensors(images, coef, base)):
        size = struct.unpack(">Q", x["comment"])[0]
        means = ".".join(str(int(s)) for s in rgb.sum((0, 1), dtype=np.int64) // (rgb.shape[0] * rgb.shape[1]))
        yield bytes_of[first : first + size // 64].tobytes(), rgb, f"{rgb.shape[0]}x{rgb.shape[1]}x3:{zlib.crc32(rgb.tobytes()):08x}:{means}"


# ----------------------------------------------------------------------------------------------------------- DataFrames

RGB_SCHEMA = "height int, width int, channels int, rgb binary"


def with_rgb(df: DataFrame, media: str = "media") -> DataFrame:
    """Adds the full-resolution tensor of each progressive JPEG in binary column ``media``, as ``RGB_SCHEMA``.

    Null or unreadable media get null tensors. Columns of ``df`` with the new names are replaced.
    """
    new = ["height", "width", "channels", "rgb"]
    kept = df.drop(*new)

    def run(batches):
        for batch in batches:
            out = []
            for m in batch.column(batch.schema.get_field_index(media)).to_pylist():
                try:
                    t = decode([m])[0] if m else None
                except (ValueError, IndexError, KeyError, StopIteration, struct.error):
                    t = None
                out.append((*t.shape, t.tobytes()) if t is not None else (None,) * 4)
            cols = [pa.array([o[i] for o in out], pa.int32()) for i in range(3)] + [pa.array([o[3] for o in out], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *new])

    return mapped(kept, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", " + RGB_SCHEMA)


STORED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, " + RGB_SCHEMA


def stored_texts(docs: DataFrame, piece_chars: int = 1_500_000) -> DataFrame:
    """Stores every whole text as a progressive JPEG, reads the file back, describes both and stores the full-resolution
    tensor that the file decodes to (columns as in ``STORED``).

    A null text counts as empty and gives one block of zeros; equal texts give equal files. Repeated rows stay.
    Work is one narrow pass: no shuffle, and memory bounded by ``piece_chars`` characters or one text.
    """

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in pieces(texts, piece_chars):
                raw = [t.encode() for t in texts[a:b]]
                files = encode_payload([r + bytes(-len(r) % 64 if r else 64) for r in raw])
                rows = []
                for i, r, f, (back, rgb, feature) in zip(ids[a:b], raw, files, payload_and_feature(files)):
                    rows.append((i, len(r), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(f), hashlib.sha256(f).hexdigest(), feature, *rgb.shape, rgb.tobytes()))
                kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int32()] * 3, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in STORED.split(", ")])

    return mapped(docs.select("doc_id", whole_text().alias("text")), run, STORED)
