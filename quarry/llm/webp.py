"""Lossless WebP (VP8L): a decoder for all of the format, and an encoder for what we store.

The decoder reads prefix codes, back-references, the colour cache and meta prefix codes, and
inverts the predictor, cross-colour, subtract-green and palette transforms. An image with one
group of prefix codes and no colour cache is decoded in numpy: what would be read is worked out
for every bit position at once, the true positions are followed as a chain, and only
back-references are copied one by one. Other images are decoded symbol by symbol.

Images are arrays of uint32 ARGB values, height × width.
"""

from __future__ import annotations

import heapq
import struct
from dataclasses import dataclass, field

import numpy as np

# Fixed values of the format: the order of code length codes, and the pixels near by (x, y) that the first distance codes mean.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS_COLOR, SUBTRACT_GREEN, PALETTE = range(4)
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
CACHE_FACTOR = 0x1E35A7BD
#: The longest distance that the distance codes reach; those of NEAR come first.
FARTHEST = (1 << DISTANCES // 2) - len(NEAR)
_REVERSED: dict[int, np.ndarray] = {}


class WebPError(ValueError):
    pass


def reversal(bits: int) -> np.ndarray:
    """Each number below 2 ** bits with its bits in reverse."""
    if bits not in _REVERSED:
        r = np.zeros(1, dtype=np.int64)
        for _ in range(bits):
            r = np.concatenate([r * 2, r * 2 + 1])
        _REVERSED[bits] = r
    return _REVERSED[bits]


class Bits:
    """Reads bits, least significant first."""

    def __init__(self, data: bytes):
        self.data, self.at, self.end = bytes(data) + bytes(16), 0, 8 * len(data)

    def peek(self, n: int) -> int:
        k = self.at >> 3
        return (int.from_bytes(self.data[k : k + 5], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        v = self.peek(n)
        self.at += n
        if self.at > self.end:
            raise WebPError("the data end early")
        return v


class PrefixCode:
    """Symbols and lengths by the next bits."""

    def __init__(self, symbols: list[int], lengths: list[int]):
        if not symbols:
            raise WebPError("an empty prefix code")
        if len(symbols) == 1:
            self.bits, self.symbol, self.length = 0, np.array(symbols), np.array([0])
        else:
            order = sorted(range(len(symbols)), key=lambda i: (lengths[i], symbols[i]))
            size = np.array([lengths[i] for i in order])
            self.bits = int(size[-1])
            share = 1 << (self.bits - size)
            if share.sum() != 1 << self.bits:
                raise WebPError("a prefix code that is not complete")
            back = reversal(self.bits)
            self.symbol = np.repeat(np.array([symbols[i] for i in order]), share)[back]
            self.length = np.repeat(size, share)[back]
        self.most = max(symbols)

    def read(self, bits: Bits) -> int:
        k = bits.peek(self.bits) if self.bits else 0
        bits.at += int(self.length[k])
        if bits.at > bits.end:
            raise WebPError("the data end early")
        return int(self.symbol[k])


def read_prefix_code(bits: Bits, alphabet: int) -> PrefixCode:
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = [bits.read(8 if wide else 1)]
        if two:
            symbols.append(bits.read(8))
        if max(symbols) >= alphabet:
            raise WebPError("a symbol out of range")
        symbols = sorted(set(symbols))
        return PrefixCode(symbols, [1] * len(symbols))
    lens = [0] * 19
    for i in range(4 + bits.read(4)):
        lens[CODE_LENGTH_ORDER[i]] = bits.read(3)
    used = [i for i in range(19) if lens[i]]
    code = PrefixCode(used, [lens[i] for i in used])
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    symbols, lengths, at, previous = [], [], 0, 8
    table, size, width = code.symbol.tolist(), code.length.tolist(), code.bits
    while at < alphabet and left:
        left -= 1
        k = bits.peek(width + 7)
        head = k & ((1 << width) - 1)
        s, n = table[head], size[head]
        if s < 16:
            if s:
                symbols.append(at)
                lengths.append(s)
                previous = s
            at += 1
        elif s == 16:
            times = 3 + ((k >> n) & 3)
            n += 2
            symbols.extend(range(at, at + times))
            lengths.extend([previous] * times)
            at += times
        elif s == 17:
            at += 3 + ((k >> n) & 7)
            n += 3
        else:
            at += 11 + ((k >> n) & 127)
            n += 7
        bits.at += n
    if at > alphabet or bits.at > bits.end:
        raise WebPError("code lengths out of range")
    return PrefixCode(symbols, lengths)


def _value(code: int, bits: Bits) -> int:
    if code < 4:
        return code + 1
    extra = (code - 2) >> 1
    return ((2 + (code & 1)) << extra) + bits.read(extra) + 1


def _distance(code: int, width: int) -> int:
    if code > len(NEAR):
        return code - len(NEAR)
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


def _up(a: int, b: int) -> int:
    return -(-a // (1 << b))


def read_image(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded image, as a flat array."""
    cache = bits.read(4) if bits.read(1) else 0
    if cache > 11:
        raise WebPError("a colour cache out of range")
    meta, shift, groups = None, 0, 1
    if main and bits.read(1):
        shift = bits.read(3) + 2
        meta = (read_image(bits, _up(width, shift), _up(height, shift), False) >> 8) & 0xFFFF
        groups = int(meta.max()) + 1
    codes = [[read_prefix_code(bits, n) for n in (LITERALS + LENGTHS + (1 << cache if cache else 0), 256, 256, 256, DISTANCES)] for _ in range(groups)]
    if groups == 1 and not cache:
        return _read_fast(bits, codes[0], width, width * height)
    return _read_plain(bits, codes, width, width * height, cache, meta, shift)


def _read_plain(bits: Bits, codes: list[list[PrefixCode]], width: int, total: int, cache: int, meta: np.ndarray | None, shift: int) -> np.ndarray:
    out, at = [0] * total, 0
    kept, done = [0] * (1 << cache), 0
    across = _up(width, shift) if meta is not None else 0
    while at < total:
        group = codes[int(meta[(at // width >> shift) * across + (at % width >> shift)])] if meta is not None else codes[0]
        s = group[0].read(bits)
        if s < LITERALS:
            r, b, a = (group[i].read(bits) for i in (1, 2, 3))
            out[at] = a << 24 | r << 16 | s << 8 | b
            at += 1
        elif s < LITERALS + LENGTHS:
            n = _value(s - LITERALS, bits)
            d = _distance(_value(group[4].read(bits), bits), width)
            if d > at or at + n > total:
                raise WebPError("a back-reference out of range")
            for i in range(at, at + n):
                out[i] = out[i - d]
            at += n
        else:
            while done < at:
                kept[((CACHE_FACTOR * out[done]) & 0xFFFFFFFF) >> (32 - cache)] = out[done]
                done += 1
            out[at] = kept[s - LITERALS - LENGTHS]
            at += 1
    return np.array(out, dtype=np.uint32)


def _read_fast(bits: Bits, codes: list[PrefixCode], width: int, total: int) -> np.ndarray:
    green, red, blue, alpha, far = codes
    fixed = [c for c in codes[:4] if c.bits]
    if not fixed:
        return np.full(total, int(alpha.symbol[0]) << 24 | int(red.symbol[0]) << 16 | int(green.symbol[0]) << 8 | int(blue.symbol[0]), dtype=np.uint32)
    first = bits.at >> 3
    room = (total * 8 * sum(c.bits for c in codes) >> 6) + (total * 36 >> 3 if green.most >= LITERALS else 0) + 16
    raw = np.frombuffer(bits.data, dtype=np.uint8)[first : first + room + 8].astype(np.uint32)
    word = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    window = (word.astype(np.int64)[:, None] >> np.arange(8)).ravel()
    n = len(window)
    places = np.arange(n)
    look = window & ((1 << green.bits) - 1)
    after = [places, places + green.length.take(look) if green.bits else places]
    for c in (red, blue, alpha):
        after.append(after[-1] + c.length.take(window & ((1 << c.bits) - 1)).take(after[-1], mode="clip") if c.bits else after[-1])
    jump = after[4]
    copies = green.most >= LITERALS
    if copies:
        sym = green.symbol.take(look)
        p = np.flatnonzero(sym >= LITERALS)
        length, q = _values(window, sym[p] - LITERALS, np.minimum(after[1][p], n - 1), n)
        k = window[q] & ((1 << far.bits) - 1)
        back, q = _values(window, far.symbol[k], np.minimum(q + far.length[k], n - 1), n)
        jump = jump.copy()
        jump[p] = q
    # The chain of places is followed four steps at a time.
    two = jump.take(jump, mode="clip")
    four = two.take(two, mode="clip")
    at, chain, end = bits.at - 8 * first, [], min(bits.end - 8 * first, n)
    add, follow = chain.append, memoryview(four)
    for _ in range(-(-total // 4)):
        if at >= end:
            break
        add(at)
        at = follow[at]
    here = np.array(chain, dtype=np.int64)
    here = np.stack([here, jump[here], two[here], jump.take(two[here], mode="clip")], axis=1).ravel()[:total]
    if not copies:
        if len(here) < total or jump.take(here[-1], mode="clip") > end:
            raise WebPError("the data end early")
        at = int(jump[here[-1]])
    else:
        size = np.ones(len(here), dtype=np.int64)
        slot = np.searchsorted(p, here)
        slot[slot == len(p)] = 0
        copy = p[slot] == here if len(p) else np.zeros(len(here), dtype=bool)
        size[copy] = length[slot[copy]]
        stop = int(np.searchsorted(np.cumsum(size), total)) + 1
        here, size, slot, copy = here[:stop], size[:stop], slot[:stop], copy[:stop]
        if size.sum() != total or here[-1] >= end or jump[here[-1]] > end:
            raise WebPError("the pixels don't fill the image")
        at = int(jump[here[-1]])
    bits.at = 8 * first + at

    def symbols(c: PrefixCode, where: np.ndarray) -> np.ndarray:
        if not c.bits:
            return np.uint32(c.symbol[0])
        return c.symbol.take(window.take(where, mode="clip") & ((1 << c.bits) - 1)).astype(np.uint32)

    if not copies:
        return symbols(alpha, after[3][here]) << np.uint32(24) | symbols(red, after[1][here]) << np.uint32(16) | symbols(green, here) << np.uint32(8) | symbols(blue, after[2][here])
    begin = np.cumsum(size) - size
    out = np.zeros(total, dtype=np.uint32)
    lit = here[~copy]
    out[begin[~copy]] = symbols(alpha, after[3][lit]) << np.uint32(24) | symbols(red, after[1][lit]) << np.uint32(16) | symbols(green, lit) << np.uint32(8) | symbols(blue, after[2][lit])
    for a, k, code in zip(begin[copy].tolist(), size[copy].tolist(), back[slot[copy]].tolist(), strict=True):
        d = _distance(code, width)
        if d > a or a + k > total:
            raise WebPError("a back-reference out of range")
        if d >= k:
            out[a : a + k] = out[a - d : a - d + k]
        else:
            out[a : a + k] = np.resize(out[a - d : a], k)
    return out


def _values(window: np.ndarray, code: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths or distances by their prefix codes, and the places after their extra bits."""
    extra = np.where(code < 4, 0, (code - 2) >> 1).astype(np.int64)
    low = window[at] & ((1 << np.minimum(extra, 16)) - 1)
    more = np.maximum(extra - 16, 0)
    high = window[np.minimum(at + 16, n - 1)] & ((1 << more) - 1)
    value = np.where(code < 4, code + 1, ((2 + (code & 1)).astype(np.int64) << extra) + (high << 16 | low) + 1)
    return value, np.minimum(at + extra, n - 1)


def channels(argb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple((argb >> np.uint32(s)) & np.uint32(255) for s in (24, 16, 8, 0))


def _join(a: np.ndarray, r: np.ndarray, g: np.ndarray, b: np.ndarray) -> np.ndarray:
    m = np.uint32(255)
    return (a & m) << np.uint32(24) | (r & m) << np.uint32(16) | (g & m) << np.uint32(8) | (b & m)


def _add(x: int, y: int) -> int:
    return ((x & 0xFF00FF00) + (y & 0xFF00FF00)) & 0xFF00FF00 | ((x & 0x00FF00FF) + (y & 0x00FF00FF)) & 0x00FF00FF


def _mean(x: int, y: int) -> int:
    return (((x ^ y) & 0xFEFEFEFE) >> 1) + (x & y)


def _parts(x: int) -> tuple[int, int, int, int]:
    return x >> 24, x >> 16 & 255, x >> 8 & 255, x & 255


def _whole(v: list[int]) -> int:
    return v[0] << 24 | v[1] << 16 | v[2] << 8 | v[3]


def _clamp(x: int) -> int:
    return 0 if x < 0 else min(x, 255)


def predict(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """A pixel from those at its left, top, top right and top left."""
    if mode == 1:
        return left
    if mode == 2:
        return top
    if mode == 3:
        return right
    if mode == 4:
        return corner
    if mode == 5:
        return _mean(_mean(left, right), top)
    if mode == 6:
        return _mean(left, corner)
    if mode == 7:
        return _mean(left, top)
    if mode == 8:
        return _mean(corner, top)
    if mode == 9:
        return _mean(top, right)
    if mode == 10:
        return _mean(_mean(left, corner), _mean(top, right))
    if mode == 11:
        ps, ls, ts = _parts(corner), _parts(left), _parts(top)
        to_left = sum(abs(t - c) for t, c in zip(ts, ps, strict=True))
        to_top = sum(abs(x - c) for x, c in zip(ls, ps, strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return _whole([_clamp(a + b - c) for a, b, c in zip(_parts(left), _parts(top), _parts(corner), strict=True)])
    if mode == 13:
        avg = _mean(left, top)
        return _whole([_clamp(a + int((a - c) / 2)) for a, c in zip(_parts(avg), _parts(corner), strict=True)])
    return 0xFF000000


def _predicted(out: list[int], at: int, x: int, y: int, width: int, mode: int) -> int:
    if not y:
        return out[at - 1] if x else 0xFF000000
    if not x:
        return out[at - width]
    return predict(mode, out[at - 1], out[at - width], out[at - width + 1], out[at - width - 1])


#: Predictors whose differences are worked out without a loop over pixels.
LEFT, TOP = 1, 2


def _differences(px: np.ndarray, height: int, width: int, mode: int) -> np.ndarray:
    """Each pixel less the one to its left, or the one above (the other one in the first row or column)."""
    out = []
    for k, c in enumerate(channels(px)):
        c = c.reshape(height, width)
        d = c.copy()
        if mode == LEFT:
            d[:, 1:] -= c[:, :-1]
            d[1:, 0] -= c[:-1, 0]
        else:
            d[1:] -= c[:-1]
            d[0, 1:] -= c[0, :-1]
        if k == 0:
            d[0, 0] += 1  # less 255
        out.append(d.ravel())
    return _join(*out)


def _summed(diff: np.ndarray, height: int, width: int, mode: int) -> np.ndarray:
    """What _differences came from."""
    out = []
    for k, d in enumerate(channels(diff)):
        c = d.reshape(height, width).astype(np.uint32)
        if k == 0:
            c[0, 0] += 255
        if mode == LEFT:
            c[:, 0] = np.cumsum(c[:, 0], dtype=np.uint32)
            c = np.cumsum(c, axis=1, dtype=np.uint32)
        else:
            c[0] = np.cumsum(c[0], dtype=np.uint32)
            c = np.cumsum(c, axis=0, dtype=np.uint32)
        out.append(c.ravel())
    return _join(*out)


@dataclass
class Transform:
    kind: int
    bits: int = 0
    data: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint32))
    width: int = 0

    def invert(self, image: np.ndarray, height: int) -> np.ndarray:
        """image: flat; width is that of the result."""
        if self.kind == SUBTRACT_GREEN:
            a, r, g, b = channels(image)
            return _join(a, r + g, g, b + g)
        if self.kind == PALETTE:
            return self._colours(image, height)
        rows, cols = np.divmod(np.arange(len(image)), self.width)
        block = self.data[(rows >> self.bits) * _up(self.width, self.bits) + (cols >> self.bits)]
        if self.kind == CROSS_COLOR:
            a, r, g, b = channels(image)
            red_blue, green_blue, green_red = (x.astype(np.uint8).view(np.int8).astype(np.int32) for x in channels(block)[1:])
            g8 = g.astype(np.uint8).view(np.int8).astype(np.int32)
            r = (r + (green_red * g8 >> 5).astype(np.uint32)) & np.uint32(255)
            r8 = r.astype(np.uint8).view(np.int8).astype(np.int32)
            return _join(a, r, g, b + (green_blue * g8 >> 5).astype(np.uint32) + (red_blue * r8 >> 5).astype(np.uint32))
        if len(block) and (block == block[0]).all() and (mode := int(block[0] >> np.uint32(8)) & 15) in (LEFT, TOP):
            return _summed(image, height, self.width, mode)
        modes, diff, out = ((block >> np.uint32(8)) & np.uint32(15)).tolist(), image.tolist(), [0] * len(image)
        at = 0
        for y in range(height):
            for x in range(self.width):
                out[at] = _add(diff[at], _predicted(out, at, x, y, self.width, modes[at]))
                at += 1
        return np.array(out, dtype=np.uint32)

    def _colours(self, image: np.ndarray, height: int) -> np.ndarray:
        index = (image >> np.uint32(8)) & np.uint32(255)
        if self.bits:
            per, depth = 1 << self.bits, 8 >> self.bits
            index = (index[:, None] >> (np.arange(per, dtype=np.uint32) * np.uint32(depth))) & np.uint32((1 << depth) - 1)
            index = index.reshape(height, -1)[:, : self.width].ravel()
        table = np.zeros(256, dtype=np.uint32)
        table[: len(self.data)] = self.data
        return table[index]


def packed_bits(colours: int) -> int:
    """Pixels that share a byte, as a power of two."""
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def decode_chunk(data: bytes) -> np.ndarray:
    """An image from a VP8L chunk."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise WebPError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise WebPError("an unknown version")
    transforms, inner = [], width
    while bits.read(1):
        kind = bits.read(2)
        if any(t.kind == kind for t in transforms):
            raise WebPError("a transform twice")
        if kind in (PREDICTOR, CROSS_COLOR):
            size = bits.read(3) + 2
            transforms.append(Transform(kind, size, read_image(bits, _up(inner, size), _up(height, size), False), inner))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            deltas = read_image(bits, n, 1, False)
            colours = _join(*(np.cumsum(c, dtype=np.uint32) for c in channels(deltas)))
            transforms.append(Transform(kind, packed_bits(n), colours, inner))
            inner = _up(inner, packed_bits(n))
        else:
            transforms.append(Transform(kind))
    image = read_image(bits, inner, height, True)
    for t in reversed(transforms):
        image = t.invert(image, height)
    return image.reshape(height, width)


def files(data: bytes) -> list[bytes]:
    """The VP8L chunks of the files that data holds one after the other."""
    found, at = [], 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
            raise WebPError("no RIFF header")
        end, k = at + 8 + struct.unpack_from("<I", data, at + 4)[0], at + 12
        chunk = None
        while k + 8 <= end:
            n = struct.unpack_from("<I", data, k + 4)[0]
            if data[k : k + 4] == b"VP8L":
                chunk = data[k + 8 : k + 8 + n]
            k += 8 + n + (n & 1)
        if chunk is None or end > len(data):
            raise WebPError("no lossless image")
        found.append(chunk)
        at = end
    return found


def decode(data: bytes) -> np.ndarray:
    """The image in a file."""
    (chunk,) = files(data)
    return decode_chunk(chunk)


# What follows encodes.


class Writer:
    """Collects (value, number of bits)."""

    def __init__(self) -> None:
        self.values: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.head: list[tuple[int, int]] = []

    def put(self, value: int, n: int) -> None:
        self.head.append((value, n))

    def many(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self._flush()
        self.values.append(values.astype(np.uint64))
        self.sizes.append(sizes.astype(np.int64))

    def _flush(self) -> None:
        if self.head:
            v, n = zip(*self.head, strict=True)
            self.values.append(np.array(v, dtype=np.uint64))
            self.sizes.append(np.array(n, dtype=np.int64))
            self.head = []

    def done(self) -> bytes:
        self._flush()
        v, n = np.concatenate(self.values), np.concatenate(self.sizes)
        ends = np.cumsum(n)
        shift = np.arange(ends[-1]) - np.repeat(ends - n, n)
        bit = (np.repeat(v, n) >> shift.astype(np.uint64)).astype(np.uint8) & 1
        return np.packbits(bit, bitorder="little").tobytes()


def code_lengths(counts: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Used symbols, and the lengths of a prefix code for them of at most so many bits."""
    symbols = np.flatnonzero(counts)
    weight = counts[symbols].tolist()
    symbols = symbols.tolist()
    if len(symbols) == 1:
        return symbols, [1]
    while True:
        heap = [(w, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        parent, k = [0] * (2 * len(weight)), len(weight)
        while len(heap) > 1:
            a = heapq.heappop(heap)
            b = heap[0]
            parent[a[1]] = parent[b[1]] = k
            heapq.heapreplace(heap, (a[0] + b[0], k))
            k += 1
        depth = [0] * k
        for i in range(k - 2, -1, -1):
            depth[i] = depth[parent[i]] + 1
        lengths = depth[: len(weight)]
        if max(lengths) <= most:
            return symbols, lengths
        weight = [(w + 1) // 2 for w in weight]


def codes_of(symbols: list[int], lengths: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of each symbol as they are written, and how many."""
    value, n = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    if len(symbols) == 1:
        return value, n
    s, k = np.array(symbols), np.array(lengths)
    order = np.lexsort((s, k))
    s, k = s[order], k[order]
    most = int(k[-1])
    begin = np.cumsum(1 << (most - k)) - (1 << (most - k))
    value[s] = reversal(most)[begin]
    n[s] = k
    return value, n


def _code(w: Writer, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Writes the prefix code for symbols that occur so often; its codes."""
    size = len(counts)
    symbols = np.flatnonzero(counts).tolist() or [0]
    if len(symbols) > 2 or symbols[-1] > 255:
        symbols, lengths = code_lengths(counts, 15)
    else:
        lengths = [1] * len(symbols)
    if len(symbols) <= 2 and symbols[-1] < 256:
        w.put(1, 1)
        w.put(len(symbols) - 1, 1)
        w.put(1, 1)
        for s in symbols:
            w.put(s, 8)
        return codes_of(symbols, lengths, size) if len(symbols) > 1 else (np.zeros(size, dtype=np.int64),) * 2
    tokens, at = [], 0
    for s, k in zip([*symbols, size], [*lengths, 0], strict=True):
        gap = s - at
        while gap >= 11:
            n = min(gap, 138)
            tokens.append((18, n - 11, 7))
            gap -= n
        if gap >= 3:
            tokens.append((17, gap - 3, 3))
            gap = 0
        tokens += [(0, 0, 0)] * gap
        if k:
            tokens.append((k, 0, 0))
        at = s + 1
    inner = np.bincount([t for t, _, _ in tokens], minlength=19)
    used, lens = code_lengths(inner, 7)
    by = dict(zip(used, lens, strict=True))
    w.put(0, 1)
    last = max(i for i, s in enumerate(CODE_LENGTH_ORDER) if s in by)
    count = max(4, last + 1)
    w.put(count - 4, 4)
    for s in CODE_LENGTH_ORDER[:count]:
        w.put(by.get(s, 0), 3)
    w.put(0, 1)
    value, n = codes_of(used, lens, 19)
    value, n = value.tolist(), n.tolist()
    for t, extra, k in tokens:
        w.put(value[t] | extra << n[t], n[t] + k)
    return codes_of(symbols, lengths, size)


def _prefix(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix code, extra bits and their number, of lengths or distance codes."""
    v = v.astype(np.int64) - 1
    top = np.floor(np.log2(np.maximum(v, 1))).astype(np.int64)
    extra = np.where(v < 4, 0, top - 1)
    code = np.where(v < 4, v, 2 * top + ((v >> np.maximum(top - 1, 0)) & 1))
    return code, np.where(v < 4, 0, v & ((1 << np.maximum(extra, 0)) - 1)), extra


def repeats(px: np.ndarray, most: int = 4096) -> list[tuple[int, int, int]]:
    """(place, length, distance) of greedy copies of twelve pixels or more, begun where a hash of twelve is one of sixteen chosen values."""
    n = len(px)
    if n < 24:
        return []
    with np.errstate(over="ignore"):
        four = px[:-3] * np.uint32(0x9E3779B1) ^ px[1:-2] * np.uint32(0x85EBCA77) + px[2:-1] * np.uint32(0xC2B2AE3D) ^ px[3:] * np.uint32(0x27D4EB2F)
        key = four[:-8] * np.uint32(0x165667B1) ^ four[4:-4] * np.uint32(0x9E3779B1) + four[8:] * np.uint32(0x85EBCA77)
        key ^= key >> np.uint32(15)
    some = np.flatnonzero((key & np.uint32(15)) == 0)
    order = np.argsort(key[some], kind="stable")
    same = key[some[order[1:]]] == key[some[order[:-1]]]
    found, free = [], 0
    p, q = some[order[1:]][same], some[order[:-1]][same]
    near = p - q <= FARTHEST
    pairs = np.sort(p[near] * n + q[near])
    for p, q in zip((pairs // n).tolist(), (pairs % n).tolist(), strict=True):
        if p < free:
            continue
        room, size = min(most, n - p), 32
        while True:
            size = min(size, room)
            differ = np.flatnonzero(px[p : p + size] != px[q : q + size])
            if len(differ) or size == room:
                break
            size *= 8
        k = int(differ[0]) if len(differ) else size
        if k < 12:
            continue
        d = p - q
        while p > free and q > 0 and k < most and px[p - 1] == px[q - 1]:
            p, q, k = p - 1, q - 1, k + 1
        found.append((p, k, d))
        free = p + k
    return found


def _write_literals(w: Writer, px: np.ndarray) -> None:
    value = bits = np.zeros(1, dtype=np.int64)
    for i, c in enumerate((channels(px)[k] for k in (2, 1, 3, 0))):
        size = 256 if i else LITERALS + LENGTHS
        if (c == c[0]).all():
            counts = np.zeros(size, dtype=np.int64)
            counts[c[0]] = len(c)
        else:
            counts = np.bincount(c, minlength=size)
        v, n = _code(w, counts)
        if n.any():
            value = value | v[c] << bits
            bits = bits + n[c]
    _code(w, np.zeros(DISTANCES, dtype=np.int64))
    if len(bits) == len(px):
        w.many(value, bits)


def _write_image(w: Writer, px: np.ndarray, main: bool, copy: bool = True, cache: int = 0) -> None:
    w.put(1 if cache else 0, 1)
    if cache:
        w.put(cache, 4)
    if main:
        w.put(0, 1)
    found = repeats(px) if copy else []
    if not found and not cache:
        return _write_literals(w, px)
    literal = np.ones(len(px), dtype=bool)
    for p, k, _ in found:
        literal[p : p + k] = False
    at = np.flatnonzero(literal)
    a, r, g, b = (c.astype(np.int64)[at] for c in channels(px))
    hit = np.zeros(len(at), dtype=bool)
    if cache:
        kept: dict[int, int] = {}
        where = iter(at.tolist())
        nxt, i = next(where, -1), 0
        for p, v in enumerate(px.tolist()):
            h = ((CACHE_FACTOR * v) & 0xFFFFFFFF) >> (32 - cache)
            if p == nxt:
                if kept.get(h, 0) == v:
                    hit[i] = True
                    g[i] = LITERALS + LENGTHS + h
                i += 1
                nxt = next(where, -1)
            kept[h] = v
    place = np.array([p for p, _, _ in found], dtype=np.int64)
    lcode, lbits, lextra = _prefix(np.array([k for _, k, _ in found], dtype=np.int64))
    dcode, dbits, dextra = _prefix(np.array([d + len(NEAR) for _, _, d in found], dtype=np.int64))
    size = LITERALS + LENGTHS + (1 << cache if cache else 0)
    first = np.bincount(g, minlength=size) + np.bincount(lcode + LITERALS, minlength=size)
    (gv, gn), (rv, rn), (bv, bn), (av, an) = (_code(w, c) for c in (first, *(np.bincount(c[~hit], minlength=256) for c in (r, b, a))))
    dv, dn = _code(w, np.bincount(dcode, minlength=DISTANCES))
    order = np.argsort(np.concatenate([at, place]), kind="stable")
    keep = (~hit).astype(np.int64)
    pieces = (
        (np.concatenate([gv[g], gv[lcode + LITERALS]]), np.concatenate([gn[g], gn[lcode + LITERALS]])),
        (np.concatenate([rv[r] * keep, lbits]), np.concatenate([rn[r] * keep, lextra])),
        (np.concatenate([bv[b] * keep, dv[dcode]]), np.concatenate([bn[b] * keep, dn[dcode]])),
        (np.concatenate([av[a] * keep, dbits]), np.concatenate([an[a] * keep, dextra])),
    )
    value = np.zeros(len(order), dtype=np.uint64)
    bits = np.zeros(len(order), dtype=np.int64)
    for v, n in pieces:
        value |= v[order].astype(np.uint64) << bits.astype(np.uint64)
        bits += n[order]
    w.many(value, bits)


def encode(image: np.ndarray, transforms: tuple[int, ...] = (), block: int = 3, modes: np.ndarray | None = None, cross: np.ndarray | None = None, cache: int = 0, copy: bool = True) -> bytes:
    """A file. transforms: in the order in which they are applied; modes and cross: data of the predictor and cross-colour ones."""
    height, width = image.shape
    w = Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(int(image.min() < 0xFF000000), 1)
    w.put(0, 3)
    px, inner = image.astype(np.uint32).ravel(), width
    for kind in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        if kind == SUBTRACT_GREEN:
            a, r, g, b = channels(px)
            px = _join(a, r - g, g, b - g)
        elif kind == PALETTE:
            colours, index = np.unique(px, return_inverse=True)
            if len(colours) > 256:
                raise WebPError("too many colours")
            w.put(len(colours) - 1, 8)
            _write_image(w, _join(*(np.diff(c, prepend=np.uint32(0)) for c in channels(colours))), False, False)
            bits = packed_bits(len(colours))
            per, depth = 1 << bits, 8 >> bits
            wide = _up(inner, bits)
            grid = np.zeros((height, wide * per), dtype=np.uint32)
            grid[:, :inner] = index.reshape(height, inner)
            packed = (grid.reshape(height, wide, per) << (np.arange(per, dtype=np.uint32) * np.uint32(depth))).sum(axis=2, dtype=np.uint32)
            px, inner = (np.uint32(0xFF000000) | packed << np.uint32(8)).ravel(), wide
        else:
            w.put(block - 2, 3)
            data = (modes if kind == PREDICTOR else cross).astype(np.uint32).ravel()
            _write_image(w, data, False, False)
            rows, cols = np.divmod(np.arange(len(px)), inner)
            each = data[(rows >> block) * _up(inner, block) + (cols >> block)]
            if kind == PREDICTOR and (data == data[0]).all() and (mode := int(data[0] >> 8) & 15) in (LEFT, TOP):
                px = _differences(px, height, inner, mode)
            elif kind == PREDICTOR:
                flat = px.tolist()
                guess = [_predicted(flat, i, i % inner, i // inner, inner, m) for i, m in enumerate(((each >> np.uint32(8)) & np.uint32(15)).tolist())]
                px = _join(*(x - y for x, y in zip(channels(px), channels(np.array(guess, dtype=np.uint32)), strict=True)))
            else:
                a, r, g, b = channels(px)
                red_blue, green_blue, green_red = (x.astype(np.uint8).view(np.int8).astype(np.int32) for x in channels(each)[1:])
                g8, r8 = (x.astype(np.uint8).view(np.int8).astype(np.int32) for x in (g, r))
                px = _join(a, r - (green_red * g8 >> 5).astype(np.uint32), g, b - (green_blue * g8 >> 5).astype(np.uint32) - (red_blue * r8 >> 5).astype(np.uint32))
    w.put(0, 1)
    _write_image(w, px, True, copy, cache)
    return _file(w.done())


def _one_symbol(w: Writer, symbol: int) -> None:
    w.put(5 | symbol << 3, 11)


def encode_gray(gray: np.ndarray) -> bytes:
    """A file of an opaque gray image (uint8): green is subtracted, so that one channel is left to code."""
    height, width = gray.shape
    w = Writer()
    w.put(0x2F | width - 1 << 8 | height - 1 << 22, 40)
    w.put(1 | SUBTRACT_GREEN << 1, 3)
    w.put(0, 3)  # no more transforms, no cache, one group
    g = gray.ravel()
    found = repeats(g.astype(np.uint32))
    if not found:
        value, n = _code(w, np.bincount(g, minlength=LITERALS + LENGTHS))
        for s in (0, 0, 255, 0):
            _one_symbol(w, s)
        if n.any():
            w.many(value[g], n[g])
        return _file(w.done())
    place, length, dist = np.array(found, dtype=np.int64).T
    lcode, lbits, lextra = _prefix(length)
    dcode, dbits, dextra = _prefix(dist + len(NEAR))
    token = np.concatenate([g.astype(np.int64), lcode + LITERALS])
    step = np.zeros(len(g) + 1, dtype=np.int8)
    step[place] += 1
    step[place + length] -= 1
    keep = np.concatenate([np.cumsum(step[:-1], dtype=np.int8) == 0, np.ones(len(place), dtype=bool)])
    order = np.argsort(np.concatenate([np.arange(len(g)), place]), kind="stable")
    order = order[keep[order]]
    gv, gn = _code(w, np.bincount(token[keep], minlength=LITERALS + LENGTHS))
    for s in (0, 0, 255):
        _one_symbol(w, s)
    dv, dn = _code(w, np.bincount(dcode, minlength=DISTANCES))
    value, bits = gv[token], gn[token]
    k = len(g)
    value[k:] |= (lbits | (dv[dcode] | dbits << dn[dcode]) << lextra) << bits[k:]
    bits[k:] += lextra + dn[dcode] + dextra
    w.many(value[order], bits[order])
    return _file(w.done())


#: Pixels of an image up to which other transforms than the subtraction of green are weighed.
WEIGHED = 1 << 18


def _cost(values: np.ndarray) -> float:
    """Bits that the values take at least, each coded by itself."""
    counts = np.bincount(values.ravel(), minlength=256)
    counts = counts[counts > 0]
    return float((counts * np.log2(counts.sum() / counts)).sum())


def encode_best(gray: np.ndarray) -> bytes:
    """A file of an opaque gray image (uint8) with the transforms that suit it.

    Few colours are packed by a palette; differences to the left or to the row above are taken if
    they cost well under what the values do; otherwise (plain text) only green is subtracted.
    """
    if gray.size <= WEIGHED:
        flat = gray.ravel()
        colours = int(np.count_nonzero(np.bincount(flat, minlength=256)))
        if colours > 1:
            wide = gray.astype(np.uint32) * np.uint32(0x010101) | np.uint32(0xFF000000)
            if colours <= 16:
                return encode(wide, (PALETTE,))
            best = 0.7 * _cost(flat)
            for mode, axis in ((LEFT, 1), (TOP, 0)):
                if len(gray) > 1 and _cost(np.diff(gray, axis=axis)) < best:
                    blocks = _up(gray.shape[0], 9) * _up(gray.shape[1], 9)
                    return encode(wide, (PREDICTOR, SUBTRACT_GREEN), block=9, modes=np.full(blocks, mode << 8))
    return encode_gray(gray)


def _file(chunk: bytes) -> bytes:
    pad = len(chunk) & 1
    return b"RIFF" + struct.pack("<I", 12 + len(chunk) + pad) + b"WEBPVP8L" + struct.pack("<I", len(chunk)) + chunk + b"\0" * pad
