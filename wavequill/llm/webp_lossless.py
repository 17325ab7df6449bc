"""Lossless WebP (VP8L): a decoder for whole batches of images in lockstep, and the encoders that feed it.

The decoder reads every feature of the format: simple and normal prefix codes, groups of codes by an entropy image,
back-references, the colour cache, and the predictor, cross-colour, subtract-green and palette transforms. The
images of a batch advance together, one pixel a step each, so that numpy works on as many bit streams at a time as
the batch has images; prefix tables are shared between images with equal headers.

`store_payloads` writes bytes as pixels (four bytes each) with one fixed set of prefix codes, a colour cache and
runs; images of at most 16 colours get a palette instead. `encode` builds codes for one image and can apply every
transform. The output depends on the bytes alone, never on the batch.
"""

from __future__ import annotations

import heapq
import struct
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np

# --- fixed values of the format ---
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = 0, 1, 2, 3
CACHE_MULTIPLIER = 0x1E35A7BD
LENGTHS, DISTANCES = 24, 40
OPAQUE = 0xFF000000
# --- end of fixed values ---
#: neighbours above and left, nearest first: distance codes 1 to 120
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
MOST = 1 << 14


# ---------------------------------------------------------------- bits and codes


class Bits:
    """Reads bits, least significant first."""

    def __init__(self, data: bytes, at: int = 0):
        self.value, self.at, self.size = int.from_bytes(data, "little"), at, 8 * len(data)
        self.data = data

    def read(self, n: int) -> int:
        if self.at + n > self.size:
            raise ValueError("the image ends early")
        first = self.at >> 3
        v = int.from_bytes(self.data[first : first + 8], "little") >> (self.at & 7) & ((1 << n) - 1)
        self.at += n
        return v


class Writer:
    def __init__(self) -> None:
        self.value = self.at = 0

    def write(self, value: int, n: int) -> None:
        self.value |= value << self.at
        self.at += n

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.at + 7) // 8, "little")


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes of the lengths, bit-reversed as they stand in the stream; a lone symbol has the empty code."""
    codes, code = np.zeros(len(lengths), np.int64), 0
    for n in range(1, 16):
        for s in np.flatnonzero(lengths == n):
            codes[s] = int(f"{code:0{n}b}"[::-1], 2)
            code += 1
        code <<= 1
    return codes


def lookup(lengths: np.ndarray) -> np.ndarray:
    """For every value of the next bits (as many as the longest code has): symbol << 4 | length."""
    used = np.flatnonzero(lengths)
    if len(used) == 0:
        return np.zeros(1, np.int32)
    if len(used) == 1:
        return np.array([used[0] << 4], np.int32)
    if sum(1 << (15 - int(n)) for n in lengths[used]) != 1 << 15:
        raise ValueError("a prefix code is not complete")
    bits, codes = int(lengths.max()), canonical(lengths)
    table = np.zeros(1 << bits, np.int32)
    for s in used:
        table[codes[s] :: 1 << int(lengths[s])] = (s << 4) | int(lengths[s])
    return table


def code_lengths(weights: np.ndarray, most: int = 15) -> np.ndarray:
    """Huffman code lengths of at most `most` bits; small weights are raised until they fit."""
    used = np.flatnonzero(weights)
    lengths = np.zeros(len(weights), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    w = {int(s): float(weights[s]) for s in used}
    while True:
        heap = [(v, s, (s,)) for s, v in w.items()]
        depth = dict.fromkeys(w, 0)
        heapq.heapify(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= most:
            lengths[list(depth)] = list(depth.values())
            return lengths
        floor = 2 * min(w.values())
        w = {s: max(v, floor) for s, v in w.items()}


def prefix_of(value: int) -> tuple[int, int, int]:
    """Symbol, extra bits and their number for a length or a distance code of 1 or more."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    high = v.bit_length() - 1
    extra = high - 1
    return 2 * high + (v >> extra & 1), v & ((1 << extra) - 1), extra


def read_prefix_value(symbol: int, bits: Bits) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def distance_of(code: int, width: int) -> int:
    if code > len(NEAR):
        return code - len(NEAR)
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


def read_code(bits: Bits, alphabet: int) -> np.ndarray:
    lengths = np.zeros(alphabet, np.int64)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = [bits.read(8 if wide else 1)] + ([bits.read(8)] if two else [])
        if max(symbols) >= alphabet:
            raise ValueError("a symbol outside the alphabet")
        lengths[symbols] = 1
        return lengths
    meta = np.zeros(19, np.int64)
    for k in CODE_LENGTH_ORDER[: 4 + bits.read(4)]:
        meta[k] = bits.read(3)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    table = lookup(meta)
    mask, last, i = len(table) - 1, 8, 0
    width = len(table).bit_length() - 1
    while i < alphabet and left > 0:
        left -= 1
        peek = min(width, bits.size - bits.at)
        entry = int(table[bits.read(peek) & mask])
        bits.at -= peek - (entry & 15)
        s = entry >> 4
        if s < 16:
            lengths[i] = s
            i, last = i + 1, s or last
            continue
        n, v = (3 + bits.read(2), last) if s == 16 else (3 + bits.read(3), 0) if s == 17 else (11 + bits.read(7), 0)
        if i + n > alphabet:
            raise ValueError("too many code lengths")
        lengths[i : i + n] = v
        i += n
    return lengths


def write_code(out: Writer, lengths: np.ndarray) -> None:
    used = np.flatnonzero(lengths)
    if len(used) <= 2 and all(s < 256 for s in used):
        symbols = [int(s) for s in used] or [0]
        out.write(1, 1)
        out.write(len(symbols) - 1, 1)
        out.write(1, 1)
        for s in symbols:
            out.write(s, 8)
        return
    tokens, i = [], 0  # (symbol, extra, its bits)
    while i < len(lengths):
        n = 1
        while i + n < len(lengths) and lengths[i + n] == lengths[i]:
            n += 1
        if lengths[i] == 0 and n >= 3:
            n = min(n, 138)
            tokens.append((18, n - 11, 7) if n >= 11 else (17, n - 3, 3))
            i += n
        else:
            tokens.append((int(lengths[i]), 0, 0))
            i += 1
            while n > 3 and lengths[i - 1]:
                k = min(6, n - 1)
                tokens.append((16, k - 3, 2))
                i, n = i + k, n - k
    meta = code_lengths(np.bincount([t[0] for t in tokens], minlength=19), 7)
    codes = canonical(meta)
    if np.count_nonzero(meta) == 1:
        codes, sizes = np.zeros(19, np.int64), np.zeros(19, np.int64)
    else:
        sizes = meta
    count = max(4, 1 + max(i for i, k in enumerate(CODE_LENGTH_ORDER) if meta[k]))
    out.write(0, 1)
    out.write(count - 4, 4)
    for k in CODE_LENGTH_ORDER[:count]:
        out.write(int(meta[k]), 3)
    out.write(0, 1)
    for s, extra, n in tokens:
        out.write(int(codes[s]), int(sizes[s]))
        out.write(extra, n)


# ---------------------------------------------------------------- decoding


@dataclass
class Stream:
    """What a coded image is decoded with: where its pixels begin and its prefix tables by group."""

    data: bytes
    at: int
    width: int
    height: int
    cache_bits: int = 0
    groups: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    tile_bits: int = 0
    tiles: np.ndarray | None = None  # group of every tile


_KNOWN: OrderedDict[tuple, list] = OrderedDict()  # codes by the header bits they were read from


def _read_groups(bits: Bits, count: int, cache_bits: int) -> list[tuple[np.ndarray, ...]]:
    near = (count, cache_bits, bits.data[bits.at // 8 : bits.at // 8 + 24], bits.at % 8)
    for size, header, groups in _KNOWN.get(near, ()):
        first = bits.at >> 3
        if int.from_bytes(bits.data[first : first + (bits.at % 8 + size + 7) // 8], "little") >> (bits.at & 7) & ((1 << size) - 1) == header:
            bits.at += size
            return groups
    begin = bits.at
    sizes = (256 + LENGTHS + ((1 << cache_bits) if cache_bits else 0), 256, 256, 256, DISTANCES)
    groups = [tuple(lookup(read_code(bits, n)) for n in sizes) for _ in range(count)]
    size = bits.at - begin
    header = bits.value >> begin & ((1 << size) - 1)
    if len(same := _KNOWN.setdefault(near, [])) < 16:
        same.append((size, header, groups))
    while len(_KNOWN) > 256:
        _KNOWN.popitem(last=False)
    return groups


def _read_stream(bits: Bits, width: int, height: int, main: bool) -> Stream:
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("a colour cache of more than 11 bits")
    tile_bits, tiles, count = 0, None, 1
    if main and bits.read(1):
        tile_bits = bits.read(3) + 2
        tiles = _read_image(bits, -(-width >> tile_bits), -(-height >> tile_bits)) >> 8 & 0xFFFF
        count = int(tiles.max()) + 1
    return Stream(bits.data, 0, width, height, cache_bits, _read_groups(bits, count, cache_bits), tile_bits, tiles)


def _read_image(bits: Bits, width: int, height: int) -> np.ndarray:
    """An image inside a header (transform data, an entropy image, a palette)."""
    s = _read_stream(bits, width, height, main=False)
    s.at = bits.at
    pixels, ends = decode_streams([s])
    bits.at = int(ends[0])
    return pixels[0]


def decode_streams(streams: list[Stream]) -> tuple[list[np.ndarray], np.ndarray]:
    """The pixels of every stream and the bit at which each ends. All streams advance one pixel a step."""
    n = len(streams)
    counts = np.array([s.width * s.height for s in streams], np.int64)
    begin = np.concatenate([[0], np.cumsum(counts)])
    pixels = np.zeros(int(begin[-1]), np.uint32)
    size = np.array([-(-len(s.data) // 4) + 4 for s in streams], np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    raw = np.zeros(int(base[-1]) * 4, np.uint8)
    for s, b in zip(streams, base, strict=False):
        raw[4 * b : 4 * b + len(s.data)] = np.frombuffer(s.data, np.uint8)
    words = raw.view("<u4").astype(np.uint64)
    words[:-1] |= words[1:] << np.uint64(32)  # 64 bits from every fourth byte on

    tables: dict[int, int] = {}  # place of each distinct table in `flat`
    parts: list[np.ndarray] = []
    filled = 0
    group_at, rows = [], []
    for s in streams:
        group_at.append(len(rows))
        for g in s.groups:
            row = []
            for t in g:
                if id(t) not in tables:
                    tables[id(t)] = filled
                    parts.append(t)
                    filled += len(t)
                row += [tables[id(t)], len(t) - 1]
            rows.append(row)
    flat, groups = np.concatenate(parts), np.array(rows, np.int64)
    many = any(s.tiles is not None for s in streams)
    cached = any(s.cache_bits for s in streams)
    cache_size = np.array([1 << s.cache_bits if s.cache_bits else 0 for s in streams], np.int64)
    cache_begin = np.concatenate([[0], np.cumsum(cache_size)])
    cache = np.zeros(max(1, int(cache_begin[-1])), np.uint32)
    shift = np.array([32 - s.cache_bits for s in streams], np.uint32)
    group_at = np.array(group_at, np.int64)

    ends = base[:-1] * 32 + np.array([s.at for s in streams], np.int64)
    lane = np.flatnonzero(counts > 0)
    at, out, stop = ends[lane], begin[lane].copy(), begin[lane + 1]
    limit = base[lane + 1] * 32 - 64
    tab, c_begin, c_shift = groups[group_at[lane]].T.copy(), cache_begin[lane], shift[lane]

    def window(where: np.ndarray) -> np.ndarray:
        return (words[where >> 5] >> (where & 31).astype(np.uint64)).astype(np.int64)

    while len(lane):
        if many:
            for k, i in enumerate(lane):
                s = streams[i]
                if s.tiles is not None:
                    y, x = divmod(int(out[k] - begin[i]), s.width)
                    g = s.tiles[(y >> s.tile_bits) * -(-s.width >> s.tile_bits) + (x >> s.tile_bits)]
                    tab[:, k] = groups[group_at[i] + g]
        w = window(at)
        green = flat[tab[0] + (w & tab[1])]
        used = green & 15
        symbol = green >> 4
        literal = symbol < 256
        if literal.all():
            red = flat[tab[2] + (w >> used & tab[3])]
            at += used + (red & 15)
            w = window(at)
            blue = flat[tab[4] + (w & tab[5])]
            used = blue & 15
            alpha = flat[tab[6] + (w >> used & tab[7])]
            at += used + (alpha & 15)
            pixel = ((alpha >> 4).astype(np.uint32) << 24) | ((red >> 4) << 16).astype(np.uint32) | (symbol << 8).astype(np.uint32) | (blue >> 4).astype(np.uint32)
        else:
            red = flat[tab[2] + (w >> used & tab[3])]
            after = at + used + (red & 15)
            at += used
            w = window(after)
            blue = flat[tab[4] + (w & tab[5])]
            used = blue & 15
            alpha = flat[tab[6] + (w >> used & tab[7])]
            pixel = ((alpha >> 4).astype(np.uint32) << 24) | ((red >> 4) << 16).astype(np.uint32) | (symbol << 8).astype(np.uint32) | (blue >> 4).astype(np.uint32)
            np.copyto(at, after + used + (alpha & 15), where=literal)
            if cached:
                hit = np.flatnonzero(symbol >= 256 + LENGTHS)
                pixel[hit] = cache[c_begin[hit] + symbol[hit] - 256 - LENGTHS]
            for k in np.flatnonzero(~literal & (symbol < 256 + LENGTHS)):
                s, first = streams[lane[k]], int(begin[lane[k]])
                b = Bits(s.data, int(at[k] - base[lane[k]] * 32))
                run = read_prefix_value(int(symbol[k]) - 256, b)
                t = s.groups[int(s.tiles[((out[k] - first) // s.width >> s.tile_bits) * -(-s.width >> s.tile_bits) + ((out[k] - first) % s.width >> s.tile_bits)]) if s.tiles is not None else 0][4]
                peek = min(len(t).bit_length() - 1, b.size - b.at)
                entry = int(t[b.read(peek)])
                b.at -= peek - (entry & 15)
                back = distance_of(read_prefix_value(entry >> 4, b), s.width)
                at[k] = b.at + base[lane[k]] * 32
                o = int(out[k])
                run = min(run, int(stop[k]) - o)
                if o - back < first:
                    raise ValueError("a reference before the image")
                copied = np.resize(pixels[o - back : min(o, o - back + run)], run)
                pixels[o : o + run] = copied
                if s.cache_bits:
                    cache[c_begin[k] + ((copied * np.uint32(CACHE_MULTIPLIER)) >> c_shift[k])] = copied
                pixel[k] = copied[-1]
                out[k] = o + run - 1
        pixels[out] = pixel
        if cached:
            own = c_shift < 32
            slot = c_begin + (pixel * np.uint32(CACHE_MULTIPLIER) >> np.minimum(c_shift, 31))
            if own.all():
                cache[slot] = pixel
            else:
                cache[slot[own]] = pixel[own]
        out += 1
        if (at > limit).any():
            raise ValueError("an image ends early")
        done = out >= stop
        if done.any():
            ends[lane[done]] = at[done]
            go = ~done
            lane, at, out, stop, limit, c_begin, c_shift, tab = lane[go], at[go], out[go], stop[go], limit[go], c_begin[go], c_shift[go], tab[:, go]
    return [pixels[a:b] for a, b in zip(begin, begin[1:], strict=False)], ends - base[:-1] * 32


def _channels(p: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(p).view(np.uint8).reshape(*p.shape, 4).astype(np.int64)  # blue, green, red, alpha


def _argb(c: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray((c & 255).astype(np.uint8)).view("<u4")[..., 0]


def predict(mode: int, left: np.ndarray, top: np.ndarray, right: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """The prediction of a pixel's channels from its left, top, top-right and top-left neighbours."""
    mean = lambda a, b: (a + b) >> 1
    if mode == 11:
        guess = left + top - corner
        return left if np.abs(guess - left).sum() < np.abs(guess - top).sum() else top
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        a = mean(left, top)
        d = a - corner
        return np.clip(a + np.sign(d) * (np.abs(d) >> 1), 0, 255)
    simple = {
        1: lambda: left, 2: lambda: top, 3: lambda: right, 4: lambda: corner, 5: lambda: mean(mean(left, right), top), 6: lambda: mean(left, corner),
        7: lambda: mean(left, top), 8: lambda: mean(corner, top), 9: lambda: mean(top, right), 10: lambda: mean(mean(left, corner), mean(top, right)),
    }
    return simple[mode]() if mode in simple else np.array([0, 0, 0, 255])


def _predictor(p: np.ndarray, modes: np.ndarray, bits: int, inverse: bool) -> np.ndarray:
    """Adds the predictions to residuals, or takes them from pixels."""
    h, w = p.shape
    src = _channels(p)
    out = src.copy()
    known = out if inverse else src
    for y in range(h):
        for x in range(w):
            if y == 0:
                guess = known[0, x - 1] if x else np.array([0, 0, 0, 255])
            elif x == 0:
                guess = known[y - 1, 0]
            else:
                right = known[y - 1, x + 1] if x + 1 < w else known[y, 0]
                guess = predict(int(modes[y >> bits, x >> bits]), known[y, x - 1], known[y - 1, x], right, known[y - 1, x - 1])
            out[y, x] = (src[y, x] + guess if inverse else src[y, x] - guess) & 255
    return _argb(out)


def _cross_colour(p: np.ndarray, elements: np.ndarray, bits: int, inverse: bool) -> np.ndarray:
    h, w = p.shape
    c = _channels(p)
    e = _channels(elements)[np.arange(h)[:, None] >> bits, np.arange(w)[None, :] >> bits]
    signed = lambda v: ((v & 255) ^ 128) - 128
    delta = lambda t, v: (signed(t) * signed(v)) >> 5
    green, sign = c[..., 1], 1 if inverse else -1
    red = c[..., 2] + sign * delta(e[..., 0], green)
    blue = c[..., 0] + sign * (delta(e[..., 1], green) + delta(e[..., 2], red if inverse else c[..., 2]))
    return _argb(np.stack([blue, green, red, c[..., 3]], -1))


def _green(p: np.ndarray, sign: int) -> np.ndarray:
    c = _channels(p)
    c[..., 0] += sign * c[..., 1]
    c[..., 2] += sign * c[..., 1]
    return _argb(c)


def _bundle(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def _unpalette(p: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    b = _bundle(len(table))
    each = 8 >> b
    index = p >> 8 & 255
    if b:
        index = (index[..., None] >> (each * np.arange(1 << b, dtype=np.uint32)) & ((1 << each) - 1)).reshape(len(p), -1)[:, :width]
    return np.append(table, np.zeros(256, np.uint32))[index]


def _vp8l(data: bytes) -> bytes:
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    at = 12
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        if name == b"VP8L":
            return data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no lossless image in the file")


def decode_batch(files: list[bytes]) -> list[np.ndarray]:
    """ARGB pixel arrays (height, width) of lossless WebP files."""
    streams, undo, shapes = [], [], []
    for f in files:
        bits = Bits(_vp8l(f))
        if bits.read(8) != 0x2F:
            raise ValueError("not a lossless image")
        width, height = bits.read(14) + 1, bits.read(14) + 1
        bits.read(4)
        shapes.append((height, width))
        steps, seen, x = [], set(), width
        while bits.read(1):
            kind = bits.read(2)
            if kind in seen:
                raise ValueError("a transform stands twice")
            seen.add(kind)
            if kind in (PREDICTOR, CROSS_COLOUR):
                b = bits.read(3) + 2
                w, h = -(-x >> b), -(-height >> b)
                steps.append((kind, b, _read_image(bits, w, h).reshape(h, w), x))
            elif kind == PALETTE:
                n = bits.read(8) + 1
                table = _argb(np.cumsum(_channels(_read_image(bits, n, 1)), axis=0))
                steps.append((kind, 0, table, x))
                x = -(-x >> _bundle(n))
            else:
                steps.append((kind, 0, None, x))
        s = _read_stream(bits, x, height, main=True)
        s.at = bits.at
        streams.append(s)
        undo.append(steps)
    found = []
    for p, s, steps, shape in zip(decode_streams(streams)[0], streams, undo, shapes, strict=True) if files else ():
        p = p.reshape(s.height, s.width)
        for kind, b, data, x in reversed(steps):
            if kind == PREDICTOR:
                p = _predictor(p, data >> 8 & 15, b, inverse=True)
            elif kind == CROSS_COLOUR:
                p = _cross_colour(p, data, b, inverse=True)
            elif kind == SUBTRACT_GREEN:
                p = _green(p, 1)
            else:
                p = _unpalette(p, data, x)
        assert p.shape == shape
        found.append(p)
    return found


# ---------------------------------------------------------------- encoding


def riff(body: bytes) -> bytes:
    pad = len(body) % 2
    return b"RIFF" + struct.pack("<I", 12 + len(body) + pad) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body + b"\0" * pad


def _tokens(p: np.ndarray, width: int, cache_bits: int, references: bool) -> list[tuple]:
    """("pixel", argb) | ("cache", slot) | ("copy", length, distance code)"""
    flat, out, i = [int(v) for v in p.ravel()], [], 0
    cache, seen = {}, {}
    slot = lambda v: (v * CACHE_MULTIPLIER & 0xFFFFFFFF) >> (32 - cache_bits)
    near = {}
    for k, (x, y) in enumerate(NEAR):
        near.setdefault(max(1, x + y * width), k + 1)
    while i < len(flat):
        n, back = 0, 0
        if references and (j := seen.get(tuple(flat[i : i + 3]))) is not None:
            back = i - j
            while i + n < len(flat) and n < 4096 and flat[j + n] == flat[i + n]:
                n += 1
        if n >= 3:
            out.append(("copy", n, near.get(back, back + len(NEAR))))
        else:
            n, v = 1, flat[i]
            out.append(("cache", slot(v)) if cache_bits and cache.get(slot(v)) == v else ("pixel", v))
        for k in range(i, i + n):
            if cache_bits:
                cache[slot(flat[k])] = flat[k]
            seen[tuple(flat[k : k + 3])] = k
        i += n
    return out


def _write_image(out: Writer, p: np.ndarray, main: bool, cache_bits: int = 0, references: bool = False, groups: np.ndarray | None = None, tile_bits: int = 2) -> None:
    """groups: for the main image the group of every tile."""
    height, width = p.shape
    out.write(1 if cache_bits else 0, 1)
    if cache_bits:
        out.write(cache_bits, 4)
    if main:
        out.write(0 if groups is None else 1, 1)
        if groups is not None:
            out.write(tile_bits - 2, 3)
            _write_image(out, (groups.astype(np.uint32) << 8), main=False)
    tokens = _tokens(p, width, cache_bits, references)
    count = 1 if groups is None else int(groups.max()) + 1
    sizes = (256 + LENGTHS + ((1 << cache_bits) if cache_bits else 0), 256, 256, 256, DISTANCES)
    weight = [[np.zeros(n, np.int64) for n in sizes] for _ in range(count)]
    coded, at = [], 0  # (group, code, symbol, extra, bits)
    for t in tokens:
        y, x = divmod(at, width)
        g = 0 if groups is None else int(groups[y >> tile_bits, x >> tile_bits])
        if t[0] == "pixel":
            v = t[1]
            coded += [(g, k, v >> s & 255, 0, 0) for k, s in enumerate((8, 16, 0, 24))]
        elif t[0] == "cache":
            coded.append((g, 0, 256 + LENGTHS + t[1], 0, 0))
        else:
            s, extra, n = prefix_of(t[1])
            coded.append((g, 0, 256 + s, extra, n))
            s, extra, n = prefix_of(t[2])
            coded.append((g, 4, s, extra, n))
        at += t[1] if t[0] == "copy" else 1
    for g, k, s, _, _ in coded:
        weight[g][k][s] += 1
    lengths = [[code_lengths(w) for w in row] for row in weight]
    codes = [[canonical(n) for n in row] for row in lengths]
    for row in lengths:
        for n in row:
            write_code(out, n)
    for g, k, s, extra, n in coded:
        if np.count_nonzero(lengths[g][k]) > 1:
            out.write(int(codes[g][k][s]), int(lengths[g][k][s]))
        out.write(extra, n)


def encode(pixels: np.ndarray, transforms: tuple[int, ...] = (), cache_bits: int = 0, references: bool = True, modes: np.ndarray | None = None, elements: np.ndarray | None = None, groups: np.ndarray | None = None, tile_bits: int = 2) -> bytes:
    """A lossless WebP file of ARGB pixels (height, width). modes and elements (one a tile of 4 x 4 pixels) drive the
    predictor and cross-colour transforms; groups (one a tile of 2**tile_bits) splits the prefix codes."""
    p = np.ascontiguousarray(pixels, np.uint32)
    height, width = p.shape
    out = Writer()
    out.write(0x2F, 8)
    out.write(width - 1, 14)
    out.write(height - 1, 14)
    out.write(1, 4)
    for kind in transforms:
        out.write(1, 1)
        out.write(kind, 2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            out.write(0, 3)
            h, w = -(-p.shape[0] // 4), -(-p.shape[1] // 4)
            if kind == PREDICTOR:
                m = np.full((h, w), 11) if modes is None else modes
                _write_image(out, (m.astype(np.uint32) << 8) | np.uint32(OPAQUE), main=False)
                p = _predictor(p, m, 2, inverse=False)
            else:
                e = np.full((h, w), 0xFF102030, np.uint32) if elements is None else elements
                _write_image(out, e, main=False)
                p = _cross_colour(p, e, 2, inverse=False)
        elif kind == SUBTRACT_GREEN:
            p = _green(p, -1)
        else:
            table, index = np.unique(p, return_inverse=True)
            if len(table) > 256:
                raise ValueError("more than 256 colours")
            out.write(len(table) - 1, 8)
            c = _channels(table)
            _write_image(out, _argb(np.diff(c, axis=0, prepend=np.zeros((1, 4), np.int64)))[None, :], main=False)
            b = _bundle(len(table))
            index = index.reshape(p.shape)
            index = np.pad(index, ((0, 0), (0, -index.shape[1] % (1 << b)))).reshape(height, -1, 1 << b)
            p = ((index << ((8 >> b) * np.arange(1 << b))).sum(axis=-1).astype(np.uint32) << 8) | np.uint32(OPAQUE)
    out.write(0, 1)
    _write_image(out, p, main=True, cache_bits=cache_bits, references=references, groups=groups, tile_bits=tile_bits)
    return riff(out.bytes())


# ---------------------------------------------------------------- payloads as images

CACHE_BITS, CODE_BITS = 10, 12
_COMMON = b" eantirosdlhucmgpbfv,.wqyzxjk\nEATIOSDLNRMCGPBFHUVW-'0123456789:;()\"/_=*#$%&|KQXYZJ"


def _byte_weights() -> np.ndarray:
    w = np.full(256, 2e-5)
    w[0x80:0xC0] = 8e-4
    w[0xC3], w[0] = 1e-2, 3e-3
    for rank, b in enumerate(_COMMON):
        w[b] = 1 / (rank + 2) ** 1.6
    return w / w.sum()


class _Fixed:
    """The fixed codes of payload images and the header that states them."""

    def __init__(self) -> None:
        w = _byte_weights()
        green = np.concatenate([w * 0.7, np.full(LENGTHS, 1e-5), np.full(1 << CACHE_BITS, 0.3 / (1 << CACHE_BITS))])
        lengths = [code_lengths(green, CODE_BITS), *[code_lengths(w, CODE_BITS)] * 3, np.eye(DISTANCES, dtype=np.int64)[prefix_of(2)[0]]]
        head = Writer()
        head.write(0, 1)  # no transform
        head.write(1, 1)
        head.write(CACHE_BITS, 4)
        head.write(0, 1)  # one group
        for n in lengths:
            write_code(head, n)
        self.head, self.head_bits = np.frombuffer(head.bytes(), np.uint8), head.at
        self.size = [n.astype(np.int64) for n in lengths]
        self.code = [canonical(n).astype(np.uint64) for n in lengths]


_fixed: _Fixed | None = None


def shape_of(n_pixels: int) -> tuple[int, int]:
    """Height and width of a payload image: 16 pixels wide, wider only where it would be too high."""
    width = 16
    while -(-n_pixels // width) > MOST:
        width *= 2
    if width > MOST:
        raise ValueError("a payload of more than 1 GiB")
    return max(1, -(-n_pixels // width)), width


def store_payloads(payloads: list[bytes]) -> list[bytes]:
    """Lossless WebP files that hold the payloads (of multiples of 64 bytes) as pixels."""
    global _fixed
    fixed = _fixed = _fixed or _Fixed()
    out: list[bytes | None] = [None] * len(payloads)
    big = []
    for i, b in enumerate(payloads):
        h, w = shape_of(len(b) // 4)
        p = np.frombuffer(b.ljust(4 * h * w, b"\0"), "<u4")
        if len(p) <= 64 and len(np.unique(p)) <= 16:
            out[i] = encode(p.reshape(h, w), (PALETTE,))
        else:
            big.append((i, p, h, w))
    if not big:
        return out
    n = np.array([len(p) for _, p, _, _ in big])
    pixel = np.concatenate([p for _, p, _, _ in big])
    lane = np.repeat(np.arange(len(big)), n)
    first = np.zeros(len(pixel), bool)
    first[np.cumsum(n) - n] = True
    # cached: the last pixel of the image in the same slot is equal
    slot = (pixel * np.uint32(CACHE_MULTIPLIER)) >> np.uint32(32 - CACHE_BITS)
    key = (lane << CACHE_BITS) + slot
    order = np.argsort(key, kind="stable")
    same = (key[order][1:] == key[order][:-1]) & (pixel[order][1:] == pixel[order][:-1])
    cached = np.zeros(len(pixel), bool)
    cached[order[1:]] = same
    # runs of equal pixels, from their second on
    repeat = np.concatenate([[False], pixel[1:] == pixel[:-1]]) & ~first
    edge = np.diff(np.concatenate([[0], repeat.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = stop - start >= 4
    start, stop = start[long], stop[long]
    keep = np.ones(len(pixel), bool)
    code = np.zeros(len(pixel), np.uint64)
    size = np.zeros(len(pixel), np.int64)
    literal = np.flatnonzero(~cached)
    v, total = pixel[literal], np.zeros(len(literal), np.int64)
    for k, s in enumerate((8, 16, 0, 24)):
        byte = (v >> np.uint32(s)) & np.uint32(255)
        code[literal] |= fixed.code[k][byte] << total.astype(np.uint64)
        total += fixed.size[k][byte]
    size[literal] = total
    hit = np.flatnonzero(cached)
    code[hit], size[hit] = fixed.code[0][256 + LENGTHS + slot[hit]], fixed.size[0][256 + LENGTHS + slot[hit]]
    for a, b in zip(start.tolist(), stop.tolist(), strict=True):
        keep[a:b] = False
        while a < b:
            run = min(4096, b - a)
            s, extra, bits = prefix_of(run)
            keep[a], code[a], size[a] = True, int(fixed.code[0][256 + s]) | extra << int(fixed.size[0][256 + s]), int(fixed.size[0][256 + s]) + bits
            a += run
    code, size, lane = code[keep], size[keep], lane[keep]
    bits = 40 + fixed.head_bits + np.bincount(lane, weights=size, minlength=len(big)).astype(np.int64)
    length = (bits + 7) // 8
    base = np.concatenate([[0], np.cumsum(length)])
    before = np.cumsum(size) - size
    begin = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]]))
    at = before - before[begin][lane] + (base[:-1] * 8 + 40 + fixed.head_bits)[lane]
    words = np.zeros(int(base[-1]) // 8 + 2, np.uint64)
    word, low = at >> 6, (at & 63).astype(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words[word[starts]] = np.add.reduceat(code << low, starts)
    over = np.flatnonzero((at & 63) + size > 64)
    words[word[over] + 1] |= code[over] >> (np.uint64(64) - low[over])
    raw = words.view(np.uint8)
    heads = np.tile(fixed.head, (len(big), 1))
    raw[(base[:-1] + 5)[:, None] + np.arange(len(fixed.head))] |= heads
    for k, (i, _, h, w) in enumerate(big):
        head = (0x2F | (w - 1) << 8 | (h - 1) << 22 | 1 << 36).to_bytes(5, "little")
        out[i] = riff(head + raw[base[k] + 5 : base[k + 1]].tobytes())
    return out

