"""Progressive JPEG in numpy: a decoder for spectral selection and successive approximation,
and a writer that keeps any payload in the coefficients without loss.

The decoder accumulates scans into one coefficient array for each component and
handles any Huffman tables, sampling factors, restart intervals and scan scripts of
pictures with one or three components. Scans whose symbols all have one length are
read as arrays; the rest bit by bit. Anything else, and any damage that shows, is a
ValueError.

The writer puts 64 payload bytes into each 8 x 8 block. Byte 0 is the DC coefficient.
Each other byte is an AC coefficient whose sign and magnitude bits are that byte (128
to 255: itself; below: itself less 255), so a first scan at point transform 1 takes
one byte for each coefficient and the refinement scan adds the last bit.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BLOCK = 64
#: MCU of the writer: four luma blocks, one of each chroma component (2 x 2 sampling).
MCU_BLOCKS, MAX_MCU_SIDE = 6, 4095
#: MCUs that are transformed to pixels at once.
STRIP_MCUS = 1024


def _zigzag() -> np.ndarray:
    """Row-major place of each coefficient in scan order: along anti-diagonals, in turns."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([r * 8 + c for r, c in cells])


ZIGZAG = _zigzag()


def _basis() -> np.ndarray:
    """Pixels (64) that each coefficient in scan order adds to its block."""
    n = np.arange(8)
    one = np.cos((2 * n[None, :] + 1) * n[:, None] * np.pi / 16) / 2
    one[0] /= np.sqrt(2)
    return np.einsum("uy,vx->uvyx", one, one).reshape(64, 64)[ZIGZAG]


BASIS = _basis()


# --- Huffman tables ---------------------------------------------------------------


@lru_cache(maxsize=256)
def _lookup(counts: bytes, symbols: bytes) -> tuple[list[int], list[int]]:
    """For each 16 bits ahead: the symbol and the length of its code (0: no code)."""
    sym, length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    code, k = 0, 0
    for bits, n in enumerate(counts, 1):
        for _ in range(n):
            lo = code << (16 - bits)
            hi = lo + (1 << (16 - bits))
            sym[lo:hi], length[lo:hi] = symbols[k], bits
            code, k = code + 1, k + 1
        code <<= 1
    return sym.tolist(), length.tolist()


def _windows(data: bytes) -> list[int]:
    """The 16 bits from each bit position on; ones follow the end."""
    b = np.frombuffer(data + b"\xff" * 6, np.uint8).astype(np.uint32)
    wide = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((wide[:, None] >> (8 - np.arange(8, dtype=np.uint32))) & 0xFFFF).ravel().tolist()


# --- Decoding ---------------------------------------------------------------------


def _clipped(x: np.ndarray) -> np.ndarray:
    """x rounded and held to 0..255, in place."""
    np.rint(x, out=x)
    np.maximum(x, 0, out=x)
    return np.minimum(x, 255, out=x)


@lru_cache(maxsize=256)
def _quantisers(body: bytes) -> dict[int, np.ndarray]:
    out = {}
    while body:
        wide, k = body[0] >> 4, body[0] & 15
        out[k] = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8).astype(np.int32)
        body = body[1 + 64 * (1 + wide) :]
    return out


@lru_cache(maxsize=256)
def _huffman(body: bytes) -> dict[int, tuple[bytes, bytes]]:
    out = {}
    while body:
        n = sum(body[1:17])
        out[body[0]] = (body[1:17], body[17 : 17 + n])
        body = body[17 + n :]
    return out


@dataclass
class Component:
    ident: int
    h: int
    v: int
    tq: int
    across: int = 0  # blocks that a scan of this component alone has in a row
    down: int = 0
    coef: np.ndarray | None = None  # blocks down, blocks across, 64; padded to whole MCUs


@dataclass
class Image:
    width: int
    height: int
    comps: list[Component]
    tables: dict[int, np.ndarray]
    comment: bytes = b""

    def planes(self, mcus: int = STRIP_MCUS) -> Iterator[list[np.ndarray]]:
        """Red, green and blue of whole MCU rows at a time, chroma upsampled to full resolution; whole numbers."""
        hmax, vmax = max(c.h for c in self.comps), max(c.v for c in self.comps)
        rows, across = -(-self.height // (8 * vmax)), -(-self.width // (8 * hmax))
        step = max(1, mcus // across)
        for top in range(0, rows, step):
            planes = []
            for c in self.comps:
                part = c.coef[top * c.v : min(rows, top + step) * c.v]
                pixels = _clipped((part.reshape(-1, 64) * self.tables[c.tq]).astype(np.float64) @ BASIS + 128)
                plane = pixels.reshape(part.shape[0], part.shape[1], 8, 8).transpose(0, 2, 1, 3).reshape(part.shape[0] * 8, -1)
                if c.v < vmax:
                    plane = plane.repeat(vmax // c.v, 0)
                planes.append(plane.repeat(hmax // c.h, 1) if c.h < hmax else plane)
            if len(planes) == 1:
                rgb = planes * 3
            else:
                y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
                rgb = [_clipped(y + 1.402 * cr), _clipped(y - (0.344136 * cb + 0.714136 * cr)), _clipped(y + 1.772 * cb)]
            end = min(self.height, (top + step) * 8 * vmax) - top * 8 * vmax
            yield [x[:end, : self.width] for x in rgb]

    def rgb(self) -> np.ndarray:
        """The whole picture: height x width x 3 bytes."""
        return np.concatenate([np.stack(x, -1).astype(np.uint8) for x in self.planes()])


def _frame(body: bytes, tables: dict[int, np.ndarray], room: int) -> Image:
    """The empty picture that a frame header announces; room: blocks that the data can hold at most."""
    if len(body) < 6 or len(body) != 6 + 3 * body[5]:
        raise ValueError("damaged frame")
    bits, height, width, n = struct.unpack(">BHHB", body[:6])
    comps = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
    if bits != 8 or not height or not width or n not in (1, 3) or len({c.ident for c in comps}) < n or not all(1 <= x <= 4 for c in comps for x in (c.h, c.v)):
        raise ValueError("a frame of another kind, or a damaged one")
    hmax, vmax = max(c.h for c in comps), max(c.v for c in comps)
    if any(hmax % c.h or vmax % c.v for c in comps):
        raise ValueError("chroma is not an even part of the picture")
    mx, my = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    if mx * my * sum(c.h * c.v for c in comps) > room:
        raise ValueError("the frame is larger than its data")
    for c in comps:
        c.across, c.down = -(-(-(-width * c.h // hmax)) // 8), -(-(-(-height * c.v // vmax)) // 8)
        c.coef = np.zeros((my * c.v, mx * c.h, 64), np.int32)
    return Image(width, height, comps, tables)


def _scan_end(data: bytes, at: int) -> tuple[int, list[bytes]]:
    """Where the next marker ends the scan that starts at at, and the scan's data between restart markers; 00 after FF is data."""
    parts, begin, end = [], at, at
    while True:
        end = data.find(b"\xff", end)
        if end < 0 or end + 1 >= len(data):
            end = len(data)
            break
        if 0xD0 <= data[end + 1] <= 0xD7:
            parts.append(data[begin:end])
            begin = end + 2
        elif data[end + 1]:
            break
        end += 2
    return end, [p.replace(b"\xff\x00", b"\xff") for p in (*parts, data[begin:end])]


def decode(data: bytes, plain: bool = False) -> Image:
    """Reads a progressive JPEG. plain: take no short ways, for tests."""
    try:
        return _decode(data, plain)
    except (IndexError, KeyError, OverflowError) as e:  # a table or bits that are not there
        raise ValueError("damaged picture") from e


def _decode(data: bytes, plain: bool) -> Image:
    image, tables, huff, at, interval = None, {}, {}, 2, 0
    comment = b""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("no marker where one must be")
        marker, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        if marker == 0xFF:  # fill
            at += 1
            continue
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if size < 2 or at > len(data):
            raise ValueError("a cut segment")
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            tables |= _quantisers(body)
        elif marker == 0xC4:
            huff |= _huffman(body)
        elif marker == 0xC2:
            if image is not None:
                raise ValueError("a second frame")
            image = _frame(body, tables, 8 * len(data))
        elif marker in (0xC0, 0xC1, 0xC3) or 0xC5 <= marker <= 0xCF:
            raise ValueError("not a progressive Huffman JPEG")
        elif marker == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            at, parts = _scan_end(data, at)
            if image is None or not body or len(body) != 4 + 2 * body[0]:
                raise ValueError("a scan without a frame, or a damaged one")
            n = body[0]
            own = {c.ident: c for c in image.comps}
            chosen = [(own[body[1 + 2 * i]], body[2 + 2 * i]) for i in range(n)]
            ss, se, approx = body[1 + 2 * n : 4 + 2 * n]
            if not (0 <= ss <= se < 64) or not n or (ss == 0) != (se == 0) or ss and n > 1 or approx & 15 > 13:
                raise ValueError("a scan of another kind, or a damaged one")
            if len(parts) > 1 and not interval:
                raise ValueError("restart markers without an interval")
            _scan(chosen, huff, ss, se, approx >> 4, approx & 15, parts, interval, plain)
            if data[at : at + 2] == b"\xff\xd9":
                break
    if image is None or any(c.tq not in tables for c in image.comps):
        raise ValueError("no frame, or no quantisers for it")
    image.comment = comment
    return image


def _runs(n: int, parts: list[bytes], interval: int) -> Iterator[tuple[int, int, bytes]]:
    """From which MCU to which each part of a scan's data reaches."""
    step = interval or n
    if len(parts) != max(1, -(-n // step)):
        raise ValueError("restart markers are missing")
    return ((k * step, min(n, (k + 1) * step), p) for k, p in enumerate(parts))


def _scan(chosen: list, huff: dict, ss: int, se: int, high: int, low: int, parts: list[bytes], interval: int, plain: bool) -> None:
    if ss == 0:
        _dc(chosen, huff, high, low, parts, interval)
        return
    c, table = chosen[0][0], huff[0x10 | chosen[0][1] & 15]
    own = c.coef[: c.down, : c.across]
    every = own.reshape(-1, 64)  # a copy where the MCUs are padded
    for begin, end, data in _runs(len(every), parts, interval):
        blocks = every[begin:end]
        if high:
            if plain or not _refine_at_once(blocks, table, ss, se, low, data):
                _refine(blocks, table, ss, se, low, _windows(data))
        elif plain or not _first_at_once(blocks, table, ss, se, low, data):
            _first(blocks, table, ss, se, low, _windows(data))
    own[...] = every.reshape(own.shape)


def _dc(chosen: list, huff: dict, high: int, low: int, parts: list[bytes], interval: int) -> None:
    if len(chosen) == 1:
        c = chosen[0][0]
        views, together = [c.coef[: c.down, : c.across, 0]], False
        cells = [views[0].reshape(-1, 1)]
    else:  # MCUs: of each component in turn v x h blocks
        views, together = [c.coef[..., 0] for c, _ in chosen], True
        cells = [v.reshape(v.shape[0] // c.v, c.v, v.shape[1] // c.h, c.h).transpose(0, 2, 1, 3).reshape(-1, c.v * c.h) for v, (c, _) in zip(views, chosen)]
    widths = [x.shape[1] for x in cells]
    every = np.concatenate(cells, 1)
    which = [k for k, w in enumerate(widths) for _ in range(w)]
    for begin, end, data in _runs(len(every), parts, interval):
        whole = every[begin:end]
        if high:
            bits = np.unpackbits(np.frombuffer(data, np.uint8))[: whole.size].reshape(whole.shape)
            whole |= bits.astype(np.int32) << low
            continue
        win, pos, out = _windows(data), 0, []
        look = [_lookup(*huff[t >> 4]) for _, t in chosen]
        plan, last = [(k, *look[k]) for k in which], [0] * len(chosen)
        for _ in range(len(whole)):
            for k, sym, length in plan:
                w = win[pos]
                s = sym[w]
                pos += length[w]
                if s:
                    v = win[pos] >> (16 - s)
                    pos += s
                    last[k] += v if v >> (s - 1) else v - (1 << s) + 1
                out.append(last[k])
        whole[...] = np.array(out, np.int32).reshape(whole.shape) << low
    at = 0
    for view, (c, _), w in zip(views, chosen, widths):
        part, shape = every[:, at : at + w], view.shape
        at += w
        view[...] = part.reshape(shape[0] // c.v, shape[1] // c.h, c.v, c.h).transpose(0, 2, 1, 3).reshape(shape) if together else part.reshape(shape)


#: What seven bits after a code stand for.
_SEVEN = np.array([v if v >= 64 else v - 127 for v in range(128)], np.int32)


def _first_at_once(blocks: np.ndarray, table: tuple, ss: int, se: int, low: int, data: bytes) -> bool:
    """Where code 0 means seven bits and no zeros before, a byte with its top bit clear is one coefficient."""
    n = len(blocks) * (se - ss + 1)
    if not (table[0][0] == 1 and table[1][0] == 0x07 and len(data) >= n):
        return False
    v = np.frombuffer(data, np.uint8, n)
    if v.max() > 127:
        return False
    blocks[:, ss : se + 1] = (_SEVEN << low)[v].reshape(len(blocks), -1)
    return True


def _refine_at_once(blocks: np.ndarray, table: tuple, ss: int, se: int, low: int, data: bytes) -> bool:
    """Where no coefficient is zero, runs of blocks hold one correction bit for each."""
    band = blocks[:, ss : se + 1]
    if not band.all():
        return False
    (sym, length), bits = _lookup(*table), np.unpackbits(np.frombuffer(data, np.uint8))
    pos, at, width = 0, 0, se - ss + 1
    got = np.empty(band.shape, np.int32) if len(blocks) > 1 << 14 else None
    while at < len(blocks):
        ahead = int.from_bytes(np.packbits(bits[pos : pos + 32]).tobytes().ljust(4, b"\xff"))
        s, n = sym[ahead >> 16], length[ahead >> 16]
        r = s >> 4
        if s & 15 or r == 15 or not n:
            return False
        run = (1 << r) + (ahead >> (32 - n - r) & (1 << r) - 1)
        pos += n + r
        run = min(run, len(blocks) - at)
        if got is None and run == len(blocks):
            got = bits[pos : pos + run * width].reshape(run, width).astype(np.int32)
            break
        got = np.empty(band.shape, np.int32) if got is None else got
        got[at : at + run] = bits[pos : pos + run * width].reshape(run, width)
        pos, at = pos + run * width, at + run
    got <<= low
    band += np.where(band > 0, got, -got)
    return True


def _first(blocks: np.ndarray, table: tuple, ss: int, se: int, low: int, win: list[int]) -> None:
    sym, length = _lookup(*table)
    pos, run, n = 0, 0, 0
    while n < len(blocks):
        if run:
            n, run = n + run, 0
            continue
        k, own = ss, blocks[n]
        while k <= se:
            w = win[pos]
            if not length[w]:
                raise ValueError("damaged scan")
            pos += length[w]
            r, s = sym[w] >> 4, sym[w] & 15
            if s:
                k += r
                v = win[pos] >> (16 - s)
                pos += s
                own[k] = (v if v >> (s - 1) else v - (1 << s) + 1) * (1 << low)
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) - 1 + (win[pos] >> (16 - r) if r else 0)
                pos += r
                break
        n += 1


def _refine(blocks: np.ndarray, table: tuple, ss: int, se: int, low: int, win: list[int]) -> None:
    sym, length = _lookup(*table)
    pos, run, step = 0, 0, 1 << low

    for own in blocks:
        k = ss
        if not run:
            while k <= se:
                w = win[pos]
                if not length[w]:
                    raise ValueError("damaged scan")
                pos += length[w]
                r, s = sym[w] >> 4, sym[w] & 15
                new = 0
                if s:
                    new = step if win[pos] >> 15 else -step
                    pos += 1
                elif r < 15:
                    run = (1 << r) + (win[pos] >> (16 - r) if r else 0)
                    pos += r
                    break
                while k <= se:  # pass r zeros; what is not zero takes a correction bit
                    if own[k]:
                        if win[pos] >> 15:
                            own[k] += step if own[k] > 0 else -step
                        pos += 1
                    elif r == 0:
                        if new:
                            own[k] = new
                        k += 1
                        break
                    else:
                        r -= 1
                    k += 1
        if run:
            for k in range(k, se + 1):
                if own[k]:
                    if win[pos] >> 15:
                        own[k] += step if own[k] > 0 else -step
                    pos += 1
            run -= 1


# --- Writing payloads -------------------------------------------------------------

#: Twelve DC categories of four bits; AC: code 0 is seven bits with no zeros before, then fifteen end-of-band runs.
_DC_TABLE = (bytes([0, 0, 0, 12] + [0] * 12), bytes(range(12)))
_AC_TABLE = (bytes([1, 0, 0, 0, 15] + [0] * 11), bytes([0x07, *(r << 4 for r in range(15))]))
_MAX_RUN = 32767


def _dc_codes() -> tuple[np.ndarray, np.ndarray]:
    """For each difference from -128 on: its code's bits, category (four bits) and value, and which of 16 are used."""
    bits, used = np.zeros((257, 16), np.uint8), np.zeros((257, 16), bool)
    for d in range(-128, 129):
        n = abs(d).bit_length()
        text = f"{n:04b}" + (f"{d if d >= 0 else d + (1 << n) - 1:0{n}b}" if n else "")
        bits[d + 128, : len(text)], used[d + 128, : len(text)] = [int(x) for x in text], True
    return bits, used


_DC_BITS, _DC_USED = _dc_codes()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_TABLES = _segment(0xDB, b"\0" + b"\x01" * 64) + _segment(0xC4, b"\x00" + b"".join(_DC_TABLE) + b"\x10" + b"".join(_AC_TABLE))


def _scan_head(comps: list[int], ss: int, se: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(comps), *(x for c in comps for x in (c, 0)), ss, se, high << 4 | low]))


def _packed(bits: np.ndarray) -> bytes:
    """Whole bytes, filled up with ones, FF followed by 00."""
    out = bytearray(np.packbits(bits))
    if len(bits) % 8:
        out[-1] |= 0xFF >> len(bits) % 8
    return bytes(out).replace(b"\xff", b"\xff\x00")


def _dc_first(values: np.ndarray) -> bytes:
    """values: MCUs x 6, already shifted; each component follows its own last value."""
    diff = values.copy()
    diff[:, 1:4] -= values[:, 0:3]
    diff[1:, 0] -= values[:-1, 3]
    diff[1:, 4:] -= values[:-1, 4:]
    d = diff.ravel() + 128
    return _packed(_DC_BITS[d][_DC_USED[d]])


def _ac_refine(bits: np.ndarray) -> bytes:
    parts = []
    for at in range(0, len(bits), _MAX_RUN):
        own = bits[at : at + _MAX_RUN]
        r = len(own).bit_length() - 1
        head = f"1{r:04b}" + (f"{len(own) - (1 << r):0{r}b}" if r else "")
        parts += [np.frombuffer(head.encode(), np.uint8) - 48, own.ravel()]
    return _packed(np.concatenate(parts))


def encode_payload(payload: bytes, comment: bytes) -> bytes:
    """A progressive 4:2:0 JPEG whose coefficients hold payload (a positive multiple of 64 bytes)."""
    n = len(payload) // BLOCK
    if not n or len(payload) % BLOCK:
        raise ValueError("a payload is a positive multiple of 64 bytes")
    mcus = -(-n // MCU_BLOCKS)
    across = -(-mcus // MAX_MCU_SIDE)
    down = -(-mcus // across)
    if across > MAX_MCU_SIDE:
        raise ValueError("the payload is too large for one picture")
    cells = np.zeros((down * across * MCU_BLOCKS, BLOCK), np.uint8)
    cells[:n] = np.frombuffer(payload, np.uint8).reshape(n, BLOCK)
    cells = cells.reshape(down, across, MCU_BLOCKS, BLOCK)
    luma = cells[:, :, :4].reshape(down, across, 2, 2, BLOCK).transpose(0, 2, 1, 3, 4).reshape(-1, BLOCK)
    cb, cr = cells[:, :, 4].reshape(-1, BLOCK), cells[:, :, 5].reshape(-1, BLOCK)
    dc = cells[..., 0].reshape(-1, MCU_BLOCKS)
    # A magnitude's last bit: the byte's own, or its complement below 128. Without it, seven bits of the code are left.
    seven = [c[:, 1:] >> 1 for c in (luma, cb, cr)]
    last = [(c[:, 1:] & 1) ^ (c[:, 1:] < 128) for c in (luma, cb, cr)]
    out = [b"\xff\xd8", _segment(0xFE, comment), _TABLES]
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, down * 16, across * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])))
    scans = [_dc_first(dc.astype(np.int32) >> 1), seven[0][:, :5].tobytes(), seven[1].tobytes(), seven[2].tobytes(), seven[0][:, 5:].tobytes()]
    scans += [_packed((dc & 1).ravel()), *(_ac_refine(last[k]) for k in (1, 2, 0))]
    return b"".join([*out, *(x for pair in zip(_HEADS, scans) for x in pair), b"\xff\xd9"])


#: The writer's scans: DC, luma's low band, chroma, luma's high band, then what refines them.
_HEADS = [
    _scan_head([1, 2, 3], 0, 0, 0, 1),
    _scan_head([1], 1, 5, 0, 1),
    _scan_head([2], 1, 63, 0, 1),
    _scan_head([3], 1, 63, 0, 1),
    _scan_head([1], 6, 63, 0, 1),
    _scan_head([1, 2, 3], 0, 0, 1, 0),
    _scan_head([2], 1, 63, 1, 0),
    _scan_head([3], 1, 63, 1, 0),
    _scan_head([1], 1, 63, 1, 0),
]


def payload_of(image: Image, size: int) -> bytes:
    """The first size bytes of what encode_payload() put into the coefficients."""
    y, cb, cr = (c.coef for c in image.comps)
    down, across = cb.shape[:2]
    cells = np.empty((down, across, MCU_BLOCKS, BLOCK), np.int32)
    cells[:, :, :4] = y.reshape(down, 2, across, 2, BLOCK).transpose(0, 2, 1, 3, 4).reshape(down, across, 4, BLOCK)
    cells[:, :, 4], cells[:, :, 5] = cb, cr
    ac = cells[..., 1:]
    ac[ac < 0] += 255
    return cells.astype(np.uint8).tobytes()[:size]


def noted(comment: bytes) -> dict[str, int]:
    """Numbers noted as name=value in a comment."""
    return {k: int(v) for k, v in re.findall(r"(\w+)=(\d+)", comment.decode("latin-1"))}
