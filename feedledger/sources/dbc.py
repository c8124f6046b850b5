"""Per-file helpers for compressed fixed-width record files (SRC-4): header parse and
PKWare DCL "implode" decompression of the record body.

File layout: a DBF-style header (32 bytes; record count at 4-7, header length at 8-9, record
length at 10-11, little endian), one 32-byte descriptor per field (name 0-10, type 11, length
16), 0x0D; then 4 filler bytes; then the DCL-compressed records (each: one flag byte plus the
space-padded fields), ending with 0x1A.

These are the small per-row helpers that run inside ``mapInPandas``; Spark does the scan,
the partitioning of files across tasks and all record/field work.
"""

from __future__ import annotations

import hashlib
import json
import struct
from dataclasses import dataclass

# ------------------------------------------------------------------------------ header parse


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    length: int
    decimals: int


@dataclass(frozen=True)
class Header:
    n_records: int
    header_len: int
    record_len: int
    fields: tuple[Field, ...]

    def signature(self) -> str:
        """Stable id of the field layout: files with equal signatures share a schema."""
        return hashlib.sha1(self.fields_json().encode()).hexdigest()[:16]

    def fields_json(self) -> str:
        return json.dumps([[f.name, f.type, f.length, f.decimals] for f in self.fields])


def parse_header(buf: bytes, encoding: str = "iso-8859-1") -> Header:
    if len(buf) < 33:
        raise ValueError("header too short")
    n_records, header_len, record_len = struct.unpack_from("<IHH", buf, 4)
    if header_len < 33 or header_len > len(buf):
        raise ValueError(f"bad header length {header_len}")
    fields = []
    off = 32
    while off + 32 <= header_len and buf[off] != 0x0D:
        d = buf[off:off + 32]
        name = d[0:11].split(b"\x00", 1)[0].decode(encoding).strip()
        fields.append(Field(name, chr(d[11]), d[16], d[17]))
        off += 32
    if not fields:
        raise ValueError("no fields")
    if 1 + sum(f.length for f in fields) != record_len:
        raise ValueError("record length does not match fields")
    return Header(n_records, header_len, record_len, tuple(fields))


# ----------------------------------------------------------------------- DCL explode (decode)

# The format's code-length tables in compact form (each byte: low nibble = code
# length, high nibble + 1 = repeat count), and the length base / extra-bit tables.
LITERAL_LENGTHS = bytes([
    11, 124, 8, 7, 28, 7, 188, 13, 76, 4, 10, 8, 12, 10, 12, 10, 8, 23, 8,
    9, 7, 6, 7, 8, 7, 6, 55, 8, 23, 24, 12, 11, 7, 9, 11, 12, 6, 7, 22, 5,
    7, 24, 6, 11, 9, 6, 7, 22, 7, 11, 38, 7, 9, 8, 25, 11, 8, 11, 9, 12,
    8, 12, 5, 38, 5, 38, 5, 11, 7, 5, 6, 21, 6, 10, 53, 8, 7, 24, 10, 27,
    44, 253, 253, 253, 252, 252, 252, 13, 12, 45, 12, 45, 12, 61, 12, 45,
    44, 173,
])
LENGTH_LENGTHS = bytes([2, 35, 36, 53, 38, 23])
DISTANCE_LENGTHS = bytes([2, 20, 53, 230, 247, 151, 248])
LENGTH_BASE = (3, 2, 4, 5, 6, 7, 8, 9, 10, 12, 16, 24, 40, 72, 136, 264)
LENGTH_EXTRA = (0, 0, 0, 0, 0, 0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8)
END_LENGTH = 519


def _expand(compact: bytes) -> list[int]:
    out = []
    for b in compact:
        out.extend([b & 15] * ((b >> 4) + 1))
    return out


def _codes(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Canonical codes (symbol -> (code, length)), shorter codes first, then by symbol."""
    codes = {}
    code = 0
    for length in range(1, 17):
        for sym, l in enumerate(lengths):
            if l == length:
                codes[sym] = (code, length)
                code += 1
        code <<= 1
    return codes


def kraft_sum(compact: bytes) -> float:
    return sum(2.0 ** -l for l in _expand(compact) if l)


class _Table:
    """Lookup table on the next ``bits`` stream bits (first bit = LSB). Codes are stored with
    their bits inverted, most significant bit first."""

    def __init__(self, compact: bytes):
        codes = _codes(_expand(compact))
        self.bits = max(l for _, l in codes.values())
        size = 1 << self.bits
        self.sym = [0] * size
        self.len = [0] * size
        for sym, (code, length) in codes.items():
            stream = 0
            for i in range(length):
                bit = ((code >> (length - 1 - i)) & 1) ^ 1
                stream |= bit << i
            for high in range(1 << (self.bits - length)):
                idx = stream | (high << length)
                self.sym[idx] = sym
                self.len[idx] = length
        self.codes = codes


_LIT = _LEN = _DIST = None


def _tables():
    global _LIT, _LEN, _DIST
    if _LEN is None:
        _LIT, _LEN, _DIST = _Table(LITERAL_LENGTHS), _Table(LENGTH_LENGTHS), _Table(DISTANCE_LENGTHS)
    return _LIT, _LEN, _DIST


WINDOW = 4096  # the largest back-reference distance of the format
REFILL_BITS = 64  # bits loaded per refill (a symbol needs at most 30)
LITERAL_RUN, LITERAL_BLOCK = 32, 1 << 15  # uncoded literals in a row after which whole blocks are cut out, and the most of a block


def _literal_block(data: bytes, bit: int, most: int) -> bytes:
    """The uncoded literals in a row from a bit position on, at most ``most``: each is a 0 bit and 8 more."""
    import numpy as np

    most = min(most, (8 * len(data) - bit) // 9)
    if most <= 0:
        return b""
    first, last = bit >> 3, (bit + 9 * most + 7) >> 3
    bits = np.unpackbits(np.frombuffer(data, np.uint8, last - first, first), bitorder="little")[bit & 7:][:9 * most].reshape(most, 9)
    ends = np.flatnonzero(bits[:, 0])
    return np.packbits(bits[:ends[0] if len(ends) else most, 1:], axis=1, bitorder="little").tobytes()


def explode(data: bytes, start: int = 0) -> bytes:
    """Decompress a DCL-imploded stream starting at ``data[start]``."""
    return b"".join(explode_chunks(data, start))


def explode_chunks(data: bytes, start: int = 0, chunk: int = 1 << 20):
    """Decompress incrementally: yield output in pieces of about ``chunk`` bytes, keeping only the
    last ``WINDOW`` bytes for back-references, so memory does not grow with the output.

    The bit buffer is refilled in bulk once per symbol (a symbol needs at most 30 bits), so the
    per-symbol work is a few table lookups and shifts."""
    lit_t, len_t, dist_t = _tables()
    if len(data) - start < 2:
        raise ValueError("compressed body too short")
    coded = data[start]
    dict_bits = data[start + 1]
    if coded > 1:
        raise ValueError("bad literal flag")
    if dict_bits not in (4, 5, 6):
        raise ValueError("bad dictionary size")
    pos = start + 2
    end = len(data)
    buf = 0
    cnt = 0
    pad = 0  # zero bits appended past the end of the input
    out = bytearray()
    len_mask, dist_mask, lit_mask = (1 << len_t.bits) - 1, (1 << dist_t.bits) - 1, (1 << lit_t.bits) - 1
    lit_sym, lit_len = lit_t.sym, lit_t.len
    len_sym, len_len = len_t.sym, len_t.len
    dist_sym, dist_len = dist_t.sym, dist_t.len
    low_mask = (1 << dict_bits) - 1
    from_bytes = int.from_bytes
    run, block = 0, LITERAL_RUN  # uncoded literals since the last match; literals to cut out at once
    while True:
        if cnt < 32:
            take = (REFILL_BITS - cnt) >> 3
            piece = data[pos:pos + take]
            pos += len(piece)
            buf |= from_bytes(piece, "little") << cnt
            cnt += 8 * take
            pad += 8 * (take - len(piece))
        if cnt <= pad:
            raise ValueError("compressed body ends early")
        if len(out) >= chunk + WINDOW:
            cut = len(out) - WINDOW
            yield bytes(out[:cut])
            del out[:cut]
        if not buf & 1:
            if coded:
                idx = (buf >> 1) & lit_mask
                out.append(lit_sym[idx])
                used = 1 + lit_len[idx]
            else:
                # a run of uncoded literals: 9 bits each, consumed without re-checking the buffer
                limit = pad + 9
                if cnt < limit:
                    raise ValueError("compressed body ends early")
                if run >= LITERAL_RUN and not pad:
                    cut = _literal_block(data, 8 * pos - cnt, block)
                    out += cut
                    at = 8 * pos - cnt + 9 * len(cut)
                    pos = (at + 7) >> 3
                    cnt = 8 * pos - at
                    buf = data[pos - 1] >> (8 - cnt) if cnt else 0
                    run, block = (run, min(2 * block, LITERAL_BLOCK)) if len(cut) == block else (0, LITERAL_RUN)
                    continue
                held = cnt
                while cnt >= limit and not buf & 1:
                    out.append((buf >> 1) & 0xFF)
                    buf >>= 9
                    cnt -= 9
                run += (held - cnt) // 9
                continue
            buf >>= used
            cnt -= used
            continue
        run, block = 0, LITERAL_RUN
        buf >>= 1
        idx = buf & len_mask
        sym = len_sym[idx]
        used = len_len[idx]
        buf >>= used
        e = LENGTH_EXTRA[sym]
        length = LENGTH_BASE[sym] + (buf & ((1 << e) - 1))
        buf >>= e
        cnt -= 1 + used + e
        if length == END_LENGTH:
            if cnt < pad:
                raise ValueError("compressed body ends early")
            break
        idx = buf & dist_mask
        ds = dist_sym[idx]
        used = dist_len[idx]
        buf >>= used
        if length == 2:
            dist = ((ds << 2) | (buf & 3)) + 1
            buf >>= 2
            cnt -= used + 2
        else:
            dist = ((ds << dict_bits) | (buf & low_mask)) + 1
            buf >>= dict_bits
            cnt -= used + dict_bits
        n = len(out)
        if dist > n:
            raise ValueError("distance too far back")
        src = n - dist
        if dist >= length:
            out += out[src:src + length]
        else:
            for i in range(length):
                out.append(out[src + i])
    if out:
        yield bytes(out)


# --------------------------------------------------------------- DCL implode (fixtures only)


class _BitWriter:
    def __init__(self):
        self.out = bytearray()
        self.acc = 0
        self.n = 0

    def bits(self, value: int, count: int) -> None:
        self.acc |= (value & ((1 << count) - 1)) << self.n
        self.n += count
        while self.n >= 8:
            self.out.append(self.acc & 0xFF)
            self.acc >>= 8
            self.n -= 8

    def code(self, code: int, length: int) -> None:
        for i in range(length):
            self.bits(((code >> (length - 1 - i)) & 1) ^ 1, 1)

    def done(self) -> bytes:
        if self.n:
            self.out.append(self.acc & 0xFF)
        return bytes(self.out)


def _implode_literals(data: bytes, dict_bits: int) -> bytes:
    """Literal-only stream, built with numpy: each byte becomes a 0 flag bit plus its 8 bits."""
    import numpy as np

    _, len_t, _ = _tables()
    arr = np.frombuffer(data, dtype=np.uint8)
    bits = np.zeros((len(arr), 9), dtype=np.uint8)
    bits[:, 1:] = np.unpackbits(arr[:, None], axis=1, bitorder="little")
    w = _BitWriter()
    code, length = len_t.codes[15]
    tail = [1] + [((code >> (length - 1 - i)) & 1) ^ 1 for i in range(length)] + [1] * 8  # end code: 264 + 255
    stream = np.concatenate([bits.reshape(-1), np.array(tail, dtype=np.uint8)])
    return bytes([0, dict_bits]) + np.packbits(stream, bitorder="little").tobytes()


def implode(data: bytes, dict_bits: int = 6, matches: bool = True, coded: bool = False) -> bytes:
    """Minimal DCL encoder used to build fixtures: greedy matches, literals uncoded or coded with
    the format's literal table; ``matches=False, coded=False`` takes a vectorised fast path."""
    if not matches and not coded:
        return _implode_literals(data, dict_bits)
    lit_t, len_t, dist_t = _tables()
    w = _BitWriter()
    out = bytearray([1 if coded else 0, dict_bits])
    window = 1 << (dict_bits + 6)
    last: dict[bytes, int] = {}
    i = 0
    n = len(data)

    def put_length(length: int) -> None:
        for s in range(15, -1, -1):
            if LENGTH_BASE[s] <= length < LENGTH_BASE[s] + (1 << LENGTH_EXTRA[s]):
                w.bits(1, 1)
                w.code(*len_t.codes[s])
                if LENGTH_EXTRA[s]:
                    w.bits(length - LENGTH_BASE[s], LENGTH_EXTRA[s])
                return
        raise ValueError(length)

    while i < n:
        best_len = 0
        best_dist = 0
        if matches and i + 3 <= n:
            j = last.get(data[i:i + 3])
            if j is not None and i - j <= window:
                length = 0
                while i + length < n and length < 518 and data[j + length] == data[i + length]:
                    length += 1
                if length >= 3:
                    best_len, best_dist = length, i - j
        if best_len:
            put_length(best_len)
            d = best_dist - 1
            w.code(*dist_t.codes[d >> dict_bits])
            w.bits(d & ((1 << dict_bits) - 1), dict_bits)
            for k in range(i, i + best_len):
                if k + 3 <= n:
                    last[data[k:k + 3]] = k
            i += best_len
        else:
            if i + 3 <= n:
                last[data[i:i + 3]] = i
            w.bits(0, 1)
            if coded:
                w.code(*lit_t.codes[data[i]])
            else:
                w.bits(data[i], 8)
            i += 1
    put_length(END_LENGTH)
    return bytes(out) + w.done()


def build_dbf(fields: list[tuple[str, str, int]], records: list[list[str]], encoding: str = "iso-8859-1",
              deleted: set[int] | None = None) -> bytes:
    """Uncompressed DBF bytes (fixtures)."""
    record_len = 1 + sum(f[2] for f in fields)
    header_len = 32 + 32 * len(fields) + 1
    head = bytearray(32)
    head[0] = 0x03
    struct.pack_into("<IHH", head, 4, len(records), header_len, record_len)
    desc = bytearray()
    for name, typ, length in fields:
        d = bytearray(32)
        nb = name.encode(encoding)[:11]
        d[0:len(nb)] = nb
        d[11] = ord(typ)
        d[16] = length
        desc += d
    body = bytearray()
    for i, rec in enumerate(records):
        body.append(ord("*") if deleted and i in deleted else ord(" "))
        for (name, typ, length), value in zip(fields, rec):
            v = value.encode(encoding)
            if len(v) > length:
                raise ValueError(f"field {name}: {len(v)} bytes do not fit a width of {length}")
            body += v + b" " * (length - len(v))
    return bytes(head + desc + b"\x0d" + body + b"\x1a")


def build_dbc(fields: list[tuple[str, str, int]], records: list[list[str]], encoding: str = "iso-8859-1",
              deleted: set[int] | None = None, dict_bits: int = 6, matches: bool = True, coded: bool = False) -> bytes:
    """Compressed file bytes: header, 4 filler bytes, imploded records (fixtures)."""
    dbf = build_dbf(fields, records, encoding, deleted)
    header_len = struct.unpack_from("<H", dbf, 8)[0]
    return dbf[:header_len] + b"\x00\x00\x00\x00" + implode(dbf[header_len:], dict_bits, matches, coded)
