"""Words of ASCII letters, digits and everything beyond ASCII, cut from UTF-8 bytes at C speed."""

from __future__ import annotations

from collections.abc import Iterator

_UPPER = range(0x41, 0x5B)


def _table() -> bytes:
    """Separators to a space, A-Z to a-z, all other bytes as they are."""
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if b in _UPPER else b if b in keep else 0x20 for b in range(256))


TABLE = _table()
#: A longer text is cut (at separators) into parts of about this many bytes.
PART_BYTES = 4 << 20


def word_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size (a word is never cut)."""
    if len(raw) <= PART_BYTES:
        yield raw.translate(TABLE).split()
        return
    at, flat = 0, raw.translate(TABLE)
    while at < len(flat):
        end = flat.find(b" ", min(at + PART_BYTES, len(flat)))
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def words(raw: bytes) -> list[bytes]:
    return raw.translate(TABLE).split()
