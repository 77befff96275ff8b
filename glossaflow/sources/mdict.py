"""The MDict container: header, key blocks and record blocks.

Both versions of the layout, both encodings of the header, and the encrypted
key index; every block is checked by its Adler sum. Nothing here opens files:
``read(offset, size)`` is given.
"""

from __future__ import annotations

import bisect
import html
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

Read = Callable[[int, int], bytes]

# Fixed values of the RIPEMD-128 digest.
_RHO = (7, 4, 13, 1, 10, 6, 15, 3, 12, 0, 9, 5, 2, 14, 11, 8)
_SHIFTS = (
    (11, 14, 15, 12, 5, 8, 7, 9, 11, 13, 14, 15, 6, 7, 9, 8), (7, 6, 8, 13, 11, 9, 7, 15, 7, 12, 15, 9, 11, 7, 13, 12),
    (11, 13, 6, 7, 14, 9, 13, 15, 14, 8, 13, 6, 5, 12, 7, 5), (11, 12, 14, 15, 14, 15, 9, 8, 9, 14, 5, 6, 8, 6, 5, 12),
)
_SHIFTS_2 = (
    (8, 9, 9, 11, 13, 15, 15, 5, 7, 7, 8, 11, 14, 14, 12, 6), (9, 13, 15, 7, 12, 8, 9, 11, 7, 7, 12, 7, 6, 15, 13, 11),
    (9, 7, 15, 11, 8, 6, 6, 14, 12, 13, 5, 14, 13, 13, 7, 5), (15, 5, 8, 11, 14, 14, 6, 14, 6, 9, 12, 9, 12, 5, 15, 8),
)
_ADDED, _ADDED_2 = (0, 0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC), (0x50A28BE6, 0x5C4DD124, 0x6D703EF3, 0)
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_MIX = (lambda x, y, z: x ^ y ^ z, lambda x, y, z: (x & y) | (~x & z), lambda x, y, z: (x | ~y) ^ z, lambda x, y, z: (x & z) | (y & ~z))

#: Salt of the key index's key.
_SALT = struct.pack("<I", 0x3695)


def ripemd128(data: bytes) -> bytes:
    """The published 128-bit digest; the standard library lacks it."""
    mask = 0xFFFFFFFF
    turn = lambda x, n: (x << n | x >> 32 - n) & mask
    padded = data + b"\x80" + b"\0" * (-(len(data) + 9) % 64) + struct.pack("<Q", len(data) * 8)
    state = list(_START)
    # Message words by round: powers of rho, on the second line after 9i + 5.
    lines = []
    for first in (list(range(16)), [(9 * i + 5) % 16 for i in range(16)]):
        powers = [list(range(16))]
        for _ in range(3):
            powers.append([_RHO[i] for i in powers[-1]])
        lines.append([[p[i] for i in first] if first[0] else p for p in powers])
    for at in range(0, len(padded), 64):
        words = struct.unpack_from("<16I", padded, at)
        ends = []
        for order, shifts, added, mixes in ((lines[0], _SHIFTS, _ADDED, _MIX), (lines[1], _SHIFTS_2, _ADDED_2, _MIX[::-1])):
            a, b, c, d = state
            for n in range(4):
                for k in range(16):
                    a = turn((a + (mixes[n](b, c, d) & mask) + words[order[n][k]] + added[n]) & mask, shifts[n][k])
                    a, b, c, d = d, a, b, c
            ends.append((a, b, c, d))
        (a, b, c, d), (e, f, g, h) = ends
        state = [(state[1] + c + h) & mask, (state[2] + d + e) & mask, (state[3] + a + f) & mask, (state[0] + b + g) & mask]
    return struct.pack("<4I", *state)


def swap_cipher(data: bytes, key: bytes, decrypt: bool = True) -> bytes:
    """The key index's cipher: nibbles swapped, then mixed with the byte
    before, the place and the key."""
    out, before = bytearray(len(data)), 0x36
    for i, x in enumerate(data):
        mask = before ^ (i & 0xFF) ^ key[i % len(key)]
        if decrypt:
            out[i], before = (x >> 4 | x << 4) & 0xFF ^ mask, x
        else:
            x ^= mask
            out[i] = before = (x >> 4 | x << 4) & 0xFF
    return bytes(out)


def index_key(block: bytes) -> bytes:
    return ripemd128(block[4:8] + _SALT)


def inflate(block: bytes, size: int) -> bytes:
    """A block's content: kind, Adler sum, data."""
    if len(block) < 8:
        raise ValueError("a block is cut off")
    kind, told = block[:4], struct.unpack_from(">I", block, 4)[0]
    if kind == b"\0\0\0\0":
        data = block[8:]
    elif kind == b"\1\0\0\0":
        raise ValueError("LZO compression is not supported")
    elif kind == b"\2\0\0\0":
        try:
            data = zlib.decompress(block[8:])
        except zlib.error as wrong:
            raise ValueError(f"a block cannot be inflated: {wrong}") from None
    else:
        raise ValueError("a block of unknown kind")
    if len(data) != size or zlib.adler32(data) != told:
        raise ValueError("a block's length or sum differs")
    return data


@dataclass
class Container:
    """What the directories of a file say: where its blocks are."""

    encoding: str
    wide: bool  # two bytes a character, and so the end of a key
    number: int  # bytes of a number: 4 in the first version, 8 in the second
    #: Of each key block: entries before it, place, size and inflated size.
    keys: list[tuple[int, int, int, int]] = field(default_factory=list)
    entries: int = 0
    #: Of each record block: inflated bytes before it, place, size, inflated size.
    records: list[tuple[int, int, int, int]] = field(default_factory=list)
    size: int = 0


def header_of(read: Read) -> tuple[dict[str, str], int]:
    """(attributes, where the key section begins)."""
    (size,) = struct.unpack(">I", read(0, 4))
    raw, told = read(4, size), struct.unpack("<I", read(4 + size, 4))[0]
    if zlib.adler32(raw) != told:
        raise ValueError("the header's sum differs")
    text = raw.decode("utf-16-le" if raw[1:2] == b"\0" else "utf-8").rstrip("\0")
    return {k: html.unescape(v) for k, v in re.findall(r'(\w+)="([^"]*)"', text)}, size + 8


def open_container(read: Read) -> Container:
    """The directories of a file; no key or record block is read."""
    facts, at = header_of(read)
    new = float(facts.get("GeneratedByEngineVersion") or 2) >= 2
    told = (facts.get("Encoding") or "UTF-8").upper()
    encoding = {"UTF-16": "utf-16-le", "GBK": "gb18030", "GB2312": "gb18030"}.get(told, told)
    secret = facts.get("Encrypted", "0")
    secret = int(secret) if secret.isdigit() else int(secret == "Yes")
    if secret & 1:
        raise ValueError("the key header is encrypted for one reader")
    box = Container(encoding, encoding == "utf-16-le", 8 if new else 4)
    numbers = lambda n, place: struct.unpack(f">{n}{'Q' if new else 'I'}", read(place, n * box.number))

    count = 5 if new else 4
    found = numbers(count, at)
    if new and zlib.adler32(read(at, count * 8)) != struct.unpack(">I", read(at + count * 8, 4))[0]:
        raise ValueError("the key section's sum differs")
    at += count * box.number + (4 if new else 0)
    blocks, box.entries = found[:2]
    packed, body = found[-2:]
    index = read(at, packed)
    if new:
        if secret & 2:
            index = index[:8] + swap_cipher(index[8:], index_key(index))
        index = inflate(index, found[2])
    at += packed
    before, place = 0, 0
    for _ in range(blocks):
        (n,) = struct.unpack_from(">Q" if new else ">I", index, place)
        place += box.number
        for _ in range(2):  # the block's first and last key
            length = struct.unpack_from(">H" if new else ">B", index, place)[0] + (1 if new else 0)
            place += (2 if new else 1) + length * (2 if box.wide else 1)
        size, whole = struct.unpack_from(">2Q" if new else ">2I", index, place)
        place += 2 * box.number
        box.keys.append((before, at, size, whole))
        before, at = before + n, at + size
    if sum(k[2] for k in box.keys) != body or before != box.entries:
        raise ValueError("the key directory is not of its blocks")

    blocks, _, directory, _ = numbers(4, at)
    at += 4 * box.number
    sizes = numbers(2 * blocks, at)
    at += directory
    for size, whole in zip(sizes[::2], sizes[1::2], strict=True):
        box.records.append((box.size, at, size, whole))
        box.size, at = box.size + whole, at + size
    return box


def keys_of(box: Container, block: int, read: Read) -> list[tuple[int, str]]:
    """(record offset, key) of one key block."""
    _, at, size, whole = box.keys[block]
    data, place, out = inflate(read(at, size), whole), 0, []
    end, step = (b"\0\0", 2) if box.wide else (b"\0", 1)
    while place < len(data):
        offset = int.from_bytes(data[place : place + box.number], "big")
        place += box.number
        stop = data.find(end, place)
        while step == 2 and stop >= 0 and (stop - place) % 2:
            stop = data.find(end, stop + 1)
        if stop < 0:
            raise ValueError("a key is cut off")
        out.append((offset, data[place:stop].decode(box.encoding, "replace")))
        place = stop + step
    return out


def entries_of(box: Container, blocks: range, read: Read, *, drop: bool = False) -> Iterator[tuple[int, str, str]]:
    """(position, key, record) of the entries of some key blocks, in order.

    Only the record blocks that they reach into are inflated, one at a time.
    ``drop`` leaves out what damaged blocks hold; else they are an error.
    """
    found: list[tuple[int, int | None, str]] = []
    for block in range(blocks.start, min(blocks.stop + 1, len(box.keys))):
        try:
            keys: list = keys_of(box, block, read)
        except ValueError:
            if not drop:
                raise
            keys = [(None, "")]  # where its records begin is not known
        # Of the block after the last one only where that begins.
        found += [(box.keys[block][0] + i, offset, key) for i, (offset, key) in enumerate(keys if block in blocks else keys[:1])]
    if blocks.stop >= len(box.keys):
        found.append((box.entries, box.size, ""))
    starts = [r[0] for r in box.records]
    held, data = -1, b""
    for (pos, start, key), (_, end, _) in zip(found, found[1:], strict=False):
        if start is None or end is None or end < start:
            continue
        parts, at = [], start
        try:
            while at < end:
                n = bisect.bisect_right(starts, at) - 1
                before, place, size, whole = box.records[n]
                if n != held:
                    held, data = -1, inflate(read(place, size), whole)
                    held = n
                parts.append(data[at - before : end - before])
                at = before + whole
        except ValueError:
            if not drop:
                raise
            continue
        yield pos, key, b"".join(parts).decode(box.encoding, "replace").strip("\0")
