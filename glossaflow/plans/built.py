"""Dictionary files built of entries, for queries over tables and for tests.

The library reads these formats; it writes them here only, from the formats'
descriptions and not from the readers.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Sequence

from glossaflow.sources.mdict import index_key, swap_cipher

Entry = tuple[str, str]


def _block(data: bytes, packed: bool = True) -> bytes:
    return (b"\2\0\0\0" if packed else b"\0\0\0\0") + struct.pack(">I", zlib.adler32(data)) + (zlib.compress(data) if packed else data)


def _cut(sizes: Sequence[int], most: int) -> list[int]:
    """Where blocks of about ``most`` bytes begin and end."""
    edges, held = [0], 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            edges.append(i)
            held = 0
        held += size
    return [*edges, len(sizes)] if sizes else [0]


def mdx(entries: Sequence[Entry], *, new: bool = True, wide: bool = False, secret: bool = False, header: str = "utf-16-le", block: int = 4096, packed: bool = True) -> bytes:
    """An MDict file of either version; ``wide`` has two-byte characters."""
    encoding, end = ("utf-16-le", b"\0\0") if wide else ("utf-8", b"\0")
    number = lambda *n: struct.pack(f">{len(n)}{'Q' if new else 'I'}", *n)
    facts = f'<Dictionary GeneratedByEngineVersion="{2.0 if new else 1.2}" Encrypted="{2 if secret else "No"}" Encoding="{"UTF-16" if wide else "UTF-8"}" Title="a &quot;b&quot;"/>\r\n\0'.encode(header)
    out = [struct.pack(">I", len(facts)), facts, struct.pack("<I", zlib.adler32(facts))]

    bodies = [definition.encode(encoding) + end for _, definition in entries]
    offsets = [0]
    for body in bodies:
        offsets.append(offsets[-1] + len(body))
    keys = [number(offset) + word.encode(encoding) + end for (word, _), offset in zip(entries, offsets, strict=False)]

    index, blocks = [], []
    edges = _cut([len(k) for k in keys], block)
    for a, b in zip(edges, edges[1:], strict=False):
        data = b"".join(keys[a:b])
        blocks.append(_block(data, packed))
        index.append(number(b - a))
        for word, _ in (entries[a], entries[b - 1]):
            length = len(word.encode(encoding)) // (2 if wide else 1)
            index.append(struct.pack(">H" if new else ">B", length if new else min(length, 255)) + word.encode(encoding)[: None if new else 255 * (2 if wide else 1)] + (end if new else b""))
        index.append(number(len(blocks[-1]), len(data)))
    listed = b"".join(index)
    if new:
        directory = _block(listed)
        if secret:
            directory = directory[:8] + swap_cipher(directory[8:], index_key(directory), decrypt=False)
        head = number(len(blocks), len(entries), len(listed), len(directory), sum(map(len, blocks)))
        out += [head, struct.pack(">I", zlib.adler32(head)), directory]
    else:
        out += [number(len(blocks), len(entries), len(listed), sum(map(len, blocks))), listed]
    out += blocks

    records, sizes = [], []
    whole = b"".join(bodies)
    # Record blocks are cut anywhere, also within a record.
    for at in range(0, len(whole), block):
        data = whole[at : at + block]
        records.append(_block(data, packed))
        sizes += [len(records[-1]), len(data)]
    out += [number(len(records), len(entries), len(number(*sizes)), sum(map(len, records))), number(*sizes), *records]
    return b"".join(out)


def dictzip(data: bytes, chunk: int = 4096) -> bytes:
    """A gzip file with a table of chunks that can be inflated by themselves."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    chunks = [packer.compress(data[at : at + chunk]) + packer.flush(zlib.Z_FULL_FLUSH) for at in range(0, len(data), chunk)]
    table = struct.pack("<3H", 1, chunk, len(chunks)) + b"".join(struct.pack("<H", len(c)) for c in chunks)
    extra = b"RA" + struct.pack("<H", len(table)) + table
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\3" + struct.pack("<H", len(extra)) + extra + b"".join(chunks) + packer.flush() + struct.pack("<2I", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def stardict(entries: Sequence[Entry], kind: str = "m", *, wide: bool = False) -> tuple[bytes, bytes, bytes]:
    """(ifo, idx, dict) of a StarDict dictionary; ``wide`` has 64-bit offsets."""
    idx, data, at = [], [], 0
    for word, definition in entries:
        body = definition.encode()
        idx.append(word.encode() + b"\0" + struct.pack(">QI" if wide else ">II", at, len(body)))
        data.append(body)
        at += len(body)
    facts = f"StarDict's dict ifo file\nversion=2.4.2\n{'idxoffsetbits=64' + chr(10) if wide else ''}sametypesequence={kind}\n"
    return facts.encode(), b"".join(idx), b"".join(data)


def zipped(members: Sequence[tuple[str, bytes]], *, locked: Sequence[str] = (), broken: Sequence[str] = (), stored: bool = False) -> bytes:
    """A ZIP archive; ``locked`` members say that they are encrypted, ``broken``
    ones have another checksum than their bytes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as archive:
        for name, content in members:
            archive.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED)
        for info in archive.infolist():
            # Only the directory is written from here on.
            info.flag_bits |= info.filename in locked
            info.CRC ^= info.filename in broken
    return out.getvalue()
