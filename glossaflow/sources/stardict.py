"""StarDict dictionaries in parts: index, random access to data, synonyms.

Nothing here opens files: ``read(offset, size)`` is given, shorter at the end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

Read = Callable[[int, int], bytes]

CHUNK = 1 << 20


def facts_of(ifo: bytes) -> dict[str, str]:
    """The ``key=value`` lines of an ``.ifo`` file."""
    pairs = (line.split("=", 1) for line in ifo.decode("utf-8", "replace").splitlines() if "=" in line)
    return {k.strip(): v.strip() for k, v in pairs}


def records(read: Read, width: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(place, word, rest) of records of a word, a zero byte and ``width``
    bytes, read a chunk at a time; a cut-off tail ends them."""
    place, held, more = 0, b"", True
    while more:
        data = read(place + len(held), CHUNK)
        more, held, at = len(data) > 0, held + data, 0
        while (end := held.find(b"\0", at)) >= 0 and end + 1 + width <= len(held):
            yield place + at, held[at:end], held[end + 1 : end + 1 + width]
            at = end + 1 + width
        place, held = place + at, held[at:]


def index(read: Read, bits: int = 32) -> Iterator[tuple[int, str, int, int]]:
    """(place, word, offset, size) of an ``.idx`` file."""
    form = ">QI" if bits == 64 else ">II"
    for place, word, rest in records(read, struct.calcsize(form)):
        yield place, word.decode("utf-8", "replace"), *struct.unpack(form, rest)


def synonyms(read: Read) -> Iterator[tuple[int, str, int]]:
    """(place, word, entry) of a ``.syn`` file."""
    for place, word, rest in records(read, 4):
        yield place, word.decode("utf-8", "replace"), struct.unpack(">I", rest)[0]


class DictZip:
    """Slices of a gzip file. With a chunk table only the chunks that a slice
    reaches into are inflated, and one is kept; without one the stream is
    followed, from its start again for a slice further back."""

    def __init__(self, read: Read):
        self.read, self.held, self.data = read, -1, b""
        head = read(0, 12)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("no gzip file")
        self.sizes: list[int] = []
        at = 10
        if head[3] & 4:
            (length,) = struct.unpack_from("<H", head, 10)
            extra, at, place = read(12, length), 12 + length, 0
            while place + 4 <= len(extra):
                kind, (size,) = extra[place : place + 2], struct.unpack_from("<H", extra, place + 2)
                if kind == b"RA":
                    _, self.chunk, count = struct.unpack_from("<3H", extra, place + 4)
                    self.sizes = list(struct.unpack_from(f"<{count}H", extra, place + 10))
                place += 4 + size
        for flag in (8, 16):  # name and comment
            if head[3] & flag:
                while (found := (data := read(at, 4096)).find(b"\0")) < 0 and data:
                    at += len(data)
                at += found + 1
        self.start = at + (2 if head[3] & 2 else 0)
        self.places = [self.start]
        for size in self.sizes:
            self.places.append(self.places[-1] + size)
        self._rewind()

    def _rewind(self) -> None:
        self.stream, self.at, self.done, self.window = zlib.decompressobj(-15), self.start, 0, b""

    def slice(self, offset: int, size: int) -> bytes:
        return self._chunks(offset, size) if self.sizes else self._follow(offset, size)

    def _chunks(self, offset: int, size: int) -> bytes:
        parts = []
        for n in range(offset // self.chunk, min(-(-(offset + size) // self.chunk), len(self.sizes))):
            if n != self.held:
                self.held = -1
                try:
                    self.data = zlib.decompressobj(-15).decompress(self.read(self.places[n], self.sizes[n]))
                except zlib.error as wrong:
                    raise ValueError(f"a chunk cannot be inflated: {wrong}") from None
                self.held = n
            parts.append(self.data[max(offset - n * self.chunk, 0) : offset + size - n * self.chunk])
        return b"".join(parts)

    def _follow(self, offset: int, size: int) -> bytes:
        if offset < self.done:
            self._rewind()
        while self.done + len(self.window) < offset + size and not self.stream.eof:
            data = self.read(self.at, CHUNK)
            if not data:
                break
            self.at += len(data)
            self.window += self.stream.decompress(data)
            if (over := min(offset - self.done, len(self.window))) > 0:
                self.window, self.done = self.window[over:], self.done + over
        found = self.window[offset - self.done : offset - self.done + size]
        self.window, self.done = self.window[offset - self.done :], max(self.done, offset)
        return found


def opened(ifo: bytes, data: Read, packed: bool) -> tuple[Callable[[int, int], bytes], bool, int]:
    """(slice, marked, bits): access to the data, whether it has markup, and
    the index's bits of an offset."""
    facts = facts_of(ifo)
    packed = packed or data(0, 2) == b"\x1f\x8b"
    bits = 64 if facts.get("idxoffsetbits") == "64" else 32
    return DictZip(data).slice if packed else data, facts.get("sametypesequence", "")[:1] in ("h", "x"), bits
