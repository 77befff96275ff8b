"""Registered data sources of dictionary files, read in parts.

``spark.read.format("mdx" | "stardict" | "dicthtml" | "docx").load(path)`` gives
(pos, term, definition, source_file), once :func:`register` was called. A path
is a file, a folder or a pattern, in any store that Arrow's file systems open;
stores that Spark alone reaches have the readers of ``sources.files``.

Partitions are planned from directories, not contents: ranges of an MDict
file's key blocks, as many small files in one as make up a part, byte ranges of
a StarDict index, one file of the others. No task holds a whole dictionary.

Options: ``stems``, a JSON list of the ``source_file`` names wanted, by which
files are chosen before any is opened (filters are not taken from Spark: as
probed on 4.1.2, a frame that is read again without a filter keeps the one
pushed before, and rows are lost); ``mode`` FAILFAST (an error for damaged data) or DROPMALFORMED (the
entries or files that cannot be read are left out); ``partBytes``, the size of a
part; for StarDict ``synonyms``, to have the words of a ``.syn`` file as terms
of their entries, after the others.
"""

from __future__ import annotations

import fnmatch
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from glossaflow.sources import files, mdict, stardict

PART_BYTES = 16 << 20
BATCH_ROWS, BATCH_CHARS = 4096, 4 << 20
#: What readers of damaged data raise.
DAMAGE = (OSError, EOFError, ValueError, LookupError, SyntaxError, struct.error, zlib.error, zipfile.BadZipFile)
FIELDS = pa.schema([("pos", pa.int32()), ("term", pa.string()), ("definition", pa.string()), ("source_file", pa.string())])


def file_system(path: str):
    """(Arrow file system, path in it)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, endings: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, size) of the files of a folder or pattern, or the one file, that
    have one of ``endings``, by name."""
    from pyarrow import fs

    system, place = file_system(path)
    folder, _, pattern = place.rpartition("/")
    if any(c in pattern for c in "*?["):
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        found = [f for f in found if fnmatch.fnmatchcase(f.base_name, pattern)]
    else:
        one = system.get_file_info(place)
        found = system.get_file_info(fs.FileSelector(place)) if one.type == fs.FileType.Directory else [one] if one.type == fs.FileType.File else []
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(endings))


@dataclass
class Part(InputPartition):
    """A range of one file's directory, and which of its lists that is."""

    file: str
    start: int
    stop: int
    kind: str = "entries"
    #: Bytes that it makes, where the directory tells.
    size: int = 0


@dataclass
class Parts(InputPartition):
    """Small parts that one task reads."""

    ranges: list[Part]


def stem_of(path: str) -> str:
    name = path.rpartition("/")[2]
    return name.rpartition(".")[0] or name


class EntryReader(DataSourceReader):
    """Files by their endings, parts of each, entries of a part."""

    endings: tuple[str, ...]

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.path = self.options["path"]
        self.drop = self.options.get("mode", "FAILFAST").upper() == "DROPMALFORMED"
        self.part_bytes = int(self.options.get("partbytes", PART_BYTES))
        self.stems = set(json.loads(self.options["stems"])) if "stems" in self.options else None

    @cached_property
    def _system(self):
        return file_system(self.path)[0]

    def _whole(self, file: str) -> bytes:
        with self._system.open_input_file(file) as source:
            return source.read()

    def partitions(self) -> list[Part | Parts]:
        out: list[Part] = []
        for file, size in listed(self.path, self.endings):
            if self.stems is None or stem_of(file) in self.stems:
                try:
                    out += self.parts(file, size)
                except DAMAGE:
                    if not self.drop:
                        raise
        # None at all would be read as a source that is not partitioned.
        return self._packed(out) or [Part("", 0, 0)]

    def _packed(self, parts: list[Part]) -> list[Part | Parts]:
        """Parts of known size, as many in one as make up a part."""
        out: list[Part | Parts] = [p for p in parts if not p.size]
        held, weight = [], 0
        for part in (p for p in parts if p.size):
            if held and weight + part.size > self.part_bytes:
                out.append(Parts(held))
                held, weight = [], 0
            held.append(part)
            weight += part.size
        return [*out, Parts(held)] if held else out

    def read(self, part: Part | Parts) -> Iterator[pa.RecordBatch]:
        for one in part.ranges if isinstance(part, Parts) else [part]:
            yield from self._read(one)

    def _read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.file:
            return
        held, chars, stem = [], 0, stem_of(part.file)
        try:
            for pos, term, definition in self.entries(part):
                held.append((pos, term, definition))
                chars += len(term) + len(definition)
                if len(held) == BATCH_ROWS or chars >= BATCH_CHARS:
                    yield self._batch(held, stem)
                    held, chars = [], 0
        except DAMAGE:
            if not self.drop:
                raise
        if held:
            yield self._batch(held, stem)

    def _batch(self, rows: list[tuple], stem: str) -> pa.RecordBatch:
        pos, terms, definitions = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(pos, pa.int32()), pa.array(terms, pa.string()), pa.array(definitions, pa.string()), pa.array([stem] * len(rows), pa.string())], schema=FIELDS)

    def parts(self, file: str, size: int) -> list[Part]:
        return [Part(file, 0, size)]

    def entries(self, part: Part) -> Iterator[tuple[int, str, str]]:
        raise NotImplementedError


class MdxReader(EntryReader):
    """Ranges of key blocks; each inflates the record blocks it needs."""

    endings = (".mdx",)

    def parts(self, file: str, size: int) -> list[Part]:
        with self._system.open_input_file(file) as source:
            box = mdict.open_container(lambda at, n: source.read_at(n, at))
        count = max(1, min(len(box.keys), -(-box.size // self.part_bytes)))
        edges = [len(box.keys) * i // count for i in range(count + 1)]
        return [Part(file, a, b, size=max(1, box.size // count)) for a, b in zip(edges, edges[1:], strict=False) if a < b]

    def entries(self, part: Part) -> Iterator[tuple[int, str, str]]:
        with self._system.open_input_file(part.file) as source:
            read = lambda at, n: source.read_at(n, at)
            for pos, key, record in mdict.entries_of(mdict.open_container(read), range(part.start, part.stop), read, drop=self.drop):
                if term := key.strip():
                    yield pos, term, files.html_text(record)


class StarDictReader(EntryReader):
    """Byte ranges of the index; data are read slice by slice."""

    endings = (".ifo",)

    def _beside(self, file: str, *endings: str) -> tuple[str, int] | None:
        from pyarrow import fs

        for info in self._system.get_file_info([file.removesuffix(".ifo") + e for e in endings]):
            if info.type == fs.FileType.File:
                return info.path, info.size
        return None

    def parts(self, file: str, size: int) -> list[Part]:
        idx, data = self._beside(file, ".idx"), self._beside(file, ".dict.dz", ".dict")
        if not idx or not data:
            return []
        lists = [(idx[1], max(1, -(-(idx[1] + data[1]) // self.part_bytes)), "entries")]
        if self.options.get("synonyms", "false").lower() == "true" and (syn := self._beside(file, ".syn")):
            lists.append((syn[1], max(1, -(-syn[1] // self.part_bytes)), "synonyms"))
        return [Part(file, n * i // count, n * (i + 1) // count, kind) for n, count, kind in lists for i in range(count)]

    def entries(self, part: Part) -> Iterator[tuple[int, str, str]]:
        data = self._beside(part.file, ".dict.dz", ".dict")[0]
        with self._system.open_input_file(self._beside(part.file, ".idx")[0]) as idx, self._system.open_input_file(data) as body:
            cut, marked, bits = stardict.opened(self._whole(part.file), lambda at, n: body.read_at(n, at), data.endswith(".dz"))
            tidy = files.html_text if marked else files.squeeze
            entries = enumerate(stardict.index(lambda at, n: idx.read_at(n, at), bits))
            if part.kind == "entries":
                # A part has the records that begin in its range.
                for pos, (place, word, offset, size) in entries:
                    if place >= part.stop:
                        return
                    if place >= part.start:
                        yield pos, word, tidy(cut(offset, size).decode("utf-8", "replace"))
                return
            wanted: dict[int, list[tuple[int, str]]] = {}
            with self._system.open_input_file(self._beside(part.file, ".syn")[0]) as syn:
                for n, (place, word, entry) in enumerate(stardict.synonyms(lambda at, n: syn.read_at(n, at))):
                    if part.start <= place < part.stop:
                        wanted.setdefault(entry, []).append((n, word))
            for pos, (_, _, offset, size) in entries:
                for n, word in wanted.get(pos, ()):
                    yield n, word, tidy(cut(offset, size).decode("utf-8", "replace"))


class DictHtmlReader(EntryReader):
    endings = (".html",)

    def entries(self, part: Part) -> Iterator[tuple[int, str, str]]:
        found = files.html_entries(self._whole(part.file))
        return ((i, term, definition) for i, (term, definition) in enumerate(found))


class DocxReader(EntryReader):
    endings = (".docx",)

    def entries(self, part: Part) -> Iterator[tuple[int, str, str]]:
        return files.docx_rows(self._whole(part.file))


class _Entries(DataSource):
    """The schema that all of these have."""

    kind: type[EntryReader]

    def schema(self) -> str:
        return files.ENTRY

    def reader(self, schema) -> EntryReader:
        return self.kind(dict(self.options))


class Mdx(_Entries):
    kind = MdxReader

    @classmethod
    def name(cls) -> str:
        return "mdx"


class StarDict(_Entries):
    kind = StarDictReader

    @classmethod
    def name(cls) -> str:
        return "stardict"


class DictHtml(_Entries):
    kind = DictHtmlReader

    @classmethod
    def name(cls) -> str:
        return "dicthtml"


class Docx(_Entries):
    kind = DocxReader

    @classmethod
    def name(cls) -> str:
        return "docx"


FORMATS = {source.name(): source for source in (Mdx, StarDict, DictHtml, Docx)}


def register(spark: SparkSession) -> None:
    """Make the formats known to ``spark.read.format``."""
    for source in FORMATS.values():
        spark.dataSource.register(source)


def read_entries(spark: SparkSession, format: str, path: str, stems: Sequence[str] | None = None, **options) -> DataFrame:
    """(pos, term, definition, source_file) of the files at ``path``, or of
    those with the given stems only."""
    register(spark)
    reader = spark.read.format(format).options(**options)
    return (reader if stems is None else reader.option("stems", json.dumps(list(stems)))).load(path)
