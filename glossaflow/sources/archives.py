"""ZIP archives as a registered data source, archives within archives included.

``spark.read.format("archive").load(path)`` gives (archive, member, at, content,
status), once :func:`register` was called: the bytes of members in pieces that
begin ``at`` a place of the member. Partitions are planned from the archives'
directories, so the members of one archive are inflated by many tasks, and no
task holds a whole member.

Files ``x.zip.001``, ``x.zip.002`` and so on are the volumes of ``x.zip``.

A member is read to its end before its first piece is handed on: one that is
ENCRYPTED, DAMAGED or packed by an UNSUPPORTED method is one row with that status
and null bytes, and so is an archive that cannot be opened (its member is null).
An empty member is one empty piece. Nothing ends the run but a store that fails.

Options: ``pieceBytes`` and ``partBytes``; ``members``, ``archives`` or
``others`` for those whose names say that they are archives or not;
``contents``, ``false`` for one row a member without reading it.
With ``nestedBytes`` a member of that size at most that is a ZIP archive, and no
volume, is opened where it is found, on ``levels`` levels at most: its members
are rows, and ``archive`` is the way to it. Without contents ``at`` is then the
level on which a member was found.
"""

from __future__ import annotations

import bisect
import io
import itertools
import lzma
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from glossaflow.shared import materialize, shared_dir
from glossaflow.sinks.files import write_files
from glossaflow.sources.datasources import PART_BYTES, file_system, listed

PIECE_BYTES = 4 << 20
#: Levels of archives within archives; beyond them there is an error, as in an
#: archive that holds itself.
DEPTH = 16
ARCHIVE = r"(?i)\.(zip|7z|rar)(\.[0-9]{3,})?$"
#: Bytes are taken to be four times as many when inflated; archives that make a
#: part at most by this are small.
PACKED = 4
#: Largest archive within an archive that is held by a task, and rows and bytes
#: that are handed on at once, where one piece is not more.
NESTED_BYTES, BATCH_ROWS, BATCH_BYTES = 4 << 20, 4096, 1 << 20
OK, ENCRYPTED, DAMAGED, UNSUPPORTED = "OK", "ENCRYPTED", "DAMAGED", "UNSUPPORTED"
#: What inflating damaged bytes raises.
DAMAGE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, struct.error, ValueError, LookupError)
FIELDS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("at", pa.int64()), ("content", pa.binary()), ("status", pa.string())])


def unlocked(info: zipfile.ZipInfo) -> bool:
    return not info.flag_bits & 1


def _read(archive: zipfile.ZipFile, info: zipfile.ZipInfo, use: Callable[[IO[bytes]], bytes | None]) -> tuple[str, bytes | None]:
    """(status, what ``use`` makes of a member that it reads to its end); the
    checksum is compared."""
    if not unlocked(info):
        return ENCRYPTED, None
    try:
        with archive.open(info) as source:
            return OK, use(source)
    except (NotImplementedError, RuntimeError):
        return UNSUPPORTED, None
    except DAMAGE:
        return DAMAGED, None
    except OSError:
        # Of these methods only this one says so of damaged bytes.
        if info.compress_type != zipfile.ZIP_BZIP2:
            raise
        return DAMAGED, None


def state_of(archive: zipfile.ZipFile, info: zipfile.ZipInfo, chunk: int = PIECE_BYTES) -> str:
    """Whether a member can be read to its end."""

    def through(source: IO[bytes]) -> None:
        while source.read(chunk):
            pass

    return _read(archive, info, through)[0]


class Joined(io.RawIOBase):
    """Files one after the other, as one that can be read at any place."""

    def __init__(self, system, volumes: list[tuple[str, int]]):
        self._system, self._files = system, [path for path, _ in volumes]
        self._starts = list(itertools.accumulate((n for _, n in volumes), initial=0))
        self._place, self._open = 0, (-1, None)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._place

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = (0, self._place, self._starts[-1])[whence] + offset
        if place < 0:
            raise ValueError("place before the beginning")
        self._place = place
        return place

    def readinto(self, buffer) -> int:
        if self._place >= self._starts[-1]:
            return 0
        n = bisect.bisect_right(self._starts, self._place) - 1
        if self._open[0] != n:
            self._release()
            self._open = (n, self._system.open_input_file(self._files[n]))
        data = self._open[1].read_at(min(len(buffer), self._starts[n + 1] - self._place), self._place - self._starts[n])
        buffer[: len(data)] = data
        self._place += len(data)
        return len(data)

    def _release(self) -> None:
        if self._open[1]:
            self._open[1].close()
        self._open = (-1, None)

    def close(self) -> None:
        if not self.closed:
            self._release()
        super().close()


#: (archive, member, at, content, status)
Row = tuple[str, str | None, int | None, bytes | None, str]


@dataclass
class Members:
    """A range of an archive's directory (all of it without ``stop``), or why
    there is none."""

    archive: str
    volumes: list[tuple[str, int]] = field(default_factory=list)
    start: int = 0
    stop: int | None = None
    status: str = OK


@dataclass
class Part(InputPartition):
    """What one task reads: ranges of archives, many where these are small."""

    ranges: list[Members] = field(default_factory=list)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.path = options["path"]
        self.piece, self.part = int(options.get("piecebytes", PIECE_BYTES)), int(options.get("partbytes", PART_BYTES))
        self.contents = options.get("contents", "true").lower() == "true"
        self.nested, self.levels = int(options.get("nestedbytes", 0)), int(options.get("levels", DEPTH))
        self.members = options.get("members", "all")
        if self.members not in ("all", "archives", "others"):
            raise ValueError("members is all, archives or others")

    def _opened(self, volumes: list[tuple[str, int]]) -> zipfile.ZipFile:
        return zipfile.ZipFile(io.BufferedReader(Joined(file_system(self.path)[0], volumes), 1 << 16))

    def partitions(self) -> list[Part]:
        """Small archives are not opened here but by the tasks, as many in one
        as make up a part."""
        found: dict[str, list[tuple[int, str, int]]] = {}
        for path, size in listed(self.path, ("",)):
            name = path.rpartition("/")[2]
            if shape := re.search(ARCHIVE, name):
                volume = shape[2] or ""
                found.setdefault(name.removesuffix(volume), []).append((int(volume[1:] or 0), path, size))
        out: list[Part] = []
        small, weight = [], 0
        for name, volumes in sorted(found.items()):
            files = [(path, size) for _, path, size in sorted(volumes)]
            total = sum(size for _, size in files)
            readable = name.lower().endswith(".zip")
            if not readable or total * PACKED <= self.part:
                small.append(Members(name, files, status=OK if readable else UNSUPPORTED))
                weight += total if readable else 0
                if weight * PACKED >= self.part:
                    out.append(Part(small))
                    small, weight = [], 0
                continue
            try:
                with self._opened(files) as archive:
                    sizes = [i.file_size for i in archive.infolist()]
            except DAMAGE:
                small.append(Members(name, files, status=DAMAGED))
                continue
            start = held = 0
            for n, size in enumerate(sizes, 1):
                held += size
                if held >= self.part or n == len(sizes):
                    out.append(Part([Members(name, files, start, n)]))
                    start, held = n, 0
        # None at all would be read as a source that is not partitioned.
        return [*out, Part(small)] if small or not out else out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in itertools.chain.from_iterable(map(self._range, part.ranges)):
            held.append(row)
            size += len(row[3] or b"")
            if size >= min(self.piece, BATCH_BYTES) or len(held) == BATCH_ROWS:
                yield self._batch(held)
                held, size = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, rows: list[Row]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FIELDS, strict=True)], schema=FIELDS)

    def _sick(self, archive: str, status: str, member: str | None = None) -> Iterator[Row]:
        # Once, whichever members are asked for.
        if self.members != "archives":
            yield archive, member, None, None, status

    def _range(self, part: Members) -> Iterator[Row]:
        if part.status != OK:
            yield from self._sick(part.archive, part.status)
            return
        try:
            opened = self._opened(part.volumes)
        except DAMAGE:
            yield from self._sick(part.archive, DAMAGED)
            return
        with opened as archive:
            yield from self._rows(part.archive, archive, archive.infolist()[part.start : part.stop])

    def _rows(self, name: str, archive: zipfile.ZipFile, members: list[zipfile.ZipInfo], level: int = 0) -> Iterator[Row]:
        shapes = ((i.filename, re.search(ARCHIVE, i.filename)) for i in archive.infolist())
        cut = {n.removesuffix(shape[2]) for n, shape in shapes if shape and shape[2]}
        for info in members:
            member, kind = info.filename, bool(re.search(ARCHIVE, info.filename))
            if info.is_dir():
                continue
            if kind and info.file_size <= self.nested and self.nested and level < self.levels and unlocked(info) and member.lower().endswith(".zip") and member not in cut:
                yield from self._inner(name, archive, info, level + 1)
            elif self.members == "all" or kind == (self.members == "archives"):
                yield from self._pieces(name, archive, info) if self.contents else [(name, member, level if self.nested else None, None, OK if unlocked(info) else ENCRYPTED)]

    def _inner(self, name: str, archive: zipfile.ZipFile, info: zipfile.ZipInfo, level: int) -> Iterator[Row]:
        """What an archive within an archive holds, which is held here."""
        status, data = _read(archive, info, lambda source: source.read())
        if status != OK:
            yield from self._sick(name, status, info.filename)
            return
        way = f"{name}/{info.filename}"
        try:
            opened = zipfile.ZipFile(io.BytesIO(data))
        except DAMAGE:
            yield from self._sick(way, DAMAGED)
            return
        with opened as inner:
            yield from self._rows(way, inner, inner.infolist(), level)

    def _pieces(self, name: str, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> Iterator[Row]:
        member = info.filename
        if info.file_size <= self.piece:
            # One piece is read once.
            status, data = _read(archive, info, lambda source: source.read())
            yield name, member, 0 if status == OK else None, data, status
            return
        if (status := state_of(archive, info, self.piece)) != OK:
            yield name, member, None, None, status
            return
        with archive.open(info) as source:
            at = 0
            while piece := source.read(self.piece):
                yield name, member, at, piece, OK
                at += len(piece)


class Archive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return "archive string, member string, at bigint, content binary, status string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Archive)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    """(archive, member, at, content, status) of the archives at ``path``."""
    register(spark)
    return spark.read.format("archive").options(**options).load(path)


def _whole(member: Column) -> tuple[Column, Column]:
    """A member's name without its volume, and the volume or 0."""
    ending = F.regexp_extract(member, ARCHIVE, 2)
    return F.left(member, F.char_length(member) - F.char_length(ending)), F.coalesce(F.substring(ending, 2, 18).try_cast("bigint"), F.lit(0))


def _written(archive: Column, member: Column) -> Column:
    """The name by which an archive found in an archive is written: one for all
    its volumes, and none that a store would refuse."""
    whole = _whole(member)[0]
    return F.concat(F.sha2(F.concat_ws("\n", archive, whole), 256), F.lower(F.regexp_extract(whole, r"(\.[^.]*)$", 1)))


def unpack(spark: SparkSession, path: str, *, depth: int = DEPTH, **options) -> DataFrame:
    """(archive, member, at, content, status) of all that archives hold, and the
    archives in them, until none is left; ``archive`` is the way to it, parts
    between slashes.

    An archive found in one, of ``nestedBytes`` at most, is opened by the task
    that found it. Larger ones, and volumes, are written to the shared folder,
    each piece a volume, and are the next level's input: a level is one job over
    all its archives. What cannot be opened is a row, at any level. The folder
    stays as long as the frame may be read.
    """
    options = {"nestedBytes": NESTED_BYTES, **options}
    piece = int(options.get("pieceBytes", PIECE_BYTES))
    at, ways, found = path, None, []

    def told(rows: DataFrame) -> DataFrame:
        """Rows with the way to their archive in place of its written name, and
        with the level of that."""
        if ways is None:
            return rows.withColumn("level", F.lit(0))
        # A written name is before the first slash, and what follows is the way on.
        root = F.substring_index("archive", "/", 1)
        way = F.concat(F.coalesce("way", "root"), F.substring(F.col("archive"), F.length("root") + 1, F.length("archive")))
        return rows.withColumn("root", root).join(ways, "root", "left").select(way.alias("archive"), *rows.columns[1:], F.coalesce("level", F.lit(0)).alias("level"))

    for level in itertools.count():
        options["levels"] = max(0, depth - level)
        found.append(told(read_archives(spark, at, members="others", **options)).drop("level"))
        inner = read_archives(spark, at, members="archives", **options)
        listing = told(read_archives(spark, at, members="archives", **options, contents="false"))
        name, (whole, volume) = _written(F.col("archive"), F.col("member")), _whole(F.col("member"))
        # Without archives opened in place all are of the level that is read.
        after = listing.select(name.alias("root"), F.concat_ws("/", "archive", whole).alias("way"), (F.col("level") + F.coalesce("at", F.lit(0)) + 1).cast("int").alias("level"))
        after = materialize(after.distinct(), "ways")
        if (deepest := after.agg(F.max("level")).first()[0]) is None:
            break
        if deepest > depth:
            raise ValueError(f"archives within archives on more than {depth} levels")
        # The way, not the written name, is what an inner archive is named by.
        pieces = told(inner).drop("level")
        folder = f"{shared_dir(spark)}/glossaflow/inner-{uuid.uuid4().hex}"
        number = F.lpad((volume * 1_000_000 + F.floor(F.col("at") / piece) + 1).cast("string"), 12, "0")
        sound = pieces.where(F.col("status") == OK)
        write_files(sound.select(F.concat(name, F.lit("."), number).alias("name"), "content"), folder)
        found.append(pieces.where(F.col("status") != OK))
        at, ways = folder, after
    return reduce(DataFrame.unionByName, found)
