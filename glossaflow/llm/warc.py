"""WARC archives of Zstandard frames: writing, reading back, validation.

An archive begins with its dictionary in a skippable frame, then holds one
frame for each record. Archives are written by Spark's own text writer, so they
reach any store that Spark writes to and a lost task leaves nothing behind: a
record's frame is a line, and the line separator is itself an empty skippable
frame, which readers of the format pass over. The dictionary is trained on a
bounded sample and changes sizes only.

The reader takes archives of any writer. It finds each frame's end from the
block headers, so a damaged record does not end its archive: it comes as a row
with a ``problem``. Checked are the dictionary, the frame, its one record, the
mandatory headers, Content-Length of the record and of the HTTP message, and
the digests of block and payload. :func:`verified` checks that what a revisit
refers to is there with the same digest and length.

Of rows with equal payloads of at least ``LEAST_BYTES`` bytes, those of the
smallest id are responses and the others revisit it.

Cases: a null payload counts as empty; smaller payloads are never revisits;
rows that repeat an id are a record each, and repeats of the smallest id with
its payload are responses as it is; a row with a null id revisits the smallest
id that has its payload, and is a response if none has; a null or empty target
has no header; control characters and blanks in targets are escaped; very long
payloads are whole records; an empty table gives no archive and no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import checked_broadcast, lean, materialize

LEAST_BYTES = 100
#: Rows and characters of each that train the dictionary, and its bytes.
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES = 256, 16_384, 65_536
#: Records of one archive, its dictionary counted in.
ARCHIVE_RECORDS = 5_000
LEVEL = 3
#: Bytes handed on at once.
BATCH_BYTES = 4 << 20

# Fixed values of the formats.
ZSTD, SKIPPABLE, DICTIONARY_FRAME, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D, 0xEC30A437
BETWEEN = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "archive string, offset long, frame_bytes long, record_type string, record_id string, refers_to string, target string, payload_bytes long, payload_digest string, payload binary, problem string"
_READ = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (f.split() for f in RECORD.split(", "))])


# --- one record --------------------------------------------------------------


def record(kind: str, name: str, date: str, target: str | None, payload: bytes, size: int, digest: str, refers_to: str | None = None) -> bytes:
    """A record of an HTTP response; a revisit holds the message's head only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date)]
    if target:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", target)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head += [
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return b"".join([b"WARC/1.1\r\n", *(f"{k}: {v}\r\n".encode() for k, v in head), b"\r\n", block, b"\r\n\r\n"])


def fields_of(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with a blank goes
    on with the one before."""
    found: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            found[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError("a header line without a name")
        name = name.lower()
        found.setdefault(name, value.strip())
    return found


def whole_number(text: str | None, what: str) -> int:
    if text is None or not re.fullmatch("[0-9]+", text):
        raise ValueError(f"{what} is no length")
    return int(text)


def _sha256(value: str | None) -> str | None:
    """The hex digest of a labelled value, null for other algorithms."""
    found = re.fullmatch("sha-?256:([0-9A-Fa-f]{64})", value or "")
    return found[1].lower() if found else None


def parse(raw: bytes) -> dict:
    """The record in a frame's bytes, validated; ValueError says what is wrong."""
    head, cut, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not cut or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError("no record header")
    fields = fields_of(lines)
    if missing := [n for n in MANDATORY if not fields.get(n)]:
        raise ValueError(f"no {missing[0]}")
    size = whole_number(fields["content-length"], "Content-Length")
    if len(rest) < size + 4:
        raise ValueError("shorter than Content-Length")
    block, end = rest[:size], rest[size:]
    if end != b"\r\n\r\n":
        raise ValueError("longer than Content-Length")
    if (told := _sha256(fields.get("warc-block-digest"))) and hashlib.sha256(block).hexdigest() != told:
        raise ValueError("block digest differs")
    kind, payload, size = fields["warc-type"].lower(), block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        top, cut, payload = block.partition(b"\r\n\r\n")
        if not cut:
            raise ValueError("no HTTP header")
        told = fields_of(top.split(b"\r\n")[1:]).get("content-length")
        size = len(payload) if told is None else whole_number(told, "HTTP Content-Length")
        if kind != "revisit" and size != len(payload):
            raise ValueError("payload of another length")
    told = _sha256(fields.get("warc-payload-digest"))
    if kind == "revisit":
        if not fields.get("warc-refers-to"):
            raise ValueError("a revisit of nothing")
        payload, digest = None, told
    else:
        digest = hashlib.sha256(payload).hexdigest()
        if told and told != digest:
            raise ValueError("payload digest differs")
    name = lambda f: fields[f].strip("<>") if fields.get(f) else None
    return {
        "record_type": kind, "record_id": name("warc-record-id"), "refers_to": name("warc-refers-to"), "target": fields.get("warc-target-uri"),
        "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


# --- frames ------------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> tuple[int, int]:
    """(magic, end) of the frame at ``at``, by its header and block headers."""

    def number(start: int, n: int) -> int:
        if start + n > len(data):
            raise ValueError("cut off")
        return int.from_bytes(data[start : start + n], "little")

    magic = number(at, 4)
    if magic & ~0xF == SKIPPABLE:
        end = at + 8 + number(at + 4, 4)
    elif magic == ZSTD:
        flags = number(at + 4, 1)
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = False
        while not last:
            block = number(at, 3)
            last, kind = block & 1, block >> 1 & 3
            if kind == 3:
                raise ValueError("a reserved block")
            at += 3 + (1 if kind == 1 else block >> 3)
        end = at + 4 * (flags >> 2 & 1)
    else:
        raise ValueError("no frame")
    if end > len(data):
        raise ValueError("cut off")
    return magic, end


def dictionary_of(data: bytes):
    """The dictionary of a leading frame's content, itself compressed or not."""
    import zstandard

    if data[:4] == struct.pack("<I", ZSTD):
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    if data[:4] != struct.pack("<I", DICTIONARY):
        raise ValueError("no dictionary in the leading frame")
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT)


def records_of(content: bytes) -> Iterator[dict]:
    """Every record frame of an archive, with ``problem`` where it is unsound.
    What follows a frame whose end cannot be told is one problem."""
    import zstandard

    data, at, reader = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            magic, end = frame_end(data, at)
        except ValueError as wrong:
            yield {"offset": at, "frame_bytes": len(data) - at, "problem": str(wrong)}
            return
        if magic == ZSTD:
            found = {"offset": at, "frame_bytes": end - at, "problem": None}
            try:
                found |= parse(reader.decompressobj().decompress(data[at:end]))
            except (ValueError, zstandard.ZstdError) as wrong:
                found["problem"] = str(wrong)
            yield found
        elif magic == DICTIONARY_FRAME and at == 0:
            try:
                reader = zstandard.ZstdDecompressor(dict_data=dictionary_of(bytes(data[8:end])))
            except (ValueError, zstandard.ZstdError) as wrong:
                yield {"offset": 0, "frame_bytes": end, "problem": str(wrong)}
                return
        at = end


# --- tables ------------------------------------------------------------------


def name_of(identity: Column) -> Column:
    """Record names of ids, and back by :func:`id_of`."""
    return F.concat(F.lit("urn:record:"), F.coalesce(identity.cast("string"), F.lit("")))


def id_of(name: Column, kind: T.DataType) -> Column:
    return F.nullif(F.regexp_extract(name, "^urn:record:(.*)$", 1), F.lit("")).cast(kind)


def digested(pages: DataFrame, id_col: str = "page_id", target_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, target, payload, size, digest) of pages of text or bytes."""
    payload = F.coalesce(F.encode(payload_col, "UTF-8") if isinstance(pages.schema[payload_col].dataType, T.StringType) else F.col(payload_col), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(target_col).cast("string").alias("target"), payload.alias("payload"))
    return rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})


def mark_revisits(rows: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """:func:`digested` rows with ``first``, the smallest id with the row's
    payload where that is another row's.

    Digests are counted before their shuffle, so a common payload is one row a
    task; only digests that recur are joined back.
    """
    met = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    again = materialize(met.where("n > 1 and first is not null").select("digest", "first"), "payloads")
    joined = rows.join(checked_broadcast(again), "digest", "left")
    other = (F.col("size") >= least) & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select("id", "target", "payload", "size", "digest", F.when(other, F.col("first")).alias("first"))


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes | None:
    """A dictionary from a bounded sample of payloads; none where there is too
    little to learn from. Rows are drawn where they are, so what reaches the
    driver does not grow with the table."""
    import zstandard

    share = min(1.0, 2 * sample_rows / max(rows.count(), 1))
    few = rows.sample(share, seed=1).select("digest", F.substring("payload", 1, SAMPLE_CHARS).alias("payload")).limit(sample_rows).collect()
    heads = [record("response", f"urn:record:{i}", "2000-01-01T00:00:00Z", None, bytes(r["payload"]), len(r["payload"]), r["digest"]) for i, r in enumerate(few)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, heads).as_bytes() if len(heads) > 8 else None
    except zstandard.ZstdError:
        return None


def write_archives(rows: DataFrame, path: str, *, dictionary: bytes | None = None, date: str | None = None, level: int = LEVEL, records: int = ARCHIVE_RECORDS) -> None:
    """Write :func:`mark_revisits` rows as archives in the folder ``path``."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    shared = rows.sparkSession.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES at most
    names = rows.select(name_of(F.col("id")).alias("name"), "target", F.when(F.col("first").isNull(), F.col("payload")).alias("payload"), "size", "digest", F.when(F.col("first").isNotNull(), name_of(F.col("first"))).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known = zstandard.ZstdCompressionDict(shared.value, dict_type=zstandard.DICT_TYPE_FULLDICT) if shared.value else None
        writer, lead, n, held, size = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True), None, 0, [], 0
        if known:
            known.precompute_compress(level=level)
            packed = zstandard.ZstdCompressor(level=19).compress(shared.value)
            lead = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
        for batch in batches:
            for name, target, payload, length, digest, refers in zip(*batch.columns, strict=True):
                if lead and n % records == 0:
                    held.append(lead)
                    n += 1
                refers = refers.as_py()
                raw = record("revisit" if refers else "response", name.as_py(), date, target.as_py(), payload.as_py() or b"", length.as_py(), digest.as_py(), refers)
                held.append(writer.compress(raw))
                n, size = n + 1, size + len(held[-1])
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])

    # A string's bytes are written as they are.
    frames = names.mapInArrow(lean(run), "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("maxRecordsPerFile", records).text(path, lineSep=BETWEEN)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives at ``path``, as ``RECORD``. A task holds
    one archive, compressed, and some records."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                held, size = [], 0
                for found in records_of(content.as_py()):
                    held.append(found | {"archive": name.as_py()})
                    size += len(found.get("payload") or b"") + 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, _READ)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, _READ)

    return files.mapInArrow(lean(run), RECORD)


def verified(records: DataFrame) -> DataFrame:
    """``records`` (a written table) with a problem for revisits of a record
    that is not there or has another digest or length.

    What is referred to is made distinct first: a record that many refer to
    meets them as one row.
    """
    told = records.where("record_type = 'revisit' and problem is null").select(F.col("refers_to").alias("to"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n")).distinct()
    held = records.where("record_type = 'response' and problem is null").select("record_id", "payload_digest", "payload_bytes").distinct()
    same = (F.col("to") == F.col("record_id")) & (F.col("n") == F.col("payload_bytes")) & F.coalesce(F.col("d") == F.col("payload_digest"), F.lit(True))
    broken = materialize(told.join(held, same, "left_anti"), "broken")
    side = checked_broadcast(broken)
    hit = (records["refers_to"] == side["to"]) & (records["payload_bytes"] == side["n"]) & records["payload_digest"].eqNullSafe(side["d"]) & (records["record_type"] == "revisit")
    lost = F.when(side["to"].isNotNull(), F.lit("refers to no equal record"))
    return records.join(side, hit, "left").select(*(records[c] for c in records.columns if c != "problem"), F.coalesce(records["problem"], lost).alias("problem"))


def round_trip(pages: DataFrame, path: str, id_col: str = "page_id", target_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives at ``path`` and read them back:
    (id, payload_bytes, payload_digest, record_type, refers_to, problem).

    Payloads are measured as read; a revisit's figures are those of its head,
    checked against the record that it refers to.
    """
    rows = digested(pages, id_col, target_col, payload_col)
    write_archives(mark_revisits(rows), path, dictionary=train(rows))
    narrow = read_archives(pages.sparkSession, path).withColumns({
        "payload_digest": F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).otherwise(F.col("payload_digest")),
        "payload_bytes": F.when(F.col("payload").isNotNull(), F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")),
    }).drop("payload")
    kind = pages.schema[id_col].dataType
    out = verified(materialize(narrow, "records"))
    return out.select(id_of(F.col("record_id"), kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", id_of(F.col("refers_to"), kind).alias("refers_to"), "problem")
