"""Media columns: byte payloads as 8-bit audio, and features of the samples.

``store`` puts a payload into a mono 8-bit WAV container; ``features`` reads
the samples back, resamples them by a polyphase filter, takes overlapped
log-mel filterbanks and cuts the sound into segments by energy with
hysteresis. Patches of the filterbank are kept as a fixed-shape Arrow tensor
(Arrow IPC bytes) beside the time span of each patch.

Cases: a null or empty payload is padded to one block; equal payloads give
equal values whatever batch they come in; very long payloads are processed in
blocks of ``BLOCK`` frames that overlap by what filter and frame need, so that
beside the payload and its own features only one block is in memory; rows are
handed on as soon as they make ``BATCH_BYTES``; a frame at a level itself is
above it; repeated rows are described each on its own; an empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import wave
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import lean

PAD = 192
#: Output frames that one block computes.
BLOCK = 16_384
#: Media bytes of the rows that are handed on at once.
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Settings:
    rate: int = 16_000
    up: int = 1
    down: int = 2
    taps: int = 16  # filter length per phase
    frame: int = 256
    hop: int = 128
    bands: int = 24
    patch: int = 16  # frames in a tensor
    open_db: float = -22.0  # a segment begins at this energy
    close_db: float = -30.0  # and ends below this one

    @cached_property
    def rate_out(self) -> float:
        return self.rate * self.up / self.down

    @cached_property
    def phases(self) -> np.ndarray:
        """A windowed sinc low-pass, one row of taps for each output phase."""
        n = self.taps * self.up
        t = np.arange(n) - (n - 1) / 2
        cut = 1 / max(self.up, self.down)
        h = np.sinc(t * cut) * cut * np.hamming(n) * self.up
        h *= self.up / h.sum()
        return np.stack([h[p :: self.up][::-1] for p in range(self.up)])

    @cached_property
    def mel(self) -> np.ndarray:
        """Triangular filters, evenly spaced on the mel scale."""
        def to_mel(f):
            return 2595 * np.log10(1 + f / 700)

        edges = 700 * (10 ** (np.linspace(0, to_mel(self.rate_out / 2), self.bands + 2) / 2595) - 1)
        freqs = np.fft.rfftfreq(self.frame, 1 / self.rate_out)
        low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
        return np.maximum(0, np.minimum((freqs - low) / (mid - low), (high - freqs) / (high - mid))).T

    @cached_property
    def window(self) -> np.ndarray:
        return np.hanning(self.frame)


def wav_bytes(payload: bytes, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as sound:
        sound.setnchannels(1)
        sound.setsampwidth(1)
        sound.setframerate(rate)
        sound.writeframes(payload)
    return out.getvalue()


def wav_payload(media: bytes) -> bytes:
    """The samples of a container, found by its chunks (a pad byte left out)."""
    at = 12
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


def resample(x: np.ndarray, s: Settings, first: int, count: int) -> np.ndarray:
    """Output samples ``first`` to ``first + count`` of the polyphase filter.

    Output m lies at u = m * down on the grid of ``up`` points per input; it
    takes the taps of phase u % up around input u // up. Outputs ``up`` apart
    share a phase and lie ``down`` inputs apart, so each phase is a sum of
    strided slices.
    """
    y = np.empty(count)
    for at in range(min(s.up, count)):
        u = (first + at) * s.down
        n = -(-(count - at) // s.up)
        lo = u // s.up - (s.taps - 1) // 2
        part = np.zeros((n - 1) * s.down + s.taps)
        a, b = max(lo, 0), min(lo + len(part), len(x))
        if b > a:
            part[a - lo : b - lo] = x[a:b]
        total = np.zeros(n)
        for tap, weight in enumerate(s.phases[u % s.up]):
            total += weight * part[tap : tap + (n - 1) * s.down + 1 : s.down]
        y[at :: s.up] = total
    return y


def log_mel(payload: bytes, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (frames x bands log-mel, frame energy in dB), in time order."""
    raw = np.frombuffer(payload, np.uint8)
    n_out = max(s.frame, -(-len(raw) * s.up // s.down))
    frames = 1 + max(0, -(-(n_out - s.frame) // s.hop))
    for first in range(0, frames, BLOCK):
        k = min(BLOCK, frames - first)
        begin, length = first * s.hop, (k - 1) * s.hop + s.frame
        a = max(0, begin * s.down // s.up - 2 * s.taps)
        a -= a % s.down  # so that the block's grid is the whole's
        b = (begin + length) * s.down // s.up + 2 * s.taps
        x = (raw[a:b].astype(np.float64) - 128) / 128
        y = resample(x, s, begin - a * s.up // s.down, length)
        windows = np.lib.stride_tricks.sliding_window_view(y, s.frame)[:: s.hop]
        level = windows.mean(1)
        energy = 10 * np.log10(np.maximum(0, np.einsum("ij,ij->i", windows, windows) / s.frame - level**2) + 1e-10)
        power = np.abs(np.fft.rfft(windows * s.window, axis=1)) ** 2
        yield np.log(power @ s.mel + 1e-10), energy


class Segments:
    """Frames [start, end) of sound: open above one level, close below a lower."""

    def __init__(self, s: Settings):
        self.s, self.found, self.start, self.at = s, [], None, 0

    def add(self, energy: np.ndarray) -> None:
        # Only frames outside the two levels can change the state.
        mark = np.where(energy >= self.s.open_db, 1, np.where(energy < self.s.close_db, -1, 0))
        for i in np.flatnonzero(mark):
            if mark[i] > 0 and self.start is None:
                self.start = self.at + int(i)
            elif mark[i] < 0 and self.start is not None:
                self.found.append((self.start, self.at + int(i)))
                self.start = None
        self.at += len(energy)

    def all(self) -> list[tuple[int, int]]:
        return self.found + ([(self.start, self.at)] if self.start is not None else [])


def tensor_bytes(patches: np.ndarray) -> bytes:
    """Arrow IPC bytes of one fixed-shape tensor column."""
    array = pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(patches))
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([array], ["log_mel"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_tensor(data: bytes) -> np.ndarray:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all().column(0).combine_chunks().to_numpy_ndarray()


def describe(payload: bytes, s: Settings) -> dict:
    """Features of one payload: summary, tensor of patches, spans in seconds."""
    total, squares, sound, patches, frames = np.zeros(s.bands), np.zeros(s.bands), Segments(s), [], 0
    rest = np.empty((0, s.bands), np.float32)
    for mel, energy in log_mel(payload, s):
        total += mel.sum(0)
        squares += (mel**2).sum(0)
        sound.add(energy)
        frames += len(mel)
        rows = np.concatenate([rest, mel.astype(np.float16).astype(np.float32)])
        whole = len(rows) // s.patch * s.patch
        patches.append(rows[:whole].reshape(-1, s.patch, s.bands))
        rest = rows[whole:]
    if len(rest):  # the last patch is filled up with silence
        filled = np.full((1, s.patch, s.bands), np.float32(np.log(1e-10)))
        filled[0, : len(rest)] = rest
        patches.append(filled)
    spans = sound.all()
    step = s.hop / s.rate_out
    mean = total / frames
    spread = np.sqrt(np.maximum(0, squares / frames - mean**2))
    feature = f"{frames}|{len(spans)}|{sum(b - a for a, b in spans)}|" + ",".join(f"{x:.4f}" for x in (*mean, *spread))
    tensor = np.concatenate(patches)
    width, total_s = s.patch * step, len(payload) / s.rate
    return {
        "feature": feature,
        "tensor": tensor_bytes(tensor),
        "spans": [{"start_s": i * width, "end_s": min((i + 1) * width, total_s)} for i in range(len(tensor))],
        "segments": [{"start_s": a * step, "end_s": min(b * step, total_s)} for a, b in spans],
    }


SPANS = T.ArrayType(T.StructType([T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType())]))


def store(items: DataFrame, id_col: str = "doc_id", payload_col: str = "payload", settings: Settings = Settings()) -> DataFrame:
    """(id, n_bytes, media): each padded payload in a WAV container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for payload in batch.column(1):
                data = payload.as_py() or b""
                sizes.append(len(data))
                media.append(wav_bytes(data + b" " * (-len(data) % PAD or (PAD if not data else 0)), settings.rate))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    schema = T.StructType([items.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])
    return items.select(id_col, payload_col).mapInArrow(lean(run), schema)


def features(media: DataFrame, id_col: str = "doc_id", settings: Settings = Settings(), tensors: bool = True) -> DataFrame:
    """Features of stored media, computed from the bytes as stored.

    Adds payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256
    and feature; with ``tensors`` also tensor (Arrow IPC bytes), spans and
    segments.
    """
    extra = [T.StructField("tensor", T.BinaryType()), T.StructField("spans", SPANS), T.StructField("segments", SPANS)] if tensors else []
    fields = [
        media.schema[id_col],
        T.StructField("n_bytes", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("feature", T.StringType()),
        *extra,
    ]
    schema = T.StructType(fields)
    span_type = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
    kinds = {"payload_sha256": pa.string(), "media_sha256": pa.string(), "feature": pa.string(), "tensor": pa.binary(), "spans": span_type, "segments": span_type}

    names = [f.name for f in fields[2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, begin, size = [], 0, 0
            for at, stored in enumerate(batch.column(2)):
                data = stored.as_py()
                size += len(data)
                payload = wav_payload(data)
                rows.append(
                    {
                        "payload_bytes": len(payload),
                        "payload_sha256": hashlib.sha256(payload).hexdigest(),
                        "tail_crc32": zlib.crc32(payload[-16:]),
                        "media_bytes": len(data),
                        "media_sha256": hashlib.sha256(data).hexdigest(),
                    }
                    | describe(payload, settings)
                )
                if size >= BATCH_BYTES or at + 1 == batch.num_rows:
                    done = batch.slice(begin, at + 1 - begin)
                    yield pa.RecordBatch.from_arrays([done.column(0), done.column(1), *(pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names)], [f.name for f in fields])
                    rows, begin, size = [], at + 1, 0

    return media.select(id_col, "n_bytes", "media").mapInArrow(lean(run), schema)


def of_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, payload): texts as UTF-8 bytes."""
    return docs.select(id_col, F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("payload"))
