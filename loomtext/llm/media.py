"""Operator 9: media columns by signature sniffing.

An Aho-Corasick automaton finds every magic byte string of the supported formats in one pass over a value. A format
validator then reads the structure behind each hit (chunk sizes, segment lengths, trailers) and either confirms a span
of bytes or drops the hit. A confirmed span at offset 0 gives the value's true type, which corrects a declared one;
confirmed spans elsewhere are embedded media and are carved out.

Texts can be stored as media without loss: `wrap_pcm` puts their bytes into 8-bit mono RIFF/WAVE samples and
`unwrap_pcm` reads them back through the validator.

Defined cases: a null value is an empty one; an empty or unknown value has type "unknown" and no carved spans; spans that
overlap an accepted one are not reported again (the earlier and then the longer wins); a truncated structure is not valid. A
value is handled alone, so memory is bounded by the longest value and an Arrow batch. Ids and other columns are passed on
untouched. `media_column` adds its columns beside those of the input; where the input has a column of that name, a number is put
behind the new one's.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from ..session import fresh, materialise_small, table

BLOCK = 64
#: The type that a text's payload is declared as.
DECLARED = "text"
SAMPLE_RATE = 8000
_HEADER = 44


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


def _png(data: bytes, at: int) -> int:
    pos, seen = at + 8, 0
    while pos + 12 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, pos)
        stop = pos + 12 + size
        if stop > len(data) or (seen == 0 and (kind != b"IHDR" or size != 13)):
            return -1
        if zlib.crc32(data[pos + 4 : stop - 4]) != struct.unpack_from(">I", data, stop - 4)[0]:
            return -1
        if kind == b"IEND":
            return stop
        pos, seen = stop, seen + 1
    return -1


def _jpeg(data: bytes, at: int) -> int:
    pos = at + 2
    while pos + 4 <= len(data) and data[pos] == 0xFF:
        mark = data[pos + 1]
        if mark == 0xD9:
            return pos + 2
        if 0xD0 <= mark <= 0xD7 or mark == 0x01:
            pos += 2
            continue
        size = struct.unpack_from(">H", data, pos + 2)[0]
        if size < 2:
            return -1
        pos += 2 + size
        if mark == 0xDA:  # entropy-coded data ends at the next marker that is neither stuffed nor a restart
            while True:
                pos = data.find(b"\xff", pos)
                if pos < 0 or pos + 1 >= len(data):
                    return -1
                if data[pos + 1] == 0 or 0xD0 <= data[pos + 1] <= 0xD7:
                    pos += 2
                    continue
                break
    return pos + 2 if data[pos : pos + 2] == b"\xff\xd9" else -1


def _gif(data: bytes, at: int) -> int:
    if at + 13 > len(data):
        return -1
    flags, pos = data[at + 10], at + 13
    pos += 3 << ((flags & 7) + 1) if flags & 0x80 else 0
    while pos < len(data):
        block = data[pos]
        if block == 0x3B:
            return pos + 1
        if block == 0x21:
            pos += 2
        elif block == 0x2C and pos + 10 <= len(data):
            local = data[pos + 9]
            pos += 11 + (3 << ((local & 7) + 1) if local & 0x80 else 0)
        else:
            return -1
        while pos < len(data) and data[pos]:
            pos += 1 + data[pos]
        pos += 1
    return -1


def _riff(data: bytes, at: int) -> int:
    if at + 12 > len(data):
        return -1
    stop = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    if stop > len(data) or data[at + 8 : at + 12] not in (b"WAVE", b"WEBP", b"AVI "):
        return -1
    pos, parts = at + 12, 0
    while pos + 8 <= stop:
        size = struct.unpack_from("<I", data, pos + 4)[0]
        pos += 8 + size + (size & 1)
        parts += 1
    return stop if parts and pos in (stop, stop + 1) else -1


def _bmp(data: bytes, at: int) -> int:
    if at + 26 > len(data):
        return -1
    size, zero, pixels, header = struct.unpack_from("<IIII", data, at + 2)
    return at + size if zero == 0 and header in (12, 40, 52, 56, 108, 124) and 26 <= pixels <= size <= len(data) - at else -1


def _pdf(data: bytes, at: int) -> int:
    if at + 8 > len(data) or not data[at + 5 : at + 6].isdigit():
        return -1
    ends, tables = _pdf_marks(data)
    end = bisect_left(ends, at)
    if end == len(ends):
        return -1
    mark = bisect_left(tables, at)
    return ends[end] + 5 if mark < len(tables) and tables[mark] + 9 <= ends[end] else -1


@functools.lru_cache(maxsize=1)
def _pdf_marks(data: bytes) -> tuple[list[int], list[int]]:
    """Where the ends and the table marks of a value are, found once for all its headers."""
    return [m.start() for m in re.finditer(rb"%%EOF", data)], [m.start() for m in re.finditer(rb"startxref", data)]


def _gzip(data: bytes, at: int) -> int:
    if at + 18 > len(data) or data[at + 3] & 0xE0:
        return -1
    engine, pos, held = zlib.decompressobj(31), at, b""
    try:
        while not engine.eof and (held or pos < len(data)):  # a bounded piece of output at a time; none is kept
            if not held:
                held, pos = data[pos : pos + 65536], pos + 65536
            engine.decompress(held, 1 << 20)
            held = engine.unconsumed_tail
    except zlib.error:
        return -1
    return min(pos, len(data)) - len(engine.unused_data) - len(held) if engine.eof else -1


def _zip(data: bytes, at: int, failed: set[int] | None = None) -> int:
    """The end of an archive. Entries that lead to no end are put in `failed`, so that each is walked over once."""
    pos, walked = at, [at]
    failed = set() if failed is None else failed
    while data[pos : pos + 4] == b"PK\x03\x04" and pos + 30 <= len(data) and pos not in failed:
        flags, = struct.unpack_from("<H", data, pos + 6)
        size, _, name, extra = struct.unpack_from("<IIHH", data, pos + 18)
        if flags & 8:
            break
        pos += 30 + name + extra + size
        walked.append(pos)
    begin = pos
    while data[pos : pos + 4] == b"PK\x01\x02" and pos + 46 <= len(data):
        pos += 46 + sum(struct.unpack_from("<HHH", data, pos + 28))
    if pos == begin or data[pos : pos + 4] != b"PK\x05\x06" or pos + 22 > len(data):
        failed.update(walked)
        return -1
    return pos + 22 + struct.unpack_from("<H", data, pos + 20)[0]


_FORMATS: dict[bytes, tuple[str, Callable[..., int]]] = {
    b"\x89PNG\r\n\x1a\n": ("png", _png),
    b"\xff\xd8\xff": ("jpeg", _jpeg),
    b"GIF87a": ("gif", _gif),
    b"GIF89a": ("gif", _gif),
    b"RIFF": ("riff", _riff),
    b"BM": ("bmp", _bmp),
    b"%PDF-": ("pdf", _pdf),
    b"\x1f\x8b\x08": ("gzip", _gzip),
    b"PK\x03\x04": ("zip", _zip),
}
_RIFF_KINDS = {b"WAVE": "wav", b"WEBP": "webp", b"AVI ": "avi"}
_AUTOMATON: list = []


def _automaton():
    if not _AUTOMATON:
        machine = ahocorasick.Automaton()
        for magic in _FORMATS:
            machine.add_word(magic.decode("latin-1"), magic)
        machine.make_automaton()
        _AUTOMATON.append(machine)
    return _AUTOMATON[0]


def hits(data: bytes) -> list[tuple[int, bytes]]:
    """Where each magic stands, by start."""
    return sorted((last - len(magic) + 1, magic) for last, magic in _automaton().iter(data.decode("latin-1")))


def sniff(data: bytes, found: list[tuple[int, bytes]] | None = None) -> list[Span]:
    """The confirmed media spans of a value (its hits may be given), by start; what stands inside one is its content and isn't looked at."""
    spans: list[Span] = []
    done, failed = 0, set()
    for at, magic in hits(data) if found is None else found:
        if at < done:
            continue
        kind, valid = _FORMATS[magic]
        stop = valid(data, at, failed) if kind == "zip" else valid(data, at)
        if stop > 0:
            done = min(stop, len(data))
            spans.append(Span(_RIFF_KINDS.get(data[at + 8 : at + 12], kind) if kind == "riff" else kind, at, done))
    return spans


def wrap_pcm(payload: bytes) -> bytes:
    """A RIFF/WAVE file whose 8-bit mono samples are the payload (an even number of bytes)."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", len(payload) + 36, b"WAVE", b"fmt ", 16, 1, 1, SAMPLE_RATE, SAMPLE_RATE, 1, 8, b"data", len(payload)) + payload


def unwrap_pcm(stored: bytes) -> bytes:
    """The samples of a validated WAVE file; an error if it isn't one."""
    if _riff(stored, 0) != len(stored) or stored[8:12] != b"WAVE":
        raise ValueError("not a complete WAVE file")
    pos = 12
    while pos + 8 <= len(stored):
        kind, size = struct.unpack_from("<4sI", stored, pos)
        if kind == b"data":
            return stored[pos + 8 : pos + 8 + size]
        pos += 8 + size + (size & 1)
    raise ValueError("no data chunk")


def media_column(df: DataFrame, value: str, declared: str | None = None) -> DataFrame:
    """df with true_type, type_corrected and carved array<struct<kind,start,end,bytes>> for a binary column."""
    added = {"true_type": StringType(), "type_corrected": BooleanType(), "carved": ArrayType(_CARVED)}
    schema = StructType([*df.schema.fields, *[StructField(fresh(n, df.columns), k) for n, k in added.items()]])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            types, corrected, carved = [], [], []
            claims = batch.column(declared).to_pylist() if declared else [None] * batch.num_rows
            for body, claim in zip(batch.column(value), claims, strict=True):
                data = body.as_py() or b""
                spans = sniff(data)
                kind = spans[0].kind if spans and spans[0].start == 0 else "unknown"
                types.append(kind)
                corrected.append(claim is not None and kind != "unknown" and claim != kind)
                carved.append([{"kind": s.kind, "start": s.start, "end": s.end, "bytes": data[s.start : s.end]} for s in spans if s.start])
            made = [pa.array(types, pa.string()), pa.array(corrected, pa.bool_()), pa.array(carved, _CARVED_ARROW)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    return df.mapInArrow(run, schema)


_CARVED = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("bytes", BinaryType())])
_CARVED_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bytes", pa.binary())]))


def text_media(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes and its text stored as a WAVE value (binary)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("n_bytes", LongType()), StructField("media", BinaryType())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            stored = [wrap_pcm(b.ljust(max(BLOCK, -(-len(b) // BLOCK) * BLOCK), b"\0")) for b in raw]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array(stored, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def described(payload: bytes) -> str:
    """What a payload that is declared as text turns out to be, the media carved out of it (kind:start:end), its hits and its samples."""
    found = hits(payload)
    spans = sniff(payload, found)
    true = spans[0].kind if spans and spans[0].start == 0 else DECLARED
    inside = "+".join(f"{s.kind}:{s.start}:{s.end}" for s in spans) or "-"
    return f"{DECLARED}>{true};corrected={int(true != DECLARED)};carved={inside};hits={len(found)};samples={len(payload)}"


def media_features(stored: DataFrame) -> DataFrame:
    """Digests of stored values (doc_id, n_bytes, media) as read back, and a feature of the payloads: see `described`."""
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    schema = StructType([stored.schema["doc_id"], stored.schema["n_bytes"], *[StructField(n, LongType() if n.endswith(("bytes", "crc32")) else StringType()) for n in names]])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = []
            for media in batch.column("media"):
                media = media.as_py()
                payload = unwrap_pcm(media)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), described(payload)))
            made = [pa.array([r[k] for r in rows], pa.int64() if k in (0, 2, 3) else pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *made], schema.names)

    return materialise_small(stored.select("doc_id", "n_bytes", "media").mapInArrow(run, schema), "media-features")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text written as a stored media value, then read back, sniffed, corrected and carved."""
    return media_features(materialise_small(text_media(table(spark, sf_dir, "documents")), "media"))
