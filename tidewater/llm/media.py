"""Media columns: signature sniffing, validation, carving, and lossless storage of bytes as audio samples.

An Aho-Corasick automaton locates the magic bytes of all known formats in one
pass over a value.  A place where magic bytes stand is a candidate only: each
format has a validator that follows the structure (chunk lengths, checksums,
end marks) and says where the medium ends, or that there is none.  A valid
medium at the start gives the true type of the value, whatever type was
declared; valid media further on are carved.

Nulls count as empty values: type ``application/octet-stream``, nothing carved.
A map over rows: nothing is shuffled, and a task holds a few values at a time.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import blocks, tidy

UNKNOWN = "application/octet-stream"

#: Magic bytes, and the type they announce.
MAGIC = {
    b"RIFF": "audio/wav",
    b"\x89PNG\r\n\x1a\n": "image/png",
    b"GIF87a": "image/gif",
    b"GIF89a": "image/gif",
    b"\xff\xd8\xff": "image/jpeg",
    b"BM": "image/bmp",
    b"%PDF-": "application/pdf",
    b"PK\x03\x04": "application/zip",
    b"fLaC": "audio/flac",
    b"OggS": "audio/ogg",
    b"\x1f\x8b\x08": "application/gzip",
}


def _wav(b: bytes, at: int) -> int | None:
    if b[at + 8 : at + 12] != b"WAVE" or at + 12 > len(b):
        return None
    end, p, seen = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at + 12, set()
    if end > len(b):
        return None
    while p + 8 <= end:
        seen.add(b[p : p + 4])
        p += 8 + struct.unpack_from("<I", b, p + 4)[0]
        p += (p - at) & 1
    return end if p in (end, end + 1) and {b"fmt ", b"data"} <= seen else None


def _png(b: bytes, at: int) -> int | None:
    p = at + 8
    while p + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, p)
        if p + 12 + size > len(b) or zlib.crc32(b[p + 4 : p + 8 + size]) != struct.unpack_from(">I", b, p + 8 + size)[0] or (p == at + 8) != (kind == b"IHDR"):
            return None
        p += 12 + size
        if kind == b"IEND":
            return p
    return None


def _gif(b: bytes, at: int) -> int | None:
    p = at + 13
    if p > len(b):
        return None
    p += 3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 0x80 else 0

    def subblocks(p: int) -> int:
        while p < len(b) and b[p]:
            p += 1 + b[p]
        return p + 1

    while p < len(b):
        if b[p] == 0x3B:
            return p + 1
        if b[p] == 0x21:
            p = subblocks(p + 2)
        elif b[p] == 0x2C and p + 10 <= len(b):
            p = subblocks(p + 11 + (3 << ((b[p + 9] & 7) + 1) if b[p + 9] & 0x80 else 0))
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    p = at + 2
    while p + 4 <= len(b) and b[p] == 0xFF:
        mark, size = b[p + 1], struct.unpack_from(">H", b, p + 2)[0]
        if mark < 0xC0 or size < 2:
            return None
        p += 2 + size
        if mark == 0xDA:
            while (q := b.find(b"\xff", p)) >= 0 and q + 1 < len(b):
                if b[q + 1] == 0xD9:
                    return q + 2
                if b[q + 1] and not 0xD0 <= b[q + 1] <= 0xD7:
                    p = q
                    break
                p = q + 2
            else:
                return None
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if at + 54 > len(b):
        return None
    size, zero, data, head = struct.unpack_from("<IIII", b, at + 2)
    planes, bits = struct.unpack_from("<HH", b, at + 26)
    return at + size if zero == 0 and head in (40, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and 14 + head <= data <= size <= len(b) - at else None


def _places(b: bytes, mark: bytes) -> list[int]:
    """Where ``mark`` begins, in order."""
    found, at = [], b.find(mark)
    while at >= 0:
        found.append(at)
        at = b.find(mark, at + 1)
    return found


def _pdf(b: bytes, at: int, memo: dict) -> int | None:
    if "pdf" not in memo:
        memo["pdf"] = b.rfind(b"%%EOF"), _places(b, b"startxref")
    end, tables = memo["pdf"]
    i = bisect_left(tables, at)
    return end + 5 if end >= at and i < len(tables) and tables[i] + 9 <= end and b[at + 5 : at + 6].isdigit() else None


def _zip(b: bytes, at: int, memo: dict) -> int | None:
    if "zip" not in memo:
        # an end record says how far before it its archive begins, so one pass over the records tells all archives' ends
        ends: dict[int, int] = {}
        for tail in _places(b, b"PK\x05\x06"):
            if tail + 22 <= len(b):
                size, start, note = struct.unpack_from("<IIH", b, tail + 12)
                if tail + 22 + note <= len(b) and size <= tail and b[tail - size : tail - size + 4] == b"PK\x01\x02":
                    ends.setdefault(tail - size - start, tail + 22 + note)
        memo["zip"] = ends
    return memo["zip"].get(at)


def _flac(b: bytes, at: int) -> int | None:
    p, first = at + 4, True
    while p + 4 <= len(b):
        kind, size = b[p] & 0x7F, int.from_bytes(b[p + 1 : p + 4], "big")
        if first and (kind != 0 or size != 34) or kind == 0x7F:
            return None
        last, first, p = b[p] & 0x80, False, p + 4 + size
        if last:  # frames have no length: they go on to the end of the value
            return len(b) if p <= len(b) and (p == len(b) or b[p : p + 1] == b"\xff") else None
    return None


def _ogg(b: bytes, at: int, memo: dict) -> int | None:
    # pages follow one another, so a page's stream ends where that of the page behind it does
    ends, p, seen, out = memo.setdefault("ogg", {}), at, [], None
    while p not in ends and b[p : p + 4] == b"OggS" and p + 27 <= len(b) and b[p + 4] == 0:
        seen.append(p)
        table = b[p + 27 : p + 27 + b[p + 26]]
        end = p + 27 + len(table) + sum(table)
        if end > len(b):
            break
        last, p = b[p + 5] & 4, end
        if last:
            out = p
            break
    else:
        out = ends.get(p)
    ends.update(dict.fromkeys(seen, out))
    return out


def _gzip(b: bytes, at: int) -> int | None:
    unpack = zlib.decompressobj(31)
    p = at
    try:
        while p < len(b) and not unpack.eof:
            unpack.decompress(b[p : p + 65536])
            p += 65536
    except zlib.error:
        return None
    return min(p, len(b)) - len(unpack.unused_data) if unpack.eof else None


VALIDATORS = {"audio/wav": _wav, "image/png": _png, "image/gif": _gif, "image/jpeg": _jpeg, "image/bmp": _bmp, "application/pdf": _pdf, "application/zip": _zip, "audio/flac": _flac, "audio/ogg": _ogg, "application/gzip": _gzip}

#: Those that look beyond their own structure get what was found out about the value before, so that many candidates cost one pass.
WITH_MEMO = frozenset({_pdf, _zip, _ogg})

_automata: list = []


def automaton():
    """The Aho-Corasick automaton over all magic bytes, kept per process; bytes are looked up as the characters of the same numbers."""
    if not _automata:
        import ahocorasick

        made = ahocorasick.Automaton()
        for magic, kind in MAGIC.items():
            made.add_word(magic.decode("latin-1"), (len(magic), kind))
        made.make_automaton()
        _automata.append(made)
    return _automata[0]


def sniff(value: bytes) -> list[tuple[str, int, int]]:
    """(type, start, end) of every valid medium that isn't inside an earlier one, in order; media inside are found by sniffing the part."""
    found, past, memo = [], 0, {}
    for last, (size, kind) in automaton().iter(value.decode("latin-1")):
        start, valid = last + 1 - size, VALIDATORS[kind]
        if start >= past and (end := valid(value, start, memo) if valid in WITH_MEMO else valid(value, start)) is not None:
            found.append((kind, start, end))
            past = end
    return found


def wav_of(payload: bytes, rate: int = 8000) -> bytes:
    """The bytes as 8-bit mono samples in a RIFF/WAVE file."""
    pad = len(payload) & 1
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload + b"\0" * pad


def samples_of(wav: bytes) -> bytes:
    """The data chunk of a valid RIFF/WAVE file."""
    p = 12
    while wav[p : p + 4] != b"data":
        size = struct.unpack_from("<I", wav, p + 4)[0]
        p += 8 + size + (size & 1)
    return wav[p + 8 : p + 8 + struct.unpack_from("<I", wav, p + 4)[0]]


def _batches(rows: Iterator[tuple], schema: pa.Schema, size_at: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[size_at] or b"")
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _store(unit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 8 << 20):
            schema = pa.schema([("doc_id", block.column(0).type), ("n_bytes", pa.int64()), ("declared", pa.string()), ("media", pa.binary())])

            def rows(block=block):
                for doc, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                    raw = (text or "").encode()
                    yield doc, len(raw), "text/plain", wav_of(raw + b"\xff" * (-len(raw) % unit if raw else unit))

            yield from _batches(rows(), schema, 3)

    return run


def store_texts(docs: DataFrame, unit: int = 576) -> DataFrame:
    """(doc_id, n_bytes, declared, media): each text's UTF-8 bytes, filled up with 255 to a positive multiple of ``unit``, as a WAV file of 8-bit samples.

    The declared type is that of the source column, text/plain, so that what is
    read back must be told from the bytes.
    """
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(tidy(_store(unit)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, declared string, media binary")


def features(samples: bytes) -> str:
    """Count, mean, deviation from it, and crossings of the middle, of 8-bit samples."""
    x = np.frombuffer(samples, np.uint8)
    if not len(x):
        return "n=0"
    total, squares = int(x.sum(dtype=np.int64)), int(np.bincount(x, minlength=256) @ np.arange(256, dtype=np.int64) ** 2)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"n={len(x)};mean={total / len(x):.4f};var={squares / len(x) - (total / len(x)) ** 2:.3f};crossings={crossings}"


def _sniff(media_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carved = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for block in blocks(batches, "media", 8 << 20):
            schema = pa.schema([*[(n, c.type) for n, c in zip(block.schema.names, block.columns, strict=True)], ("media_type", pa.string()), ("carved", carved), ("payload", pa.binary()), ("feature", pa.string())])
            kinds, cuts, payloads, marks = [], [], [], []
            for value in block.column(media_at):
                raw = value.as_py() or b""
                found = sniff(raw)
                whole = bool(found) and found[0][1] == 0
                kind = found[0][0] if whole else UNKNOWN
                payload = raw
                inside: list[tuple[str, int, int]] = found[whole:]
                if kind == "audio/wav":
                    payload = samples_of(raw[: found[0][2]])
                    inside = sniff(payload) + inside
                kinds.append(kind)
                cuts.append([{"type": t, "start": s, "end": e} for t, s, e in inside])
                payloads.append(payload)
                marks.append(f"{kind};{features(payload)};embedded={len(inside)}")
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(kinds, pa.string()), pa.array(cuts, carved), pa.array(payloads, pa.binary()), pa.array(marks, pa.string())], schema=schema)

    return run


def sniff_column(df: DataFrame) -> DataFrame:
    """``df`` (with a binary column ``media``) with media_type (told from the bytes), carved (media inside the payload, or behind the first medium), payload (a WAV file's samples, else the value) and feature."""
    df = df.select(*[c for c in df.columns if c not in ("media_type", "carved", "payload", "feature")])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(tidy(_sniff(df.columns.index("media"))), f"{kinds}, media_type string, carved array<struct<type: string, start: long, end: long>>, payload binary, feature string")


def corrected(df: DataFrame) -> DataFrame:
    """``df`` (with declared and media_type) with ``type``: the sniffed one where there is one, else the declared one."""
    return df.withColumn("type", F.when(F.col("media_type") == UNKNOWN, F.coalesce("declared", "media_type")).otherwise(F.col("media_type")))
