import gzip
import hashlib
import io
import struct
import zipfile
import zlib

from tests.conftest import DATA
from tidewater.llm import media, queries


def png() -> bytes:
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\7")) + chunk(b"IEND", b"")


def zipped() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "inside")
    return out.getvalue()


GIF = b"GIF89a\1\0\1\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\1\0\1\0\0\2\2D\1\0;"
JPEG = b"\xff\xd8\xff\xe0\0\x04ab\xff\xda\0\x03\0pix\xff\0els\xff\xd9"
BMP = struct.pack("<2sIIIIiiHHIIiiII", b"BM", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\1\2\3\0"
PDF = b"%PDF-1.4\n1 0 obj\nendobj\nstartxref\n9\n%%EOF"
OGG = b"OggS\0\6" + b"\0" * 20 + b"\1\3abc"
FLAC = b"fLaC\x80\0\0\x22" + b"s" * 34

SAMPLES = {"audio/wav": media.wav_of(b"abc" * 9), "image/png": png(), "image/gif": GIF, "image/jpeg": JPEG, "image/bmp": BMP, "application/pdf": PDF, "application/zip": zipped(), "audio/ogg": OGG, "audio/flac": FLAC, "application/gzip": gzip.compress(b"text")}


def test_each_format_is_found_and_carved():
    for kind, value in SAMPLES.items():
        assert media.sniff(value) == [(kind, 0, len(value))], kind
        if kind != "audio/flac":  # its frames go on to the end
            inside = b"some text BM RIFF " + value + b" more"
            assert (kind, 18, 18 + len(value)) in media.sniff(inside), kind


def test_broken_structures_are_not_media():
    for kind, value in SAMPLES.items():
        assert media.sniff(value[: len(value) // 2])[:1] != [(kind, 0, len(value))]
    broken = bytearray(png())
    broken[20] ^= 1
    assert media.sniff(bytes(broken)) == []
    assert media.sniff(b"RIFF is a word, BM too, and PK\x03\x04") == []


def test_round_trip(spark):
    texts = [(1, None), (2, ""), (3, "é" * 288), (4, "RIFF....WAVEfmt BM %PDF-1" * 50), (5, "é" * 288), (None, "x")]
    out = media.corrected(media.sniff_column(media.store_texts(spark.createDataFrame(texts, "doc_id long, text string"))))
    rows = {r["doc_id"]: r for r in out.collect()}
    for d, text in texts:
        raw = (text or "").encode()
        want = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        assert bytes(rows[d]["payload"]) == want and rows[d]["n_bytes"] == len(raw)
        assert (rows[d]["declared"], rows[d]["media_type"], rows[d]["type"]) == ("text/plain", "audio/wav", "audio/wav")
    assert rows[3]["feature"] == rows[5]["feature"]


def test_carves_from_the_payload_and_corrects(spark):
    df = spark.createDataFrame([("audio/wav", png()), ("image/png", media.wav_of(b"--" + GIF + b"--")), ("text/plain", b"nothing"), (None, None)], "declared string, media binary").selectExpr("*", "1 AS payload", "'x' AS feature")
    rows = media.corrected(media.sniff_column(df)).collect()
    assert [r["type"] for r in rows] == ["image/png", "audio/wav", "text/plain", media.UNKNOWN]
    assert [(x["type"], x["start"], x["end"]) for x in rows[1]["carved"]] == [("image/gif", 2, 2 + len(GIF))]


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in queries.QUERIES["op8_media_columns"](spark, DATA).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        raw += b"\xff" * (576 if not raw else -len(raw) % 576)
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]))
        assert r["media_sha256"] == hashlib.sha256(media.wav_of(raw)).hexdigest()


def test_empty_table(spark):
    assert media.sniff_column(media.store_texts(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def plain_sniff(value):
    """Every candidate searched to the end of the value, as the formats say."""
    found, past = [], 0
    for at in range(len(value)):
        end = None
        if at < past:
            continue
        if value.startswith(b"%PDF-", at) and value[at + 5 : at + 6].isdigit():
            last = value.rfind(b"%%EOF", at)
            end = last + 5 if last >= 0 and value.find(b"startxref", at, last) >= 0 else None
            kind = "application/pdf"
        elif value.startswith(b"PK\x03\x04", at):
            kind, tail = "application/zip", value.find(b"PK\x05\x06", at)
            while tail >= 0 and tail + 22 <= len(value) and end is None:
                size, start, note = struct.unpack_from("<IIH", value, tail + 12)
                if start + size == tail - at and value[at + start : at + start + 4] == b"PK\x01\x02" and tail + 22 + note <= len(value):
                    end = tail + 22 + note
                tail = value.find(b"PK\x05\x06", tail + 4)
        elif value.startswith(b"OggS", at):
            kind, p = "audio/ogg", at
            while end is None and value[p : p + 4] == b"OggS" and p + 27 <= len(value) and value[p + 4] == 0:
                table = value[p + 27 : p + 27 + value[p + 26]]
                last, p = value[p + 5] & 4, p + 27 + len(table) + sum(table)
                if p > len(value):
                    break
                end = p if last else None
        if end is not None:
            found.append((kind, at, end))
            past = end
    return found


def test_carving_is_that_of_a_plain_search():
    import random

    rng = random.Random(2)
    page = lambda last: b"OggS\0" + (b"\4" if last else b"\0") + b"\0" * 20 + b"\1\3abc"
    parts = [b"%PDF-", b"%PDF-1", b"startxref", b"%%EOF", b"PK\x03\x04", b"PK\x05\x06" + b"\0" * 18, zipped(), zipped()[:-5], page(False), page(True), PDF, OGG, b"text ", b"Og"]
    for _ in range(300):
        value = b"".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert media.sniff(value) == plain_sniff(value), value


def test_a_million_markers_take_linear_time():
    import time

    for mark in (b"%PDF-1 ", b"PK\x03\x04 ", b"PK\x05\x06" + b" " * 18, b"OggS\0\0" + b"\0" * 21):
        began = time.time()
        assert media.sniff(mark * (1_000_000 if len(mark) < 10 else 200_000)) == []
        assert time.time() - began < 20, mark
