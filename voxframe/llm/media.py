"""Media columns: stored forms, and types told from their bytes.

Aho-Corasick finds all magic strings in one pass over the bytes. A validator for each format then reads the
structure from that place on (chunk lengths, checksums, end marks) and gives the length, or rejects the find; so a
chance occurrence of two letters is no media. Validators share what they find in a value, so the work on one grows in
proportion to its length however many magic strings it has. The find at place 0 that fills the value corrects a wrong declared
type; confirmed finds elsewhere are embedded media and can be carved out. Inside a confirmed find no further ones
are looked for, except where its samples are raw, as in WAV and PGM.

Null bytes have no finds; empty ones neither. A format that isn't known leaves the declared type.

Rows are stored and told by themselves: repeated rows and ties come out alike, an empty table gives no rows. `text_payloads`
leaves extra columns out, whatever their names; `sniff_column` keeps them, save those named like its own.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mapped

UNIT = 192


class Value:
    """One value's bytes, and what the validators have found in it so far.

    Many magic strings may lie before the same chunks or end marks. Where a walk through chunks goes on from a place
    doesn't depend on where it began, so each place is looked at once; end marks are found once, in one pass.
    """

    def __init__(self, data: bytes):
        self.data = data
        self.walks: dict[object, dict[int, tuple[int | None, bool]]] = {}

    def walk(self, kind: object, at: int, step: Callable[[bytes, int], tuple[int | None, bool, bool]]) -> tuple[int | None, bool]:
        """Where the walk from `at` ends (None: not well formed), and whether a place on it was marked.

        step(data, place) gives the next place or the end or None, whether the walk is over, and the place's mark.
        """
        known, passed, over, here = self.walks.setdefault(kind, {}), [], False, at
        while not over and here not in known:
            after, over, mark = step(self.data, here)
            passed.append((here, mark))
            over = over or after is None
            here = after
        end, marked = (here, False) if over else known[here]
        for place, mark in reversed(passed):
            marked |= mark
            known[place] = end, marked
        return end, marked

    @cached_property
    def pdf_ends(self) -> tuple[list[int], list[int]]:
        """Ends of the end marks that a well-formed number stands before, and how far right a file that ends there can begin, the furthest so far."""
        ends, latest = [], []
        for m in re.finditer(rb"startxref\s{1,8}(\d{1,20})\s{1,8}%%EOF", self.data):
            begins = min(m.start(), m.end() - 5 - int(m[1]) - 1)
            if begins >= 0 and begins > (latest[-1] if latest else -1):  # else an earlier end serves all that begin there
                ends.append(m.end())
                latest.append(begins)
        return ends, latest

    @cached_property
    def zip_ends(self) -> dict[int, int]:
        """Where an archive begins, by its first end record whose directory lies where it says: where it ends."""
        out: dict[int, int] = {}
        for m in re.finditer(rb"(?=PK\x05\x06)", self.data):
            i = m.start()
            if i + 22 > len(self.data):
                break
            n, size, start, comment = struct.unpack_from("<HIIH", self.data, i + 10)
            begins, directory = i - size - start, i - size
            if begins >= 0 and (not n or self.data[directory : directory + 4] == b"PK\x01\x02") and i + 22 + comment <= len(self.data):
                out.setdefault(begins, i + 22 + comment)
        return out


def _span(at: int, end: int | None) -> int | None:
    return None if end is None else end - at


def _png(v: Value, at: int) -> int | None:
    def chunk(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if i + 12 > len(b):
            return None, True, False
        n, kind = struct.unpack_from(">I4s", b, i)
        good = i + 12 + n <= len(b) and zlib.crc32(memoryview(b)[i + 4 : i + 8 + n]) == struct.unpack_from(">I", b, i + 8 + n)[0]
        return i + 12 + n if good else None, kind == b"IEND", False

    if v.data[at + 8 : at + 16] != b"\0\0\0\rIHDR":
        return None
    return _span(at, v.walk("png", at + 8, chunk)[0])


def _gif(v: Value, at: int) -> int | None:
    def blocks(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        """A run of data blocks: place of its next length byte, until one is zero."""
        if i >= len(b):
            return None, True, False
        return (i + 1, True, False) if not b[i] else (i + 1 + b[i], False, False)

    def part(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if i >= len(b):
            return None, True, False
        if b[i] == 0x3B:
            return i + 1, True, False
        if b[i] == 0x21:
            first = i + 2
        elif b[i] == 0x2C and i + 10 < len(b):
            first = i + 11 + (3 << (b[i + 9] & 7) + 1 if b[i + 9] & 0x80 else 0)
        else:
            return None, True, False
        return v.walk("gif blocks", first, blocks)[0], False, False

    if at + 13 > len(v.data):
        return None
    flags = v.data[at + 10]
    return _span(at, v.walk("gif", at + 13 + (3 << (flags & 7) + 1 if flags & 0x80 else 0), part)[0])


def _jpeg(v: Value, at: int) -> int | None:
    def segment(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if i + 2 > len(b) or b[i] != 0xFF:
            return None, True, False
        kind = b[i + 1]
        if kind == 0xD9:
            return i + 2, True, False
        n = struct.unpack_from(">H", b, i + 2)[0] if i + 4 <= len(b) else 0
        if n < 2:
            return None, True, False
        frame, i = 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC), i + 2 + n
        if kind == 0xDA:  # scan data last to the next marker that isn't a restart or a stuffed byte
            i = v.walk("jpeg scan", i, scan)[0]
        return i, False, frame

    def scan(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        i = b.find(b"\xff", i)
        if i < 0 or i + 1 >= len(b):
            return None, True, False
        return (i, True, False) if b[i + 1] != 0 and not 0xD0 <= b[i + 1] <= 0xD7 else (i + 2, False, False)

    end, frames = v.walk("jpeg", at + 2, segment)
    return _span(at, end) if frames else None


def _riff(v: Value, at: int, form: bytes, needed: tuple[bytes, ...]) -> int | None:
    if at + 12 > len(v.data) or v.data[at + 8 : at + 12] != form:
        return None
    end = at + 8 + struct.unpack_from("<I", v.data, at + 4)[0]
    if end > len(v.data):
        return None

    def chunk(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if i in (end, end + 1):
            return end, True, False
        if i + 8 > end:
            return None, True, False
        kind, n = struct.unpack_from("<4sI", b, i)
        return i + 8 + n + n % 2, False, kind in needed

    found, marked = v.walk((form, end), at + 12, chunk)
    return _span(at, found) if marked else None


def _wav(v: Value, at: int) -> int | None:
    return _riff(v, at, b"WAVE", (b"data",)) if v.data[at + 12 : at + 16] == b"fmt " else None


def _webp(v: Value, at: int) -> int | None:
    return _riff(v, at, b"WEBP", (b"VP8 ", b"VP8L", b"VP8X"))


def _bmp(v: Value, at: int) -> int | None:
    if at + 30 > len(v.data):
        return None
    size, zero, start, header, _, _, planes, depth = struct.unpack_from("<IIIIiiHH", v.data, at + 2)
    good = zero == 0 and header in (12, 40, 52, 56, 64, 108, 124) and planes == 1 and depth in (1, 4, 8, 16, 24, 32) and 14 + header <= start <= size <= len(v.data) - at
    return size if good else None


def _gzip(v: Value, at: int) -> int | None:
    b = v.data
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return None
    stream = zlib.decompressobj(31)
    try:
        i = at
        while i < len(b) and not stream.eof:
            rest = b[i : i + 65536]
            while rest and not stream.eof:  # a little at a time: a few bytes may stand for very many
                stream.decompress(rest, 1 << 20)
                rest = stream.unconsumed_tail
            i += 65536
    except zlib.error:
        return None
    return min(i, len(b)) - at - len(stream.unused_data) if stream.eof else None


def _zip(v: Value, at: int) -> int | None:
    return _span(at, v.zip_ends.get(at))


def _pdf(v: Value, at: int) -> int | None:
    ends, latest = v.pdf_ends
    k = bisect_left(latest, at)
    return ends[k] - at if k < len(ends) else None


def _flac(v: Value, at: int) -> int | None:
    def block(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if i + 4 > len(b):
            return None, True, False
        after = i + 4 + int.from_bytes(b[i + 1 : i + 4], "big")
        if b[i] & 0x80:  # frames have no total length: the stream lasts to the end
            return len(b) if b[after : after + 1] == b"\xff" else None, True, False
        return after, False, False

    if at + 8 > len(v.data) or v.data[at + 4] & 0x7F or v.data[at + 5 : at + 8] != b"\0\0\x22":
        return None
    return _span(at, v.walk("flac", at + 4, block)[0])


def _ogg(v: Value, at: int) -> int | None:
    def page(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if b[i : i + 4] != b"OggS" or i + 27 > len(b):
            return i if i <= len(b) else None, True, False
        if b[i + 4]:
            return None, True, False
        n = b[i + 26]
        after = i + 27 + n + sum(b[i + 27 : i + 27 + n])
        return after if after <= len(b) else None, bool(b[i + 5] & 4), True

    end, pages = v.walk("ogg", at, page)
    return _span(at, end) if pages else None


def _mp4(v: Value, at: int) -> int | None:
    def box(b: bytes, i: int) -> tuple[int | None, bool, bool]:
        if i + 8 > len(b):
            return i, True, False
        n, kind = struct.unpack_from(">I4s", b, i)
        if n == 1 and i + 16 <= len(b):
            n = struct.unpack_from(">Q", b, i + 8)[0]
        if n < 8 or i + n > len(b) or not kind.isalnum():
            return i, True, False
        return i + n, False, kind in (b"moov", b"mdat", b"meta", b"moof")

    end, media = v.walk("mp4", at, box) if at >= 0 else (None, False)
    return _span(at, end) if media else None


# Magic bytes, how far they stand behind the beginning, the type and its validator.
FORMATS = [
    (b"\x89PNG\r\n\x1a\n", 0, "image/png", _png),
    (b"GIF87a", 0, "image/gif", _gif),
    (b"GIF89a", 0, "image/gif", _gif),
    (b"\xff\xd8\xff", 0, "image/jpeg", _jpeg),
    (b"RIFF", 0, "audio/wav", _wav),
    (b"RIFF", 0, "image/webp", _webp),
    (b"BM", 0, "image/bmp", _bmp),
    (b"\x1f\x8b\x08", 0, "application/gzip", _gzip),
    (b"PK\x03\x04", 0, "application/zip", _zip),
    (b"%PDF-", 0, "application/pdf", _pdf),
    (b"fLaC", 0, "audio/flac", _flac),
    (b"OggS", 0, "audio/ogg", _ogg),
    (b"ftyp", 4, "video/mp4", _mp4),
]
RAW = {"audio/wav"}


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    by: dict[bytes, list] = {}
    for magic, back, kind, valid in FORMATS:
        by.setdefault(magic, []).append((len(magic) - 1 + back, kind, valid))
    for magic, formats in by.items():
        out.add_word(magic.decode("latin-1"), formats)
    out.make_automaton()
    return out


AUTOMATON = _automaton()


def sniff(data: bytes | None) -> list[tuple[int, int, str]]:
    """(place, length, type) of the confirmed media, in order; the longest at each place, none inside another's coded data."""
    if not data:
        return []
    value, found, beyond = Value(data), [], 0
    for last, formats in AUTOMATON.iter(data.decode("latin-1")):
        for back, kind, valid in formats:
            at = last - back
            if at >= beyond and (n := valid(value, at)):
                found.append((at, n, kind))
                if kind not in RAW:
                    beyond = at + n
    return sorted(found)


def sniff_column(df: DataFrame, column: str, declared: str | None = None) -> DataFrame:
    """df with media_type (corrected), type_confirmed, and found: array of (place, length, type)."""
    names = {x.lower() for x in df.columns}
    for own in ("media_type", "type_confirmed", "found"):
        if own in names:
            df = df.drop(own)

    @F.udf("media_type string, type_confirmed boolean, found array<struct<place:long,length:long,type:string>>", useArrow=True)
    def told(data, said):
        finds = sniff(bytes(data) if data is not None else None)
        whole = [x for x in finds if x[0] == 0 and x[1] == len(data)] or [x for x in finds if x[0] == 0]
        kind = whole[0][2] if whole else said
        return kind, bool(whole), finds

    return df.withColumn("_told", told(F.col(column), F.col(declared) if declared else F.lit(None).cast("string"))).select("*", "_told.*").drop("_told")


def carve(data: bytes, find: tuple[int, int, str]) -> bytes:
    return data[find[0] : find[0] + find[1]]


def to_wav(samples: bytes, rate: int = 8000) -> bytes:
    """One channel of unsigned 8-bit samples."""
    pad = b"\0" * (len(samples) % 2)
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(fmt) + 8 + len(samples) + len(pad), b"WAVE") + fmt + struct.pack("<4sI", b"data", len(samples)) + samples + pad


def from_wav(data: bytes) -> bytes:
    """The samples of a mono 8-bit WAV."""
    i, end = 12, 8 + struct.unpack_from("<I", data, 4)[0]
    while i + 8 <= end:
        kind, n = struct.unpack_from("<4sI", data, i)
        if kind == b"data":
            return data[i + 8 : i + 8 + n]
        i += 8 + n + n % 2
    raise ValueError("no samples")


def features(samples: bytes) -> str:
    """Mean, deviation, zero crossings and entropy of 8-bit samples."""
    a = np.frombuffer(samples, dtype=np.uint8)
    share = np.bincount(a, minlength=256) / max(1, len(a))
    mean = float(share @ np.arange(256))
    spread = float(np.sqrt(max(0.0, share @ (np.arange(256) - mean) ** 2)))
    crossings = int(np.count_nonzero(np.diff(a >= 128)))
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    return f"mean={mean:.4f};std={spread:.4f};crossings={crossings};entropy={entropy:.4f}"


def text_payloads(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Each text stored as audio, found again by its bytes alone, read back and measured.

    The stored form is declared as an unknown type; sniffing must tell what it is and where it ends, and the samples
    come from the carved bytes. Text in it that looks like a magic string is judged by the validators. A null
    text is stored like an empty one.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media_type", "n_embedded"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8")
                stored = to_wav(raw + b" " * (-len(raw) % UNIT if raw else UNIT))
                whole, *inside = sniff(stored)
                if whole[:2] != (0, len(stored)):
                    raise ValueError("the stored form wasn't recognised")
                payload = from_wav(carve(stored, whole))
                rows.append((doc, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), features(payload), whole[2], len(inside)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media_type string, n_embedded int"
    return mapped(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text")), store, schema)
