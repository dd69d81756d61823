"""WARC archives: a writer of one gzip member a record, and a reader whose tasks each take a range of bytes.

`df.write.format("warc")` writes columns row_id long, target_uri string, payload binary, payload_digest string, refers_to
long; a row with refers_to is a revisit and has no payload in the archive. A task writes files of its own, each begun by a
warcinfo record; those of attempts that failed are removed at the end of the job.

`spark.read.format("warc")` gives a row a record. A task looks in its range for gzip's magic bytes and takes a find for a
member if it decodes and begins with a record's head; from there on it goes from member to member, and owns the records
that start in its range (the last one may end behind it). Compressed data may hold a whole archive in blocks that deflate
only stored; such a block has 65,535 bytes at most, so a find counts only if members follow each other without a gap
for longer than that, or to the file's end. Damaged data behind the first member are an error. `gaps` names the files whose records don't
cover them.

Files are opened with pyarrow's file systems (local paths and file:, s3:, gs:, abfs: and hdfs: addresses). A record's
payload is held whole, its compressed bytes a megabyte at a time.

Null payloads count as empty. A null or empty address has no header; one with characters outside printable ASCII is
percent-encoded. Payloads of any length are kept whole. A row with a null id is a record like others, but none refers to
it. An empty table gives a folder without records. Rows that are equal in id and payload are both written, under one record
id; of those that share a payload and the smallest id, each is a response. `revisits` and `archived` ignore extra columns,
whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..scratch import new_path
from ._common import if_small, materialise

# The format's version and revisit profile, gzip's magic bytes, and the longest stored block of deflate.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
STORED = 65_535
READ = 1 << 20
#: Marks a record id that holds a row's id.
OURS = 0x2B5EED
SCHEMA = (
    "path string, file_bytes long, place long, length long, warc_type string, record_id string, row_id long, target_uri string, warc_date string, "
    "refers_to string, refers_to_row long, payload_digest string, http_length long, payload_bytes long, payload_sha256 string, payload binary"
)


# Record ids


def record_id(row: int | None, digest: str) -> str:
    """A version 8 UUID that holds the row's id and the first 32 bits of the payload's digest; a random one without an id."""
    if row is None:
        return f"<urn:uuid:{uuid.uuid4()}>"
    bits = row & (1 << 64) - 1
    low = (bits & 15) << 58 | OURS << 32 | int(digest[:8] or "0", 16)
    return f"<urn:uuid:{uuid.UUID(int=(bits >> 16) << 80 | 8 << 76 | (bits >> 4 & 0xFFF) << 64 | 2 << 62 | low)}>"


def row_of(name: str | None) -> int | None:
    """The row's id in a record id of ours."""
    try:
        n = uuid.UUID((name or "").strip("<>").removeprefix("urn:uuid:")).int
    except ValueError:
        return None
    if n >> 76 & 15 != 8 or n >> 32 & (1 << 26) - 1 != OURS:
        return None
    bits = (n >> 80) << 16 | (n >> 64 & 0xFFF) << 4 | (n >> 58 & 15)
    return bits - (1 << 64) if bits >> 63 else bits


# Writing


def member(kind: str, name: str, date: str, block: bytes, more: list[tuple[str, str]], level: int = 6) -> bytes:
    """A record as a gzip member."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), *more, ("Content-Length", str(len(block)))]
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join((gz.compress(text), gz.compress(block), gz.compress(b"\r\n\r\n"), gz.flush()))


def page_member(row: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, level: int = 6) -> bytes:
    """A response with its payload, or a revisit with the answer's head alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    more = [("WARC-Target-URI", quote(uri, safe="!#$%&'()*+,/:;=?@[]~"))] if uri else []
    more += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return member("response", record_id(row, digest), date, block + payload, more, level)
    more += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    return member("revisit", record_id(row, digest), date, block, more, level)


def _opened(where: str) -> tuple[fs.FileSystem, str]:
    if "://" in where:
        return fs.FileSystem.from_uri(where)
    return fs.LocalFileSystem(), where.removeprefix("file:")


@dataclass
class Files(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    """Files part-<task>-<job>-<attempt>-<number>.warc.gz of `fileBytes` at most, save the last record's share."""

    def __init__(self, options: dict, overwrite: bool):
        self.where, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.date = options.get("date") or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.level, self.file_bytes = int(options.get("level", 6)), int(options.get("fileBytes", 1 << 30))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Files:
        system, where = _opened(self.where)
        task, attempt, done, out, size = TaskContext.get().partitionId(), uuid.uuid4().hex[:8], Files(), None, 0
        for batch in batches:
            for row, uri, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("row_id", "target_uri", "payload", "payload_digest", "refers_to")), strict=True):
                if out is None or size >= self.file_bytes:
                    if out:
                        out.close()
                    done.names.append(f"part-{task:05d}-{self.job}-{attempt}-{len(done.names):04d}.warc.gz")
                    system.create_dir(where, recursive=True)
                    out = system.open_output_stream(f"{where}/{done.names[-1]}", compression=None)
                    about = b"software: voxframe\r\nformat: WARC File Format 1.1\r\n"
                    size = out.write(member("warcinfo", record_id(None, ""), self.date, about, [("WARC-Filename", done.names[-1]), ("Content-Type", "application/warc-fields")], self.level))
                size += out.write(page_member(row, uri, payload or b"", digest or hashlib.sha256(payload or b"").hexdigest(), refers_to, self.date, self.level))
        if out:
            out.close()
        return done

    def _remove_but(self, kept: set[str]) -> None:
        system, where = _opened(self.where)
        for info in system.get_file_info(fs.FileSelector(where, allow_not_found=True)):
            if info.is_file and info.base_name.endswith(".warc.gz") and info.base_name not in kept and (self.overwrite or self.job in info.base_name):
                system.delete_file(info.path)

    def commit(self, messages: list[Files | None]) -> None:
        system, where = _opened(self.where)
        system.create_dir(where, recursive=True)
        self._remove_but({name for m in messages if m for name in m.names})

    def abort(self, messages: list[Files | None]) -> None:
        self.overwrite = False
        self._remove_but(set())


# Reading


class Window:
    """Bytes of a file by their place, the last stretch that was read being kept."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def take(self, place: int, n: int) -> bytes:
        """Up to n bytes from a place."""
        if not self.at <= place or place + n > self.at + len(self.held):
            if place >= self.size:
                return b""
            self.file.seek(place)
            self.at, self.held = place, self.file.read(max(n, READ))
        return self.held[place - self.at : place - self.at + n]

    def find(self, first: int, end: int) -> int:
        """The first magic bytes that begin at a place from `first` to below `end`; -1 if there are none."""
        while first < end:
            piece = self.take(first, min(READ, end - first + len(MAGIC) - 1))
            at = piece.find(MAGIC)
            if 0 <= at < end - first:
                return first + at
            if len(piece) < len(MAGIC):
                return -1
            first += len(piece) - len(MAGIC) + 1
        return -1


def decoded(window: Window, place: int, head_only: bool = False) -> tuple[bytes, int] | None:
    """A member's content and the place behind it; None if there is no member. head_only: as soon as it can't be a record, None."""
    gz, parts, at = zlib.decompressobj(31), [], place
    try:
        while not gz.eof:
            piece = window.take(at, 1 << 16)
            if not piece:
                return None
            parts.append(gz.decompress(piece))
            at += len(piece) - len(gz.unused_data)
            if head_only and not VERSION.startswith(b"".join(parts[:3])[: len(b"WARC/")]):
                return None
    except zlib.error:
        return None
    return b"".join(parts), at


def parsed(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """A record's headers, names in lower case, and its block; None if it isn't whole."""
    cut = content.find(b"\r\n\r\n")
    lines = content[:cut].decode("utf-8", "replace").split("\r\n")
    if cut < 0 or not lines[0].startswith("WARC/"):
        return None
    head: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            head[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon:
            return None
        head[name] = value.strip()
    length = head.get("content-length", "")
    if not {"warc-type", "warc-record-id", "warc-date"} <= head.keys() or not length.isdigit() or cut + 4 + int(length) + 4 != len(content) or not content.endswith(b"\r\n\r\n"):
        return None
    return head, content[cut + 4 : -4]


def _record(window: Window, place: int, head_only: bool = False) -> tuple[dict[str, str], bytes, int] | None:
    found = decoded(window, place, head_only)
    record = found and parsed(found[0])
    return (*record, found[1]) if record else None


def _confirmed(window: Window, place: int) -> bool:
    """Whether members follow each other from a place for longer than a stored block, or to the end."""
    at = place
    while at < window.size and at - place <= STORED + len(MAGIC):
        record = _record(window, at, head_only=True)
        if record is None:
            return False
        at = record[2]
    return True


def records(window: Window, first: int, end: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Place, compressed length, headers and block of the records that start from `first` to below `end`."""
    at = first
    if first:
        at = window.find(first, end)
        while at >= 0 and not _confirmed(window, at):
            at = window.find(at + 1, end)
    while 0 <= at < min(end, window.size):
        record = _record(window, at)
        if record is None:
            raise ValueError(f"no whole record at byte {at}")
        head, block, after = record
        yield at, after - at, head, block
        at = after


@dataclass
class Ranges(InputPartition):
    #: Path, size of the file, first byte and the one behind the last.
    each: list[tuple[str, int, int, int]]


class WarcReader(DataSourceReader):
    """Option splitBytes: bytes a task reads; payload: whether payloads come along (else only their length and digest)."""

    def __init__(self, options: dict):
        self.where, self.split = options["path"], max(1, int(options.get("splitbytes", options.get("splitBytes", 32 << 20))))
        self.payload = options.get("payload", "true").lower() == "true"

    def partitions(self) -> list[Ranges]:
        system, where = _opened(self.where)
        if (info := system.get_file_info(where)).is_file:
            files = [info]
        else:
            files = sorted((f for f in system.get_file_info(fs.FileSelector(where)) if f.is_file and f.base_name.endswith(".warc.gz")), key=lambda f: f.path)
        out, room = [], 0
        for f in files:
            for a in range(0, f.size, self.split):
                part = (f.path, f.size, a, min(f.size, a + self.split))
                if out and part[3] - a <= room:  # small files share a task
                    out[-1].each.append(part)
                    room -= part[3] - a
                else:
                    out.append(Ranges([part]))
                    room = self.split - (part[3] - a)
        return out or [Ranges([])]

    def read(self, part: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.where)
        rows, size = [], 0
        for path, file_bytes, first, end in part.each:
            with system.open_input_file(path) as file:
                try:
                    for place, length, head, block in records(Window(file, file_bytes), first, end):
                        rows.append(self._row(path, file_bytes, place, length, head, block))
                        size += len(block) if self.payload else 0
                        if len(rows) >= 5000 or size >= 16 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e
        if rows:
            yield _batch(rows)

    def _row(self, path: str, file_bytes: int, place: int, length: int, head: dict[str, str], block: bytes) -> tuple:
        kind, payload, stated = head["warc-type"], block, None
        if head.get("content-type", "").startswith("application/http"):
            lines, _, payload = block.partition(b"\r\n\r\n")
            stated = next((int(v) for k, _, v in (x.partition(b":") for x in lines.split(b"\r\n")[1:]) if k.strip().lower() == b"content-length" and v.strip().isdigit()), None)
        if kind == "revisit":
            payload = None
        digest = head.get("warc-payload-digest")
        return (
            path, file_bytes, place, length, kind, head["warc-record-id"], row_of(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-date"],
            head.get("warc-refers-to"), row_of(head.get("warc-refers-to")), digest, stated, None if payload is None else len(payload),
            None if payload is None else hashlib.sha256(payload).hexdigest(), payload if self.payload else None,
        )


KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in SCHEMA.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


# Rows of pages


def revisits(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = 100) -> DataFrame:
    """row_id, target_uri, payload, payload_digest and refers_to (null for a response) of each page.

    Of the pages with equal payloads of at least `least` bytes, all refer to the one with the smallest id. Payloads that
    come once take no part in the join. The most frequent ones (more than a thousandth of these rows each, so under a
    thousand of them) are sent to the pages; so are the others while they are few, else pages are shuffled by digest.
    """
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("row_id"), F.col(uri).cast("string").alias("target_uri"), data.alias("payload"), F.sha2(data, 256).alias("payload_digest"))
    groups = rows.where(F.octet_length("payload") >= least).groupBy("payload_digest").agg(F.min("row_id").alias("_first"), F.count("*").alias("_n"))
    again = materialise(groups.where("_n > 1 and _first is not null"), "payloads")
    total = again.agg(F.sum("_n")).first()[0] or 0
    often, rest = again.where(F.col("_n") * 1000 > total), again.where(F.col("_n") * 1000 <= total)
    out = _with_first(rows, F.broadcast(often), F.lit(None).cast("long"))
    out = _with_first(out, if_small(rest, 200_000), F.col("_refers"))
    # the first one itself is a response, and so is one whose id is null only if all are
    return out.withColumn("refers_to", F.when(~F.col("row_id").eqNullSafe(F.col("_refers")), F.col("_refers"))).drop("_refers")


def _with_first(rows: DataFrame, groups: DataFrame, so_far: Column) -> DataFrame:
    """rows with _refers; those that have one go to a group of their own, so that no task gets all of them."""
    names = groups.select(F.col("payload_digest").alias("_digest"), "_first")
    meets = F.when(so_far.isNull(), F.col("payload_digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("row_id", "target_uri").cast("string")))
    joined = rows.withColumn("_refers", so_far).withColumn("_meets", meets).join(names, F.col("_meets") == F.col("_digest"), "left")
    return joined.withColumn("_refers", F.coalesce("_refers", "_first")).drop("_meets", "_digest", "_first")


def write(rows: DataFrame, where: str, level: int = 6, date: str | None = None) -> None:
    """Write rows as `revisits` gives them."""
    rows.sparkSession.dataSource.register(WarcSource)
    writer = rows.select("row_id", "target_uri", "payload", "payload_digest", "refers_to").write.format("warc").mode("append").option("level", level)
    (writer.option("date", date) if date else writer).save(where)


def read(spark: SparkSession, where: str, payload: bool = True, split_bytes: int = 32 << 20) -> DataFrame:
    """A row a record; see the module for what a task reads."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("splitBytes", split_bytes).load(where)


def gaps(found: DataFrame) -> DataFrame:
    """path, file_bytes and covered of the files whose records leave bytes out."""
    return found.groupBy("path", "file_bytes").agg(F.sum("length").alias("covered")).where("covered <> file_bytes")


def page_records(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the records of pages.

    A response's length and digest are those of the payload that was read; a revisit's are those its head states.
    """
    pages = found.where(F.col("warc_type").isin("response", "revisit"))
    return pages.select(
        F.col("row_id").alias("page_id"),
        F.coalesce("payload_bytes", "http_length").alias("payload_bytes"),
        F.coalesce("payload_sha256", F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.col("refers_to_row").alias("refers_to"),
    )


def archived(pages: DataFrame, split_bytes: int = 32 << 20) -> DataFrame:
    """Pages written to an archive in the shared folder and read back."""
    where = new_path(pages.sparkSession, "warc")
    write(revisits(pages), where)
    return page_records(read(pages.sparkSession, where, payload=False, split_bytes=split_bytes))
