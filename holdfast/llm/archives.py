"""WARC records in ZIP-packaged archives, written by tasks and read back by ranges, without extraction.

A writing task packs its records into archives of some ``ARCHIVE_BYTES``: a WARC file with one gzip member per record and
its CDXJ index, both stored, so that a record is a range of the archive. Archives are streamed, with ZIP64 sizes throughout.
Equal payloads of ``LEAST`` bytes or more are kept once, in the record of the smallest key; the others are revisits that refer to it.

A reading task parses the end of an archive, its ZIP64 records and central directory, finds where stored members begin,
and reads the index line by line. What it gives out is one row per record: archive, place, length. Spark sorts these rows
by place and deals them out evenly, however large an archive is; neighbours are read in one range of at most ``READ_BYTES``
or one record. A WARC member that no index names is walked from its start, in blocks.

Files are opened through Arrow's file systems by the folder's URI. Every attempt of a task writes under a name of its own
and only the names that Spark has committed are read, so lost or repeated tasks leave no trace in the result.

A null payload is empty. Of rows alike in key and payload one is the response, the others revisit it; a null key comes after
all others and is referred to as null. A null URL is left out. The rows' numbers come from the scan: the pages must be a table
that gives the same rows in the same order when read twice, as files do. Other columns are not read. An empty table gives no archives.
"""

from __future__ import annotations

import gzip
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import shared_folder, text_of, written

#: Payloads of fewer bytes are written whole each time.
LEAST = 100
ARCHIVE_BYTES, READ_BYTES, BLOCK = 64 << 20, 4 << 20, 1 << 20
#: Parts that the rows of one payload are dealt to.
SALTS = 64
DATE = "1970-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the ZIP format: signatures and the largest numbers of the plain fields.
LOCAL, DESCRIPTOR, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\7\x08", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
FULL16, FULL32, ZIP64_EXTRA = 0xFFFF, 0xFFFFFFFF, 1
#: January 1, 1980, the format's first day.
FIRST_DAY = 33


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class ZipStream:
    """Writes members one after the other into a stream that can't go back."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.members: list[tuple[bytes, int, int, int]] = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
        self._write(LOCAL + struct.pack("<5H3L2H", 45, 0x808, 0, 0, FIRST_DAY, 0, FULL32, FULL32, len(self.name), len(extra)) + self.name + extra)

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._write(data)

    def end(self) -> None:
        self._write(DESCRIPTOR + struct.pack("<LQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.start, self.crc, self.size))

    def close(self) -> None:
        start = self.at
        for name, place, crc, size in self.members:
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, size, size, place)
            head = struct.pack("<6H3L5H2L", 45, 45, 0x808, 0, 0, FIRST_DAY, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32)
            self._write(CENTRAL + head + name + extra)
        size, end, n = self.at - start, self.at, len(self.members)
        self._write(END64 + struct.pack("<QHHLLQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
        self._write(LOCATOR64 + struct.pack("<LQL", 0, end, 1))
        self._write(END + struct.pack("<4H2LH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


class Member(NamedTuple):
    name: str
    method: int
    #: where its local header begins, its bytes in the archive
    place: int
    size: int


def read_directory(file: pa.NativeFile) -> Iterator[Member]:
    """The members of an archive, from its end records and central directory, which is read in blocks."""
    total = file.size()
    tail_at = max(0, total - FULL16 - 22)
    tail = file.read_at(total - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: it has no end of central directory")
    disk, first_disk, _, n, size, start, _ = struct.unpack("<4H2LH", tail[at + 4 : at + 22])
    end = tail_at + at
    locator = file.read_at(20, end - 20) if end >= 20 else b""
    if locator[:4] == LOCATOR64:
        #: the stated place counts from the archive's first byte; data before it moves the record next to its locator
        stated = struct.unpack("<Q", locator[8:16])[0]
        record = file.read_at(56, stated) if stated + 56 <= total else b""
        if record[:4] != END64:
            stated = end - 20 - 56
            record = file.read_at(56, stated)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end of central directory is not where its locator says")
        disk, first_disk, _, n, size, start = struct.unpack("<LLQQQQ", record[16:56])
        end = stated
    if disk or first_disk:
        raise ValueError("the archive is one part of several")
    moved = end - size - start
    at, left, held = start + moved, size, b""
    for _ in range(n):
        while len(held) < 46 or len(held) < 46 + sum(struct.unpack("<3H", held[28:34])):
            if left <= 0:
                raise ValueError("the central directory ends early")
            held += file.read_at(min(BLOCK, left), at)
            at, left = at + BLOCK, left - BLOCK
        if held[:4] != CENTRAL:
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack("<HH", held[8:12])
        packed, plain = struct.unpack("<LL", held[20:28])
        names, extras, comments = struct.unpack("<3H", held[28:34])
        place = struct.unpack("<L", held[42:46])[0]
        if flags & 1:
            raise ValueError("a member is encrypted")
        extra = held[46 + names : 46 + names + extras]
        #: the wide values stand in this order, only those whose plain fields are full
        wide = iter(_wide(extra))
        plain = next(wide) if plain == FULL32 else plain
        packed = next(wide) if packed == FULL32 else packed
        place = next(wide) if place == FULL32 else place
        yield Member(held[46 : 46 + names].decode("utf-8" if flags & 0x800 else "cp437"), method, place + moved, packed)
        held = held[46 + names + extras + comments :]


def _wide(extra: bytes) -> list[int]:
    while len(extra) >= 4:
        kind, size = struct.unpack("<HH", extra[:4])
        if kind == ZIP64_EXTRA:
            return [v for (v,) in struct.iter_unpack("<Q", extra[4 : 4 + size // 8 * 8])]
        extra = extra[4 + size :]
    return []


def data_start(file: pa.NativeFile, member: Member) -> int:
    """The first byte of a member's data: behind its local header, whose name and extra field may differ from the directory's."""
    head = file.read_at(30, member.place)
    if head[:4] != LOCAL:
        raise ValueError(f"the member {member.name} does not begin where the directory says")
    return member.place + 30 + sum(struct.unpack("<HH", head[26:30]))


def member_blocks(file: pa.NativeFile, member: Member) -> Iterator[bytes]:
    """A member's contents, stored or deflated, in blocks."""
    start, left = data_start(file, member), member.size
    if member.method not in (0, 8):
        raise ValueError(f"the member {member.name} has the unknown method {member.method}")
    inflate = zlib.decompressobj(-15) if member.method else None
    while left > 0:
        block = file.read_at(min(BLOCK, left), start)
        start, left = start + BLOCK, left - BLOCK
        yield inflate.decompress(block) if inflate else block


def lines(blocks: Iterator[bytes], zipped: bool) -> Iterator[bytes]:
    inflate, held = zlib.decompressobj(31), b""
    for block in blocks:
        while zipped and block:
            held += inflate.decompress(block)
            block = inflate.unused_data
            inflate = zlib.decompressobj(31) if inflate.eof else inflate
        *whole, held = (held + (b"" if zipped else block)).split(b"\n")
        yield from whole
    yield held


def index_lines(raw: Iterator[bytes]) -> Iterator[tuple[str, int, int]]:
    """File name, place and length of the records in a CDXJ index; lines without them, such as headers, are passed over."""
    for line in raw:
        brace = line.find(b"{")
        if brace >= 0 and not line.startswith(b"!"):
            entry = json.loads(line[brace:])
            if {"filename", "offset", "length"} <= entry.keys():
                yield entry["filename"], int(entry["offset"]), int(entry["length"])


class Record(NamedTuple):
    type: str
    record_id: str | None
    refers_to: str | None
    target_uri: str | None
    digest: str | None
    #: what the HTTP header says of the payload, which a revisit leaves out
    payload_bytes: int | None
    payload: bytes | None


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def make_record(key: str | None, row: int, url: str | None, digest: str, size: int, payload: bytes | None, first: tuple[str | None, int] | None) -> bytes:
    """A response with its payload or, with ``first``, a revisit of the record that holds it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (b"" if first else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if first else 'response'}", f"WARC-Record-ID: <{record_name(key, row)}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {quote(url, safe=_URL)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    head += [f"WARC-Refers-To: <{record_name(*first)}>", f"WARC-Profile: {PROFILE}"] if first else []
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


#: Left as they are in a URL; white space, control characters and all beyond ASCII are written as percent codes.
_URL = "".join(map(chr, range(33, 127)))


def record_name(key: str | None, row: int) -> str:
    return f"urn:page:{'' if key is None else '=' + quote(key, safe='')}:{row}"


def parse_record(raw: bytes) -> tuple[Record, int]:
    """The first record in ``raw`` and the bytes it takes."""
    end = raw.find(b"\r\n\r\n")
    if end < 0 or not raw.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(raw[:end])
    size = int(fields["content-length"])
    block = raw[end + 4 : end + 4 + size]
    if len(block) < size:
        raise ValueError("a WARC record ends early")
    payload, stated = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http = block.find(b"\r\n\r\n")
        stated = _fields(block[:http]).get("content-length")
        payload = block[http + 4 :] if http >= 0 else b""
    bare = [fields.get(f, "")[1:-1] or None for f in ("warc-record-id", "warc-refers-to")]
    kind = fields.get("warc-type", "")
    found = Record(kind, *bare, fields.get("warc-target-uri"), fields.get("warc-payload-digest"), int(stated) if stated else None, None if kind == "revisit" else payload)
    return found, end + 4 + size + 4


def walk(blocks: Iterator[bytes]) -> Iterator[tuple[Record, int, int]]:
    """The records of a WARC member that has no index, with their places and lengths; one record is held at a time."""
    held, place, done = b"", 0, False
    blocks = iter(blocks)
    while True:
        try:
            if held[:2] == b"\x1f\x8b":
                inflate = zlib.decompressobj(31)
                plain = inflate.decompress(held)
                if not inflate.eof:
                    raise ValueError("a WARC record ends early")
                found, taken = parse_record(plain)[0], len(held) - len(inflate.unused_data)
            else:
                if len(held) < 2:
                    raise ValueError("a WARC record ends early")
                found, taken = parse_record(held)
                if taken > len(held) and not done:
                    raise ValueError("a WARC record ends early")
        except ValueError:
            if done:
                if held.strip():
                    raise
                return
            #: blocks double, so that a long record is not parsed anew for each
            more = [b for _, b in zip(range(max(1, len(held) // BLOCK)), blocks)]
            done = not more
            held += b"".join(more)
            continue
        yield found, place, taken
        held, place = held[taken:], place + taken


def _roles(pages: DataFrame, least: int) -> DataFrame:
    """row, first_key, first_row of the revisits; a group of copies is added up before it meets, and its rows are dealt to parts."""
    rows = pages.where(F.col("size") >= least).select("row", "key", "digest", "rank")
    first = F.min(F.struct(F.col("rank").isNull(), "rank", "row", "key")).alias("first")
    groups = rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("copies")).where("copies > 1")
    dealt = groups.select("digest", F.col("first.key").alias("first_key"), F.col("first.row").alias("first_row"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.select("row", "digest", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
    return salted.join(dealt, ["digest", "salt"]).where("row <> first_row").select("row", "first_key", "first_row")


def write_archives(
    pages: DataFrame, folder: str | None = None, *, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """path, records: the archives written into ``folder`` (a new one in the shared folder if not given), one record for each page."""
    folder = folder or f"{shared_folder(pages.sparkSession).rstrip('/')}/archives-{uuid.uuid4().hex}"
    text = text_of(f"`{payload}`")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("rank"), F.col(f"`{key}`").cast("string").alias("key"),
        F.col(f"`{url}`").cast("string").alias("url"), F.sha2(text, 256).alias("digest"), F.octet_length(text).alias("size"), text.alias("payload"),
    )
    #: written, so that Spark knows its size and broadcasts it only if that is small
    revisits = written(_roles(rows, least), "revisits")
    columns = ["key", "row", "url", "digest", "size", "payload", "first_key", "first_row"]
    sent = rows.join(revisits, "row", "left").withColumn("payload", F.when(F.col("first_row").isNull(), F.col("payload"))).select(columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        zipped, entries, name = None, [], ""

        def finish() -> pa.RecordBatch:
            zipped.end()
            zipped.begin(INDEX)
            zipped.write("".join(sorted(entries)).encode())
            zipped.end()
            zipped.close()
            zipped.out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(entries)], pa.int64())], ["path", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                own, row, link, digest, size, _, first_key, first_row = (batch.column(c)[i].as_py() if c != 5 else None for c in range(8))
                body = batch.column(5)[i]
                body = body.as_buffer().to_pybytes() if body.is_valid else None
                if zipped is None:
                    name = f"{uuid.uuid4().hex}.wacz"
                    zipped, entries = ZipStream(files.open_output_stream(f"{base}/{name}")), []
                    zipped.begin(DATA)
                first = None if first_row is None else (first_key, first_row)
                packed = gzip.compress(make_record(own, row, link, digest, size, body, first), 6, mtime=0)
                told = {"url": link or "", "digest": f"sha256:{digest}", "mime": "warc/revisit" if first else "text/html", "filename": DATA.split("/")[1],
                        "offset": zipped.size, "length": len(packed)}
                entries.append(f"{quote(link or '', safe=_URL)} {re.sub('[^0-9]', '', DATE)} {json.dumps(told)}\n")
                zipped.write(packed)
                if zipped.size >= archive_bytes:
                    yield finish()
                    zipped = None
        if zipped is not None:
            yield finish()

    return written(sent.mapInArrow(pack, "path string, records long"), "archive-names")


_PLACES = "path string, base long, offset long, length long, name string"


def record_places(archives: DataFrame) -> DataFrame:
    """path, base, offset, length, name: the records of the archives (``path``) by their indexes; base is where the WARC member's
    data begin. A member that is in no index is one row without an offset."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(path: str) -> Iterator[tuple]:
            files, place = open_folder(path)
            with files.open_input_file(place) as file:
                try:
                    members = list(read_directory(file))
                    data = {m.name: m for m in members if re.fullmatch(r"archive/.*\.warc(\.gz)?", m.name)}
                    for m in data.values():
                        if m.method:
                            raise ValueError(f"the member {m.name} is not stored, its records can't be read by ranges")
                    starts, named = {n: data_start(file, m) for n, m in data.items()}, set()
                    for m in members:
                        if re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", m.name):
                            for file_name, offset, length in index_lines(lines(member_blocks(file, m), m.name.endswith(".gz"))):
                                name = f"archive/{file_name}"
                                if name not in data or offset < 0 or offset + length > data[name].size:
                                    raise ValueError(f"the index names a record outside of {name}")
                                named.add(name)
                                yield path, starts[name], offset, length, name
                    for name in data.keys() - named:
                        yield path, starts[name], None, data[name].size, name
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e

        for batch in batches:
            for path in batch.column(0).to_pylist():
                part: list[tuple] = []
                for row in rows(path):
                    part.append(row)
                    if len(part) >= 10_000:
                        yield _batch(part)
                        part = []
                yield _batch(part)

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "base", "offset", "length", "name"])

    return archives.select("path").mapInArrow(find, _PLACES)


_RECORD = "path string, name string, offset long, length long, type string, record_id string, refers_to string, target_uri string, digest string, payload_bytes long, payload binary"


def read_records(archives: DataFrame, *, read_bytes: int = READ_BYTES, at_once: int = 8 << 20) -> DataFrame:
    """Every record of the archives: place, type, ids, digest, the payload's size by its header, and the payload (null for a revisit)."""
    places = record_places(archives)
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [f.split()[0] for f in _RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, pa.NativeFile | None] = ("", None)

        def file_of(path: str) -> pa.NativeFile:
            nonlocal opened
            if opened[0] != path:
                if opened[1] is not None:
                    opened[1].close()
                files, place = open_folder(path)
                opened = (path, files.open_input_file(place))
            return opened[1]

        def records(run: list[tuple]) -> Iterator[tuple]:
            path, base, offset, length, name = run[0]
            file = file_of(path)
            if offset is None:
                for found, at, size in walk(member_blocks_at(file, base, length)):
                    yield (path, name, at, size, *found)
                return
            end = max(r[2] + r[3] for r in run)
            raw = file.read_at(end - offset, base + offset)
            for _, _, at, size, _ in run:
                part = raw[at - offset : at - offset + size]
                found = parse_record(gzip.decompress(part) if part[:2] == b"\x1f\x8b" else part)[0]
                yield (path, name, at, size, *found)

        def runs() -> Iterator[list[tuple]]:
            run: list[tuple] = []
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    same = run and row[2] is not None and run[0][2] is not None and run[0][:2] == row[:2]
                    if run and not (same and row[2] + row[3] - run[0][2] <= read_bytes):
                        yield run
                        run = []
                    run.append(row)
            if run:
                yield run

        part, held = [], 0
        for run in runs():
            for row in records(run):
                part.append(row)
                held += len(row[-1] or b"")
                if held >= at_once or len(part) >= 4_096:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], k) for i, k in enumerate(kinds)], names)
                    part, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], k) for i, k in enumerate(kinds)], names)

    order = ["path", "base", "offset"]
    return places.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(read, _RECORD)


def member_blocks_at(file: pa.NativeFile, start: int, left: int) -> Iterator[bytes]:
    while left > 0:
        yield file.read_at(min(BLOCK, left), start)
        start, left = start + BLOCK, left - BLOCK


def archive_paths(spark: SparkSession, folder: str) -> DataFrame:
    """path: the archives that lie in a folder."""
    files, base = open_folder(folder)
    found = files.get_file_info(fs.FileSelector(base, recursive=True))
    return spark.createDataFrame([(f"{folder.rstrip('/')}/{f.path[len(base):].lstrip('/')}",) for f in found if f.is_file and f.path.endswith((".wacz", ".zip"))], "path string")


def page_records(records: DataFrame, kind: str = "string") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records that ``write_archives`` made."""

    def key(column: str) -> Column:
        return F.expr(f"url_decode(replace(nullif(regexp_extract({column}, '^urn:page:=(.*):[0-9]+$', 1), ''), '+', '%2B'))").cast(kind)

    revisit = F.col("type") == "revisit"
    return records.select(
        key("record_id").alias("page_id"),
        F.when(revisit, F.col("payload_bytes")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.substring_index("digest", ":", -1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, key("refers_to")).alias("refers_to"),
    )
