"""WARC archives packaged as ZIP files: a writer, and a reader that takes records by byte ranges without extraction.

Writing: each task streams its pages into archives of at most RECORDS records. An archive holds the stored (not
compressed) members archive/data.warc.gz, one gzip member a record, and indexes/index.cdxj, one line a record with the
record's offset and length in the first. Payloads that repeat (equal SHA-256, at least LEAST_REVISIT bytes) become
revisit records of the one with the smallest page id. Files are named by task attempt, and only those that finished
attempts report are read, so a task that is run again leaves no doubles.

Reading: the end-of-central-directory record is found from the file's tail, its ZIP64 form where the file has one, then
the central directory with ZIP64 extras, then the local header of a member for where its data starts. Members must be
stored; the index gives ranges within the data member, and only those bytes are read, one record at a time.

Null html is an empty payload. A null page id counts as larger than any: it is the response only if its whole group has
null ids. Rows that repeat id and payload are alike: those with the group's smallest id are all responses. Payloads are
kept byte by byte, whatever their length; a URL's bytes that are no UTF-8 become U+FFFD. Only page_id, url and html are
read, so other columns can't clash. An empty table gives no archives and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, lookup, settle
from .stores import attempt_name, join, open_store, writing

LEAST_REVISIT = 100
RECORDS = 5_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"


# Writing


class _Sink(io.RawIOBase):
    """What zipfile writes to: a stream that can't seek."""

    def __init__(self, out) -> None:
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but tells its digest and length."""
    body = payload if kind == "response" else b""
    own = "null" if page_id is None else str(page_id)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{own}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-Id: {own}", f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Target-URI: {''.join(url.split())}"] if url else []), *([f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if kind == "revisit" else []),
        "Content-Type: text/html", f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archive(out, records: Iterator[tuple]) -> int:
    """Stream records into one archive; returns how many. The index is held until the data member is complete."""
    lines, n = [], 0
    with zipfile.ZipFile(_Sink(out), "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
            at = 0
            for page_id, url, payload, digest, kind, refers_to in records:
                packed = gzip.compress(record(page_id, url, payload, digest, kind, refers_to), 4, mtime=0)
                member.write(packed)
                lines.append(json.dumps({"page": page_id, "type": kind, "digest": f"sha256:{digest}", "offset": at, "length": len(packed)}))
                at += len(packed)
                n += 1
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
    return n


def annotated(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages with payload, digest, kind and refers_to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("_long", F.octet_length("payload") >= least)
    groups = rows.filter("_long").groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"), F.lit(True).alias("repeated"))
    found = lookup(rows, settle(groups.filter("n > 1"), "warc-groups"), "digest", "n")
    again = F.col("_long") & F.col("repeated") & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return found.select("page_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, records: int = RECORDS) -> DataFrame:
    """Write pages to archives in the folder; returns the settled list of them: path, records."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (r for batch in batches for r in batch.itertuples(index=False))
        whole = lambda x: None if x is None else int(x)
        k, row = 0, next(held, None)
        while row is not None:
            name, left = attempt_name("pages", k, ".wacz"), records

            def some() -> Iterator[tuple]:
                nonlocal row, left
                while row is not None and left:
                    yield whole(row.page_id), None if row.url is None else bytes(row.url).decode("utf-8", "replace"), bytes(row.payload), row.digest, row.kind, whole(row.refers_to)
                    row, left = next(held, None), left - 1

            with writing(folder, name) as out:
                n = write_archive(out, some())
            yield pd.DataFrame({"path": [join(folder, name)], "records": [n]})
            k += 1

    # Ids travel as strings: pandas would turn integers among nulls into floats.
    rows = annotated(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).withColumn("url", F.col("url").cast("binary"))
    return settle(rows.mapInPandas(write, "path string, records long"), "warc-list")


# Reading


@dataclass
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int


class ZipReader:
    """The members of a ZIP file by ranges of a seekable file."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size = file, size
        start, length, count = self._directory()
        self.members = self._parse(self._range(start, length), count)

    def _range(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError(f"the archive ends within bytes {start} to {start + length}")
        return data

    def _directory(self) -> tuple[int, int, int]:
        """Where the central directory starts, its length and number of entries."""
        tail_at = max(0, self.size - 65_557)  # the record has 22 bytes and a comment of 65,535 at most
        tail = self._range(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))  # the comment may hold the signature too
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end-of-central-directory record")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            locator = self._range(tail_at + at - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            end = self._range(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end-of-central-directory record")
            count, length, start = struct.unpack_from("<QQQ", end, 32)
        return start, length, count

    @staticmethod
    def _parse(data: bytes, count: int) -> dict[str, Member]:
        members, at = {}, 0
        for _ in range(count):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("a central directory entry is damaged")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
            header = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<HH", extra)
                if kind == 1:  # 64-bit values, present only for fields that are all ones, in this order
                    values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                    size = next(values) if size == 0xFFFFFFFF else size
                    packed = next(values) if packed == 0xFFFFFFFF else packed
                    header = next(values) if header == 0xFFFFFFFF else header
                extra = extra[4 + n :]
            members[name] = Member(name, method, size, packed, header)
            at += 46 + n_name + n_extra + n_comment
        return members

    def data_start(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed; ranges need stored members")
        head = self._range(m.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        size = self.members[name].size
        length = size - offset if length is None else length
        if offset < 0 or length < 0 or offset + length > size:
            raise ValueError(f"bytes {offset} to {offset + length} aren't in {name}")
        return self._range(self.data_start(name) + offset, length)


def parse_record(packed: bytes) -> tuple[dict[str, str], bytes]:
    """The headers (names in lower case) and the block of one gzip-packed record."""
    raw = zlib.decompress(packed, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def read_archive(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    fs, name = open_store(path)
    with fs.open_input_file(name) as file:
        z = ZipReader(file, file.size())
        start = z.data_start(DATA)
        for line in z.read(INDEX).decode().splitlines():
            entry = json.loads(line)
            yield parse_record(z._range(start + entry["offset"], entry["length"]))


def read_archives(archives: DataFrame) -> DataFrame:
    """(path) -> page_id, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page = lambda x: None if x is None or "null" in x else int(x.strip("<>").rpartition(":")[2])
        for batch in batches:
            for path in batch["path"]:
                rows, held = [], 0
                for fields, block in read_archive(path):
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    kind = fields["warc-type"]
                    if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"a payload in {path} doesn't have its digest")
                    n = len(block) if kind == "response" else int(fields["x-payload-length"])
                    rows.append((page(fields["x-page-id"]), n, digest, kind, page(fields.get("warc-refers-to")), block if kind == "response" else None))
                    held += len(block)
                    if held > 16 << 20:
                        yield frame(rows)
                        rows, held = [], 0
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        # Column by column: ids among nulls must not pass through floats.
        return pd.DataFrame({n: pd.array(list(c), "Int64") if n in ("page_id", "refers_to", "payload_bytes") else pd.Series(list(c), dtype=object) for n, c in zip(names, columns, strict=True)})

    n = min(max(1, archives.count()), 10_000)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return archives.select("path").repartition(n, F.col("path")).mapInPandas(read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of all pages, read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc"))).drop("payload")
