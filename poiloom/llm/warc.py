"""WARC records in ZIP packages: written by tasks, read back by range without extraction.

A package is a ZIP file with two stored members: archive/data.warc.gz, whose records are
compressed one by one, and indexes/index.cdxj, a line of sort key, time and JSON for each
record with its offset and length within the archive member. The reader takes the end of
the file, follows the ZIP64 locator where there is one, parses the central directory, finds
the members' data behind their local headers, and reads every record by its own range.

The reader takes packages of others too: any archive/*.warc or archive/*.warc.gz, indexes
that are gzipped or deflated, time stamps of any length, blanks in sort keys, numbers as
strings. A deflated archive member can't be read by range: it is unpacked as a stream while
its records are read in the order of their offsets. An index line without a file name
belongs to the only archive; a package without an index is an error.

Pages with equal payloads are written once: the smallest page_id has the response record,
the others revisit records that name it and keep the headers only. What a row is, is told
by its page_id and payload together, so rows with equal ids and different payloads are all
kept. Packages lie in the shared folder; a task that runs twice writes another package, and
only those that the finished job named are read.

Defined cases: null html is an empty payload; a null url becomes a name made of the
page_id; rows with the same page_id and payload are all responses if theirs is the smallest
page_id; a null page_id is never referred to while another page has the payload; a payload
that only rows without page_id have is a response in each; html of any length is one
record, written and read as a whole; an empty table gives no package and no row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.llm.common import new_path, own_names, shuffle_partitions, small_batches, spread_join, stored

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A package is closed when its records have so many bytes.
PACKAGE_BYTES = 256 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: An index line: sort key (blanks may stand in it), time, JSON.
LINE = re.compile(r"(.*?) (\d{4,17}) (\{.*\})\s*")
#: Bytes unpacked at a time.
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Signatures and record layouts of the ZIP format; fixed values.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
END_BYTES, LOCATOR64_BYTES, END64_BYTES, CENTRAL_BYTES, LOCAL_BYTES = 22, 20, 56, 46, 30
MOST_COMMENT = 0xFFFF


def digest(payload: bytes) -> str:
    """Base32 SHA-1, without a name before it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(uri: str):
    """The file system of a folder or file and its path there."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


def record_id(page_id: str, told: str) -> str:
    """The name of a page's record: pages of equal ids have others if their payloads differ."""
    return f"<urn:page:{quote(page_id, safe='')}:{told}>"


def record(page_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A record, uncompressed. refers_to: the page_id of the response that this one revisits."""
    told = digest(payload)
    target = (url or f"urn:page:{quote(page_id, safe='')}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, told)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{told}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, told)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """record_id, page_id, url, payload_bytes, payload_digest, record_type, refers_to; a broken record is an error.

    page_id and refers_to are those of our names of records, else the whole name. A digest
    that isn't told is computed; sizes are those of the payload behind the HTTP head, where
    there is one, or, of a revisit, what the head tells.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
    kind = fields.get("warc-type", "")
    http, payload = b"", block
    if "application/http" in fields.get("content-type", ""):
        http, _, payload = block.partition(b"\r\n\r\n")
    size = len(payload)
    if kind == "revisit":
        size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), size)
    name, _, told = fields.get("warc-payload-digest", "").rpartition(":")
    if kind != "revisit":
        own = digest(payload)
        if name in ("", "sha1") and told not in ("", own):
            raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
        told = told or own

    def page(name: str) -> str | None:
        own = re.fullmatch(r"<urn:page:([^:>]*):[^:>]*>", fields.get(name, ""))
        return unquote(own[1]) if own else fields.get(name)

    return {
        "record_id": fields.get("warc-record-id"),
        "page_id": page("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": told,
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
    }


class Package:
    """A ZIP package while it is written, to a stream that needs no seeking."""

    def __init__(self, stream):
        self.stream = stream
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id: str, url: str | None, payload: bytes, refers_to: str | None) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = packer.compress(record(page_id, url, payload, refers_to)) + packer.flush()
        self.member.write(data)
        entry = {"page_id": page_id, "url": url, "filename": ARCHIVE.split("/")[1], "offset": self.size, "length": len(data), "digest": digest(payload), "mime": "text/html" if refers_to is None else "warc/revisit"}
        self.lines.append(f"{json.dumps(url or '')} 20240101000000 {json.dumps(entry)}\n")
        self.size += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX, (2024, 1, 1, 0, 0, 0)), "".join(sorted(self.lines)))
        self.lines = []
        self.zip.close()
        self.stream.close()


def directory(read, size: int) -> dict[str, tuple[int, int, bool]]:
    """Where each member's data lies in a package: name to (offset, length, whether it is deflated).

    read: (offset, length) to bytes. Members that are encrypted or packed by another method aren't listed.
    """
    tail_at = max(0, size - END_BYTES - MOST_COMMENT - LOCATOR64_BYTES)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + END_BYTES > len(tail) or at + END_BYTES + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature may stand in the comment
    if at < 0:
        raise ValueError("no end of a central directory: not a ZIP package, or cut off")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= LOCATOR64_BYTES and tail[at - LOCATOR64_BYTES : at - LOCATOR64_BYTES + 4] == LOCATOR64:
        end64 = read(struct.unpack_from("<Q", tail, at - LOCATOR64_BYTES + 8)[0], END64_BYTES)
        if end64[:4] != END64:
            raise ValueError("the ZIP64 locator leads nowhere")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    central = read(start, length)
    found, at = {}, 0
    for _ in range(count):
        if central[at : at + 4] != CENTRAL:
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", central, at + 8)
        packed, full, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", central, at + 20)
        local = struct.unpack_from("<I", central, at + 42)[0]
        name = central[at + CENTRAL_BYTES : at + CENTRAL_BYTES + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = central[at + CENTRAL_BYTES + name_n : at + CENTRAL_BYTES + name_n + extra_n]
        full, packed, local = wide(extra, full, packed, local)
        if method in (0, 8) and not flags & 1:
            head = read(local, LOCAL_BYTES)
            if head[:4] != LOCAL:
                raise ValueError(f"no local header of {name}")
            found[name] = (local + LOCAL_BYTES + sum(struct.unpack_from("<HH", head, 26)), packed, method == 8)
        at += CENTRAL_BYTES + name_n + extra_n + comment_n
    return found


def wide(extra: bytes, *values: int) -> list[int]:
    """Full size, packed size and offset, those that are full replaced by what the ZIP64 field says, in this order."""
    own = b""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            own = extra[at + 4 : at + 4 + n]
        at += 4 + n
    found = []
    for v in values:
        if v == 0xFFFFFFFF and len(own) >= 8:
            v, own = struct.unpack("<Q", own[:8])[0], own[8:]
        found.append(v)
    return found


def inflated(read, base: int, packed: int) -> Iterator[bytes]:
    """A deflated member's content, piece by piece."""
    unpack = zlib.decompressobj(-15)
    for at in range(0, packed, CHUNK):
        yield unpack.decompress(read(base + at, min(CHUNK, packed - at)))
    yield unpack.flush()


def ranges(read, member: tuple[int, int, bool]) -> Callable[[int, int], bytes]:
    """(offset, length) to bytes of a member's content. Of a deflated one offsets must ascend."""
    base, packed, deflated = member
    if not deflated:

        def stored_range(at: int, n: int) -> bytes:
            if at < 0 or n < 0 or at + n > packed:
                raise ValueError("an index entry points behind its archive")
            return read(base + at, n)

        return stored_range
    source, held, start = inflated(read, base, packed), bytearray(), 0

    def unpacked_range(at: int, n: int) -> bytes:
        nonlocal start
        if at < start:
            raise ValueError("records of a deflated archive overlap")
        while start + len(held) < at + n:
            piece = next(source, None)
            if piece is None:
                raise ValueError("an index entry points behind its archive")
            held.extend(piece)
            gone = min(at - start, len(held))  # what lies before the range isn't kept
            del held[:gone]
            start += gone
        del held[: at - start]
        start = at
        return bytes(held[:n])

    return unpacked_range


def index_entries(read, members: dict[str, tuple[int, int, bool]]) -> list[tuple[str, int, int]]:
    """(archive member, offset, length) of every record that the indexes name, in order."""
    archives = [n for n in members if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))]
    indexes = [n for n in members if n.startswith("indexes/") and n.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz"))]
    if not archives or not indexes:
        raise ValueError("the package has no archive or no index that can be read")
    found = set()
    for name in indexes:
        base, packed, deflated = members[name]
        raw = b"".join(inflated(read, base, packed)) if deflated else read(base, packed)
        if raw[:2] == b"\x1f\x8b":
            raw = gzip.decompress(raw)
        for line in raw.decode().split("\n"):
            if not line.strip() or line.startswith("!"):
                continue  # blank, or a line of format
            m = LINE.fullmatch(line)
            if m is None:
                raise ValueError(f"not an index line: {line[:60]!r}")
            entry = json.loads(m[3])
            own = f"archive/{str(entry.get('filename') or '').rpartition('/')[2]}" if entry.get("filename") else archives[0]
            if own not in archives or (not entry.get("filename") and len(archives) > 1):
                raise ValueError(f"an index entry names no archive of the package: {entry.get('filename')!r}")
            found.add((own, int(entry["offset"]), int(entry["length"])))
    return sorted(found)


def read_package(read, size: int) -> Iterator[dict]:
    """Every record of a package, by the index's ranges, in the order of its archives."""
    members = directory(read, size)
    name, part = None, None
    for own, at, n in index_entries(read, members):
        if own != name:
            name, part = own, ranges(read, members[own])
        raw = part(at, n)
        yield parse_record(zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw)


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, sha1 and refers_to of the pages that revisit another one, once each, with how many rows of pages that are (rows)."""
    own = stored(pages.where(F.col("n") >= least_bytes).groupBy("page_id", "sha1").agg(F.count(F.lit(1)).alias("rows")), "payloads")
    # only payloads that more than one page has: the table joined below is small where copies are few
    first = own.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and refers_to is not null")
    first = stored(first, "first-pages")
    found = spread_join(own, first, ["sha1"], "copies", own.count())
    return found.where("refers_to is not null").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "sha1", "refers_to", "rows")


def write_packages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes every page's record; returns path, size and records of each package, once."""
    spark = pages.sparkSession
    small_batches(spark)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    d = own_names(pages, "page_id", "url", "html").withColumns({"n": F.octet_length(payload), "sha1": F.sha1(payload)})
    again = stored(revisits(d.select("page_id", "n", "sha1"), least_bytes), "revisits")
    found = spread_join(d, again, ["page_id", "sha1"], "rows", again.agg(F.sum("rows")).first()[0] or 0)
    joined = found.select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"))

    def write(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        package, path, n, done = None, "", 0, []

        def close():
            package.close()
            done.append((path, fs.get_file_info(path).size, n))

        for batch in batches:
            for page_id, url, page, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package is None:
                    path, n = f"{root}/{uuid.uuid4().hex}.wacz", 0
                    package = Package(fs.open_output_stream(path))
                package.add("" if page_id is None else page_id, url, (page or "").encode(), refers_to)
                n += 1
                if package.size >= PACKAGE_BYTES:
                    close()
                    package = None
        if package is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done]), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], names=["path", "size", "records"])

    return stored(joined.mapInArrow(write, "path string, size long, records long"), "packages")


def read_packages(packages: DataFrame, folder: str, page_kind: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the packages."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def load(batches):
        fs, _ = file_system(folder)
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                with fs.open_input_file(path) as f:
                    rows = []
                    for r in read_package(lambda at, n: f.read_at(n, at), size):
                        rows.append(r)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], k) for c, k in zip(names, kinds, strict=True)], names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], k) for c, k in zip(names, kinds, strict=True)], names=names)

    spread = packages.repartition(shuffle_partitions(packages.sparkSession))
    found = spread.mapInArrow(load, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    blank = F.when(F.col("page_id") != "", F.col("page_id")).cast(page_kind)
    return found.select(blank.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(page_kind).alias("refers_to"))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Every page written to packages in the shared folder and read back from them."""
    folder = new_path(pages.sparkSession, "wacz")
    return read_packages(write_packages(pages, folder, least_bytes), folder, pages.schema["page_id"].dataType.simpleString())
