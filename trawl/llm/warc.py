"""Legacy archives (ARC) to WARC: parse, deduplicate, convert, read back.

An ARC file opens with a version block that names the fields of its record headers: five
in version 1, ten in version 2. A record is a header line, then as many bytes as the line
declares. Conversion writes each as a WARC record with an identifier derived from the
record, its date in the WARC form, a type, and SHA-1 digests of block and payload. Equal
payloads of ``least`` bytes or more are stored once: the record with the largest page id
is the response, the others are revisits that refer to it and carry no payload.

Payloads stay in the files: what is shuffled is one narrow row per record, and a file is
converted by one task, which gets the file's own decisions. Files are gzipped record by
record and appear under their names only when complete.

Defined cases: a null payload is empty; a null address is ``urn:page:`` and the id; blanks
in an address are percent-encoded; a null page id is kept as such and never owns a digest
that a numbered page has; repeated rows with one id that holds the largest id of their
digest are all responses; an empty table gives no file and no rows; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored
from trawl.llm.files import new_file, open_stream

# Fixed values of the two header versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
LEAST = 1000
DATE = "20240101000000"
SPACE_OF_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "path string, records long"


@dataclass
class ArcRecord:
    """Header fields by name and the bytes that the header declared."""

    fields: dict[str, str]
    body: bytes

    def http(self) -> tuple[dict[str, str], bytes]:
        """Headers of the HTTP response (lower-case names) and its payload."""
        head, _, payload = self.body.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, payload


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 trawl\n{FIELDS[version]}\n\n".encode()
    tail = f"text/plain {len(body)}" if version == 1 else f"text/plain 200 - - 0 {name} {len(body)}"
    return f"filedesc://{name} 0.0.0.0 {DATE} {tail}\n".encode() + body


def arc_record(page_id, url: str | None, payload: bytes, version: int, name: str, offset: int) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    address = "%20".join((url or "").split()) or f"urn:page:{page_id}"
    size = len(head) + len(payload)
    tail = f"text/html {size}" if version == 1 else f"text/html 200 - - {offset} {name} {size}"
    return f"{address} 0.0.0.0 {DATE} {tail}\n".encode() + head + payload + b"\n"


def parse_arc(stream) -> Iterator[ArcRecord]:
    """Records of an ARC stream; the version block tells the fields of the header lines."""
    names: list[str] | None = None
    while line := stream.readline():
        if line == b"\n":
            continue
        parts = line.decode("utf-8", "replace").rstrip("\n").split(" ")
        body = stream.read(int(parts[-1]))
        if len(body) != int(parts[-1]):
            raise ValueError("an ARC record ends before its declared length")
        if names is None:
            version, fields = body.decode("utf-8", "replace").split("\n")[:2]
            names = fields.split(" ")
            if FIELDS.get(int(version.split(" ")[0])) != fields:
                raise ValueError(f"unknown ARC version block {version!r}")
            continue
        if len(parts) != len(names):
            raise ValueError(f"an ARC header has {len(parts)} fields, its version {len(names)}")
        yield ArcRecord(dict(zip(names, parts)), body)


def base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_OF_IDS, f'{page_id}/{digest.hex()}')}>"


def warc_record(record: ArcRecord, owner) -> bytes:
    """A response, or with ``owner`` a revisit of that page's response."""
    headers, payload = record.http()
    digest, page_id = hashlib.sha1(payload).digest(), headers.get("x-page-id", "")
    stamp = record.fields["Archive-date"]
    date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
    block = record.body if owner is None else record.body[: len(record.body) - len(payload)]
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if owner is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Target-URI: {record.fields['URL']}", f"WARC-Date: {date}", f"WARC-IP-Address: {record.fields['IP-address']}",
        f"WARC-Payload-Digest: {base32(digest)}", f"WARC-Block-Digest: {base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
    ]
    if owner is not None:
        lines += [
            f"WARC-Refers-To: {record_id(owner, digest)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of every record."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record does not begin with its version")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if base32(hashlib.sha1(block).digest()) != headers.get("warc-block-digest"):
            raise ValueError("a WARC block does not match its digest")
        yield headers, block


def unzipped(path: str):
    return io.BufferedReader(gzip.GzipFile(fileobj=open_stream(path)), 1 << 20)


def write_arcs(pages: DataFrame, folder: str, key: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Legacy archives of pages, one for each task: ``path``, ``records``.

    Tasks with even numbers write version 1 headers, the others version 2.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, count = TaskContext.get().partitionId(), 0
        name, version = f"part-{number:06d}.arc.gz", 1 + number % 2
        with new_file(folder, name) as out:
            out.write(member(arc_version_block(name, version)))
            for batch in batches:
                for page_id, url, payload in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "payload"))):
                    out.write(member(arc_record(page_id, url, payload, version, name, out.tell())))
                    count += 1
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [count]})

    return stored(rows.mapInArrow(run, MANIFEST), "arcs")


def _each_file(files: DataFrame) -> DataFrame:
    """One file to a task as far as may be; there are as many rows as files."""
    return files.repartition(max(1, files.count()))


def scan_arcs(files: DataFrame) -> DataFrame:
    """One narrow row per record: ``path``, ``number``, ``page_id``, ``bytes``, ``digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: dict[str, list] = {c: [] for c in ("path", "number", "page_id", "bytes", "digest")}
                for number, record in enumerate(parse_arc(unzipped(path))):
                    headers, payload = record.http()
                    page_id = headers.get("x-page-id") or None
                    values = (path, number, page_id and int(page_id), len(payload), hashlib.sha1(payload).digest())
                    for column, value in zip(rows.values(), values):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(rows.values(), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], list(rows))

    return _each_file(files.select("path")).mapInArrow(run, "path string, number long, page_id long, bytes long, digest binary")


def convert(arcs: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write a WARC file for every ARC file: ``path``, ``records``."""
    scan = stored(scan_arcs(arcs), "scan")
    large = scan.where(F.col("bytes") >= least)
    owners = stored(large.groupBy("digest").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1 AND owner IS NOT NULL").select("digest", "owner"), "owners")
    revisits = large.join(owners, "digest").where(~F.col("page_id").eqNullSafe(F.col("owner")))
    # A file's decisions are no more than its records.
    decided = revisits.groupBy("path").agg(F.collect_list(F.struct("number", "owner")).alias("revisits"))
    work = stored(arcs.select("path").join(decided, "path", "left"), "work")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, revisited in zip(batch.column("path").to_pylist(), batch.column("revisits").to_pylist()):
                owner_of = {r["number"]: r["owner"] for r in revisited or ()}
                name, count = path.rsplit("/", 1)[-1].replace(".arc", ".warc"), 0
                with new_file(folder, name) as out:
                    for number, record in enumerate(parse_arc(unzipped(path))):
                        out.write(member(warc_record(record, owner_of.get(number))))
                        count += 1
                yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [count]})

    return stored(_each_file(work).mapInArrow(run, MANIFEST), "warcs")


def read_warcs(files: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record: ``page_id``, ``record_id``, ``payload_bytes``, ``payload_digest``
    (hex), ``record_type``, ``refers_to_id``, ``payload`` (null for a revisit, or unless
    ``payloads``). Digests of blocks and payloads are checked either way."""
    names = ["page_id", "record_id", "payload_bytes", "payload_digest", "record_type", "refers_to_id", "payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def rows_of(path: str) -> Iterator[tuple]:
        for headers, block in parse_warc(unzipped(path)):
            http, payload = ArcRecord({}, block).http()
            digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
            revisit = headers["warc-type"] == "revisit"
            if not revisit and hashlib.sha1(payload).digest() != digest:
                raise ValueError("a WARC payload does not match its digest")
            page_id = http.get("x-page-id") or None
            yield (page_id and int(page_id), headers["warc-record-id"], int(http["content-length"]), digest.hex(),
                   headers["warc-type"], headers.get("warc-refers-to"), payload if payloads and not revisit else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held: list[tuple] = []
                size = 0
                for row in rows_of(path):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if len(held) == 1024 or size > 4 << 20:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    schema = "page_id long, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to_id string, payload binary"
    return _each_file(files.select("path")).mapInArrow(run, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Add ``refers_to``, the page id of the response that a revisit refers to."""
    narrow = stored(records.drop("payload"), "records")
    answers = narrow.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).distinct()
    named = narrow.where("refers_to_id IS NOT NULL").join(stored(answers, "answers"), "refers_to_id", "left")
    rest = narrow.where("refers_to_id IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    return rest.unionByName(named.select(rest.columns))
