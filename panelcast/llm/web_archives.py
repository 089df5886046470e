"""Legacy web archives (ARC, versions 1 and 2) to WARC 1.1.

An ARC file starts with a version block that names the fields of its header lines; each record is such a line, the
declared number of bytes, and a line break. The converter parses both versions and synthesises what WARC adds: record
identifiers (name-based UUIDs of file, offset, address and date), ISO time stamps, record types and SHA-1 digests of
block and payload. Repeated payloads become revisit records that refer to the record chosen as their response.

Work is by archive: files are written by tasks into the shared folder under fresh names and count only when the task
that wrote them succeeded. A file holds at most MAX_FILE_BYTES of records (or one larger record), so a task's memory
is one file's headers and one record. Repeats are planned on digests alone, with partial sums before the shuffle.

Defined cases: a null payload is empty; a null address becomes about:blank, blanks and controls in it are
percent-encoded; a null page id is left out and sorts before all others; of repeated page ids the later file and
offset is the response; a record shorter than declared keeps what is there and is marked truncated; dates that are no
time stamp become that of the file; an empty table writes no archive and gives no records.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import io
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.store import open_store, settle
from panelcast.staging import scratch_path

MAX_FILE_BYTES = 8 << 20
MIN_REVISIT_BYTES = 1000
CRAWLED = "20240101000000"
#: Of gzip: nearly as small as the default level, in half the time.
LEVEL = 3

# Fixed formats: field names of the two ARC versions, line ends and the WARC revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    """A gzip member of its own, without a time stamp."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class ArchiveWriter:
    """Writes records as gzip members into files of bounded size under a folder."""

    def __init__(self, folder: str, extension: str, head):
        self.folder, self.extension, self.head = folder, extension, head
        self.stream, self.size, self.records, self.done = None, 0, 0, []

    def add(self, make) -> None:
        """``make(file name, offset)`` gives the bytes of the record."""
        if self.stream is None:
            self.uri = f"{self.folder}/{uuid.uuid4().hex}{self.extension}"
            store, path = open_store(self.uri)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream, self.size, self.records = store.open_output_stream(path, compression=None), 0, 0
            self._put(self.head(self.uri.rpartition("/")[2]))
        data = make(self.uri.rpartition("/")[2], self.size)
        self._put(data)
        self.records += 1
        if self.size >= MAX_FILE_BYTES:
            self.close()

    def _put(self, data: bytes) -> None:
        self.stream.write(_member(data))
        self.size += len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.uri, self.records))
            self.stream = None


def open_archive(uri: str) -> io.BufferedReader:
    store, path = open_store(uri)
    source = store.open_input_file(path)
    packed = source.read(2) == b"\x1f\x8b"
    source.seek(0)
    return io.BufferedReader(gzip.GzipFile(fileobj=source) if packed else source, 1 << 20)


# ARC


def arc_address(url: str | None) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._|{}^\\\"<>`") if url else "about:blank"


def arc_head(name: str, version: int, date: str = CRAWLED) -> bytes:
    body = f"{version} 0 panelcast\n{ARC_FIELDS[version]}\n\n".encode()
    extra = "" if version == 1 else f" 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(body)}\n".encode() + body


def arc_record(url: str, ip: str, date: str, mime: str, body: bytes, version: int, name: str = "-", offset: int = 0) -> bytes:
    extra = "" if version == 1 else f" 200 {hashlib.md5(body).hexdigest()} - {offset} {name}"
    return f"{url} {ip} {date} {mime}{extra} {len(body)}\n".encode() + body + b"\n"


def read_arc(stream):
    """Dicts of ``url, ip, date, mime, body, offset, truncated`` for the records of an ARC file, without its head."""
    offset, fields = 0, None
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        names = (fields or (ARC_FIELDS[1] if text.count(" ") == 4 else ARC_FIELDS[2])).split(" ")
        values = text.rsplit(" ", len(names) - 1)  # only the address, which comes first, may hold blanks
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header line at byte {at}: {text[:200]!r}")
        record = dict(zip(names, values))
        body = stream.read(int(values[-1]))
        offset += len(body)
        if fields is None and text.startswith("filedesc:"):
            version = int(body.split(b" ", 1)[0] or 1)
            declared = body.decode("utf-8", "replace").splitlines()[1:2]
            fields = declared[0].strip() if declared and declared[0].strip() else ARC_FIELDS[min(version, 2)]
            continue
        yield {
            "url": record["URL"], "ip": record["IP-address"], "date": record["Archive-date"], "mime": record["Content-type"],
            "body": body, "offset": at, "truncated": len(body) < int(values[-1]),
        }


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(status line and headers with their blank line, payload); no headers if the body is no HTTP response."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    ends = [(i, len(s)) for s in (b"\r\n\r\n", b"\n\n") if (i := body.find(s)) >= 0]
    if not ends:
        return body, b""
    at, size = min(ends)
    return body[: at + size], body[at + size :]


def http_header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)[ \t]*\r?$", head)
    return m[1].decode("utf-8", "replace") if m else None


# WARC


def record_id(name: str, offset: int, url: str, date: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset} {date} {url}')}>"


def warc_date(date: str) -> str:
    digits = (date + "0" * 14)[:14] if len(date) in (8, 10, 12, 14) and date.isdigit() else CRAWLED
    try:
        return dt.datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return warc_date(CRAWLED)


def warc_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", warc_digest(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def warc_head(name: str) -> bytes:
    block = b"software: panelcast\r\nformat: WARC File Format 1.1\r\n"
    return warc_record(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, 0, "", "")), ("WARC-Date", warc_date(CRAWLED)),
         ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
        block,
    )


def as_warc(record: dict, name: str, refers: tuple[str, str, str] | None) -> bytes:
    """The WARC record of an ARC record of file ``name``; ``refers``: id, address and date of its response."""
    head, payload = split_http(record["body"])
    is_http = bool(head)
    kind = "revisit" if refers else "response" if is_http else "resource"
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(name, record["offset"], record["url"], record["date"])),
        ("WARC-Date", warc_date(record["date"])),
        ("WARC-Target-URI", record["url"]),
        ("WARC-Payload-Digest", warc_digest(payload)),
        ("Content-Type", "application/http; msgtype=response" if is_http else record["mime"]),
    ]
    if record["ip"] not in ("0.0.0.0", "-"):
        headers.append(("WARC-IP-Address", record["ip"]))
    if record["truncated"]:
        headers.append(("WARC-Truncated", "length"))
    if refers:
        for key, value in zip(("WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date"), refers):
            headers.append((key, value))
        headers.append(("WARC-Profile", REVISIT_PROFILE))
    return warc_record(headers, head if refers else record["body"])


def read_warc(stream):
    """(headers, block) of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key] = value.strip()
        yield headers, stream.read(int(headers["Content-Length"]))


# Spark jobs


def _listed(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, int]:
    files = settle(df, name)
    return files, max(files.count(), 1)


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """``path, records`` of the ARC files that hold a record per row of ``pages`` (page_id, url, html).

    Every other partition writes version 2. The page id travels as a header of the HTTP response.
    """

    def run(batches):
        from pyspark import TaskContext

        version = 1 + TaskContext.get().partitionId() % 2
        writer = ArchiveWriter(folder, ".arc.gz", lambda name: arc_head(name, version))
        for batch in batches:
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = (html or "").encode("utf-8", "replace")
                known = "" if page is None else f"X-Page-Id: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}Content-Length: {len(payload)}\r\n\r\n"
                body = head.encode() + payload
                address = arc_address(url)
                writer.add(lambda name, offset: arc_record(address, "0.0.0.0", CRAWLED, "text/html", body, version, name, offset))
        writer.close()
        yield from _rows(writer.done)

    return pages.select("page_id", "url", "html").mapInArrow(run, "path string, records long")


def _rows(done):
    if done:
        paths, records = zip(*done)
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(records, pa.int64())], ["path", "records"])


def index_arc(files: DataFrame) -> DataFrame:
    """A row per ARC record of the files (``path``): where it is, what it is, and digest and length of its payload."""
    schema = "path string, offset long, record_id string, url string, date string, page_id long, payload_bytes long, payload_digest string"

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, name = [], path.rpartition("/")[2]
                with open_archive(path) as stream:
                    for r in read_arc(stream):
                        head, payload = split_http(r["body"])
                        page = http_header(head, "X-Page-Id")
                        rows.append(
                            (path, r["offset"], record_id(name, r["offset"], r["url"], r["date"]), r["url"], warc_date(r["date"]),
                             int(page) if page else None, len(payload), hashlib.sha1(payload).hexdigest())
                        )
                if rows:
                    columns = list(zip(*rows))
                    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in schema.split(", ")])

    return files.select("path").mapInArrow(run, schema)


def plan_revisits(index: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``path, offset, refers`` of the records whose payload another record, that of the largest page id, holds."""
    large = index.where(F.col("payload_bytes") >= min_bytes)
    best = F.max(F.struct(F.col("page_id"), F.col("path"), F.col("offset"), F.col("record_id"), F.col("url"), F.col("date")))
    repeated = large.groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"))
    leads = repeated.agg(best.alias("lead"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes"))
    rows = large.select("path", "offset", "record_id", "payload_digest", "payload_bytes").join(leads, same)
    refers = F.struct(F.col("lead.record_id").alias("id"), F.col("lead.url").alias("url"), F.col("lead.date").alias("date"))
    return rows.where(F.col("record_id") != F.col("lead.record_id")).select("path", "offset", refers.alias("refers"))


def convert(files: DataFrame, revisits: DataFrame, folder: str, n_files: int) -> DataFrame:
    """``path, records`` of the WARC files made of the ARC files (``path``)."""

    def run(table: pa.Table) -> pa.Table:
        refers = {o: (r["id"], r["url"], r["date"]) for o, r in zip(table.column("offset").to_pylist(), table.column("refers").to_pylist()) if r}
        writer = ArchiveWriter(folder, ".warc.gz", warc_head)
        path = table.column("path")[0].as_py()
        name = path.rpartition("/")[2]
        with open_archive(path) as stream:
            for record in read_arc(stream):
                writer.add(lambda *_: as_warc(record, name, refers.get(record["offset"])))
        writer.close()
        paths, records = zip(*writer.done) if writer.done else ((), ())
        return pa.table({"path": pa.array(paths, pa.string()), "records": pa.array(records, pa.int64())})

    nothing = F.lit(None)
    work = files.select("path", nothing.cast("long").alias("offset"), nothing.cast(revisits.schema["refers"].dataType).alias("refers"))
    work = work.unionByName(revisits).repartition(n_files, "path")  # a fixed number: rows are small, files are not
    return work.groupBy("path").applyInArrow(run, "path string, records long")


def read_records(files: DataFrame) -> DataFrame:
    """A row per WARC record of the files (``path``), without the file heads. Digests are checked against the bytes."""
    names = ["record_id", "record_type", "url", "page_id", "payload_bytes", "payload_digest", "refers_to_id"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with open_archive(path) as stream:
                    for headers, block in read_warc(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        if headers["WARC-Block-Digest"] != warc_digest(block):
                            raise ValueError(f"{path}: block of {headers['WARC-Record-ID']} does not match its digest")
                        head, payload = split_http(block)
                        digest, size = headers["WARC-Payload-Digest"], len(payload)
                        if headers["WARC-Type"] == "revisit":
                            size = int(http_header(head, "Content-Length"))
                        elif digest != warc_digest(payload):
                            raise ValueError(f"{path}: payload of {headers['WARC-Record-ID']} does not match its digest")
                        page = http_header(head, "X-Page-Id")
                        rows.append(
                            (headers["WARC-Record-ID"], headers["WARC-Type"], headers["WARC-Target-URI"], int(page) if page else None,
                             size, base64.b32decode(digest[5:]).hex(), headers.get("WARC-Refers-To"))
                        )
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = "record_id string, record_type string, url string, page_id long, payload_bytes long, payload_digest string, refers_to_id string"
    return files.select("path").mapInArrow(run, schema)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as ARC, convert the archives to WARC and return the records read back, with ``refers_to``."""
    spark = pages.sparkSession
    arcs, n = _listed(spark, write_arc(pages, scratch_path(spark, "arc")), "arc-files")
    arcs = arcs.repartition(n)
    index = settle(index_arc(arcs), "arc-index")
    warcs, m = _listed(spark, convert(arcs, plan_revisits(index), scratch_path(spark, "warc"), n), "warc-files")
    records = settle(read_records(warcs.repartition(m)), "warc-records")
    referred = records.where(F.col("refers_to_id").isNotNull()).select(F.col("refers_to_id").alias("_id")).distinct()
    targets = records.join(referred, F.col("record_id") == F.col("_id"), "left_semi")
    targets = targets.select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"))
    return records.join(targets, F.col("refers_to_id") == F.col("_id"), "left").drop("_id")


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
lead AS (SELECT payload_digest, max(page_id) AS best FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> best THEN best END AS refers_to
FROM p LEFT JOIN lead ON lead.payload_digest = p.payload_digest
"""
