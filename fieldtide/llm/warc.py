"""WARC archives: a writer with revisit records and a splittable reader."""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.llm.common import byte_length, stored

MAGIC = b"\x1f\x8b\x08"
LEAST_BYTES = 1000            # equal payloads of at least this size are written once
SPLIT_BYTES = 8 * 1024 * 1024
MOST_TASKS = 50_000           # beyond so many ranges a task reads several
CHUNK = 1024 * 1024
DATE = "2024-01-01T00:00:00Z"


def payload_roles(pages: DataFrame, key: str, payload: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Add payload_bytes, payload_digest and refers_to (null for responses).

    The largest key of each digest is a partial aggregate; rows then meet it in a join whose other side has one row
    per digest, so a digest with very many rows is split by adaptive execution.
    """
    rows = pages.withColumn(payload, F.coalesce(F.col(payload), F.lit("")))
    rows = rows.withColumns({"payload_bytes": byte_length(F.col(payload)), "payload_digest": F.sha1(payload)})
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.max(key).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    rows = rows.join(first, "payload_digest", "left")
    return rows.withColumn("refers_to", F.when(F.col("_first") != F.col(key), F.col("_first"))).drop("_first")


def _record(key, url, payload: bytes, size: int, digest: str, refers_to, date: str) -> bytes:
    """One WARC record as a gzip member of its own."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    name = lambda k: "<urn:page:none>" if k is None else f"<urn:page:{k}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(key)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{b32}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
               least_bytes: int = LEAST_BYTES, date: str = DATE) -> DataFrame:
    """Write every row as a record below ``folder`` and return (path, bytes, records), one row per archive.

    Each task attempt streams its rows into an archive with a name of its own; only archives of the attempt that
    succeeded are in the returned (stored) list, so what lost or repeated tasks left is never read. ``folder`` must be
    reachable by all executors. A null payload is empty; a null url has no target header; a null key is named none;
    repeated rows are records each. Of rows with equal long payloads and the same largest key all are responses.
    """
    rows = payload_roles(pages.select(key, url, payload), key, payload, least_bytes)
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"),
                       F.when(F.col("refers_to").isNull(), F.encode(F.col(payload), "UTF-8")).alias("payload"),
                       F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("digest"),
                       F.col("refers_to").cast("string").alias("refers_to"), F.col(key).cast("string").alias("name"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name, size, count, out = f"{uuid.uuid4().hex}.warc.gz", 0, 0, None
        try:
            for rows in batches:
                for r in rows.itertuples(index=False):
                    out = out or system.open_output_stream(f"{root}/{name}", compression=None)
                    member = _record(r.name, r.url, r.payload, r.size, r.digest, r.refers_to, date)
                    out.write(member)
                    size, count = size + len(member), count + 1
        finally:
            if out is not None:
                out.close()
        if count:
            # The path keeps the scheme of the folder, by which the reader finds its file system.
            yield pd.DataFrame({"path": [f"{folder.rstrip('/')}/{name}"], "bytes": [size], "records": [count]})

    return stored(rows.mapInPandas(write, "path string, bytes long, records long"), "warc-list")


class _Window:
    """Bytes of a file from some offset on, read in chunks and dropped once used."""

    def __init__(self, file, start: int):
        self.file, self.at, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the WARC members that start in [start, end).

    Every gzip magic is a candidate; it is a member if its first bytes inflate to a WARC version line. A member that
    starts inside is read to its end, wherever that lies. Where a candidate or a damaged member fails, the search
    goes on one byte later.
    """
    window = _Window(file, start)
    while window.at < end:
        found = window.data.find(MAGIC)
        if found < 0:
            window.drop(max(0, len(window.data) - len(MAGIC) + 1))
            if not window.more():
                return
            continue
        window.drop(found)
        if window.at >= end:
            return
        content, used = _inflate(window)
        if content is None:
            window.drop(1)
        else:
            yield window.at, content
            window.drop(used)


def _inflate(window: _Window) -> tuple[bytes | None, int]:
    engine, parts, fed = zlib.decompressobj(31), [], 0
    checked = False
    try:
        while True:
            piece = window.data[fed:fed + (CHUNK if checked else 4096)]
            if not piece:
                if not window.more():
                    return None, 0
                continue
            fed += len(piece)
            parts.append(engine.decompress(piece))
            if not checked and sum(map(len, parts)) >= 7:
                if not b"".join(parts).startswith(b"WARC/1."):
                    return None, 0
                checked = True
            if engine.eof:
                return (b"".join(parts), fed - len(engine.unused_data)) if checked else (None, 0)
    except zlib.error:
        return None, 0


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by their name in small letters; white space around the colon is free, folded lines go on."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = (x.strip() for x in line.split(":", 1))
            name = name.lower()
            out[name] = value
    return out


def _parse(content: bytes) -> dict | None:
    """One record; None where its length or id is missing or wrong. Blocks without an HTTP header are all payload."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()) or not fields.get("warc-record-id") or not fields.get("warc-type"):
        return None
    block = block[:int(size)]
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not re.match(rb"HTTP/|[A-Z]+ [^\r\n]+ HTTP/", http):
        http, payload = b"", block
    length = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
    digest = fields.get("warc-payload-digest", "")
    try:
        declared = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
    except ValueError:
        declared = None
    return {
        "record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"), "declared_bytes": int(length[1]) if length else len(payload),
        "declared_digest": declared, "payload": payload,
    }


READ_SCHEMA = ("path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
               "declared_bytes long, declared_digest string, payload binary")


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Read archives listed as (path, bytes): one row per record, in READ_SCHEMA.

    Archives are cut into byte ranges of ``split_bytes``; a task owns the records that start in its range, so one
    huge archive is read by many tasks and no index is needed. Revisits have an empty payload; declared_bytes and
    declared_digest describe the full payload. Damaged members and records without an id, a type or a length are
    passed over.
    """
    ranges = files.select("path", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes))).alias("start"))
    # The list of ranges is small, so adaptive execution would put them all into one task; a given number of tasks is kept.
    n = files.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("bytes") / split_bytes)))).first()[0] or 1
    ranges = ranges.repartition(min(int(n), MOST_TASKS))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in READ_SCHEMA.split(", ")]
        for rows in batches:
            for path, start in rows.itertuples(index=False):
                system, at = fs.FileSystem.from_uri(path)
                held, size = [], 0
                with system.open_input_file(at) as file:
                    for offset, content in _members(file, start, start + split_bytes):
                        record = _parse(content)
                        if record is not None:
                            held.append({"path": path, "offset": offset, **record})
                            size += len(content)
                        if size > 8 * CHUNK:
                            yield pd.DataFrame(held, columns=names)
                            held, size = [], 0
                if held:
                    yield pd.DataFrame(held, columns=names)

    return ranges.mapInPandas(read, READ_SCHEMA)


def page_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records written by ``write_warc``.

    Bytes and digest of a response come from the payload itself, those of a revisit from its headers.
    """
    number = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")
    full = F.col("record_type") == "response"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload")).otherwise(F.col("declared_bytes")).cast("long").alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )


def list_warc(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of all archives below a folder, through Spark's own file listing."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select("path", F.col("length").alias("bytes"))
