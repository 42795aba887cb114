"""Legacy archive converter: ARC files in, WARC files out.

An ARC file starts with a ``filedesc`` record whose second line states the
version: version 1 records have five header fields, version 2 records ten. Each
record is a header line, exactly the declared number of bytes, and a line
feed. The converter parses both versions by declared length (never by searching
for the next header) and synthesises for each record a WARC record: an
identifier derived from the archive's name and the record's offset, an ISO
timestamp from the 14-digit date, the type, and payload and block digests.

Records with equal payloads of at least ``min_bytes`` become one ``response``
(smallest page id) and ``revisit`` records that refer to it and hold only the
HTTP header. Three jobs: index the archives (digest per record), find the first
record of each digest (partial minimum before the shuffle), convert file by
file. Payloads never shuffle; a task holds one record at a time.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.sinks import scratch_dir
from .shared_files import one_task_per_file, open_file, write_file

# The two ARC record definitions, as their filedesc states them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
WARC_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")     # the URL name space


def member(data: bytes, level: int = 1) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(stream, chunk: int = 1 << 20):
    """(offset, bytes) of each gzip member of a file."""
    z, parts, offset, at, buf = zlib.decompressobj(31), [], 0, 0, b""
    while buf or (buf := stream.read(chunk)):
        parts.append(z.decompress(buf))
        at += len(buf) - len(z.unused_data)
        buf = z.unused_data
        if z.eof:
            yield offset, b"".join(parts)
            z, parts, offset = zlib.decompressobj(31), [], at
    if parts:
        raise ValueError(f"archive ends inside the record at {offset}")


# -- ARC ---------------------------------------------------------------------

def http_block(payload: bytes, page_id, head_only: bool = False) -> bytes:
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: {'' if page_id is None else page_id}"
            f"\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    return head if head_only else head + payload


def arc_header(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n\n".encode()
    fields = ["filedesc://" + name, "0.0.0.0", date, "text/plain"]
    if version == 2:
        fields += ["200", "-", "-", "0", name]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body


def arc_record(version: int, url: str | None, date: str, block: bytes, offset: int, name: str) -> bytes:
    safe = quote(url, safe="%/:=&?~#+!$,;'@()*[]-._") if url else "-"
    fields = [safe, "0.0.0.0", date, "text/html"]
    if version == 2:
        fields += ["200", f"{zlib.crc32(block):08x}", "-", str(offset), name]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def write_arcs(pages: DataFrame, folder: str, date: str = "20200101000000", file_bytes: int = 32 << 20) -> DataFrame:
    """Write (page_id, url, html) rows as compressed ARC files, both versions in
    turn; returns the manifest (arc, records)."""

    def write(batches):
        turn = 0
        rows = (row for b in batches for row in zip(*(b.column(i) for i in range(3))))
        row = next(rows, None)
        while row is not None:
            version, count, name = turn % 2 + 1, 0, f"{uuid.uuid4().hex}.arc"
            turn += 1

            def chunks():
                nonlocal row, count
                head = member(arc_header(name, version, date))
                at = len(head)
                yield head
                while row is not None and at < file_bytes:
                    page, url, html = (x.as_py() for x in row)
                    block = http_block((html or "").encode(), page)
                    data = member(arc_record(version, url, date, block, at, name))
                    at += len(data)
                    count += 1
                    yield data
                    row = next(rows, None)

            uri = write_file(folder, ".arc.gz", chunks())
            yield pa.RecordBatch.from_pydict({"arc": [uri], "records": pa.array([count], pa.int64())})

    slim = pages.select(F.col("page_id").cast("long"), F.col("url"), F.col("html"))
    return materialize(slim.mapInArrow(write, "arc string, records long"))


def read_arc(uri: str):
    """(offset, fields, block) of each record, by the version the file declares."""
    with open_file(uri) as stream:
        names = None
        for offset, data in members(stream):
            line, _, rest = data.partition(b"\n")
            fields = line.decode().split(" ")
            length = int(fields[-1])
            block = rest[:length]
            if len(block) != length:
                raise ValueError(f"{uri}: record at {offset} is shorter than it declares")
            if names is None:
                version = int(block.split(b" ", 1)[0])
                if not fields[0].startswith("filedesc://") or version not in ARC_FIELDS:
                    raise ValueError(f"{uri}: not an ARC file of a known version")
                names = ARC_FIELDS[version].split(" ")
                continue
            if len(fields) != len(names):
                raise ValueError(f"{uri}: record at {offset} has {len(fields)} fields, not {len(names)}")
            yield offset, dict(zip(names, fields)), block


def split_http(block: bytes) -> tuple[dict, bytes, bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, head + b"\r\n\r\n", payload


def record_id(uri: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(WARC_SPACE, f'{uri}#{offset}')}>"


def index_arcs(manifest: DataFrame) -> DataFrame:
    """(arc, offset, page_id, target, digest, payload_bytes) of every record."""

    def index(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                for offset, fields, block in read_arc(uri):
                    http, _, payload = split_http(block)
                    page = http.get("X-Page-Id")
                    rows.append((uri, offset, int(page) if page else None, fields["URL"],
                                 hashlib.sha256(payload).digest(), len(payload)))
                schema = pa.schema([("arc", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()),
                                    ("target", pa.string()), ("digest", pa.binary()), ("payload_bytes", pa.int64())])
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return materialize(one_task_per_file(manifest.select("arc"), "arc").mapInArrow(
        index, "arc string, offset long, page_id long, target string, digest binary, payload_bytes long"))


# -- WARC --------------------------------------------------------------------

def warc_record(fields: dict, rid: str, block: bytes, payload_digest: str, refers: tuple | None) -> bytes:
    d = fields["Archive-date"]
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {rid}",
            f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"]
    if fields["URL"] != "-":
        head.append(f"WARC-Target-URI: {fields['URL']}")
    head += [f"WARC-IP-Address: {fields['IP-address']}", f"WARC-Payload-Digest: sha256:{payload_digest}",
             f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    if refers:
        head += [f"WARC-Refers-To: {refers[0]}", f"WARC-Profile: {REVISIT_PROFILE}"]
        if refers[1] != "-":
            head.append(f"WARC-Refers-To-Target-URI: {refers[1]}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisits(index: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(arc, offset, to_arc, to_offset, to_target) of the records that repeat an earlier payload."""
    long_ = index.filter(F.col("payload_bytes") >= min_bytes)
    first = (long_.groupBy(F.col("digest").alias("d"))
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "arc", "offset", "target")).alias("f"),
                  F.count("*").alias("c")).filter("c > 1"))
    return (long_.join(first, F.col("digest") == F.col("d"))
            .filter((F.col("f.arc") != F.col("arc")) | (F.col("f.offset") != F.col("offset")))
            .select("arc", "offset", F.col("f.arc").alias("to_arc"), F.col("f.offset").alias("to_offset"),
                    F.col("f.target").alias("to_target")))


def convert(manifest: DataFrame, folder: str, min_bytes: int = 100) -> DataFrame:
    """Convert every ARC file to a WARC file; returns the manifest (warc)."""
    again = revisits(index_arcs(manifest), min_bytes)

    def write(key, arcs: pa.Table, refs: pa.Table) -> pa.Table:
        to = {r["offset"]: (record_id(r["to_arc"], r["to_offset"]), r["to_target"]) for r in refs.to_pylist()}
        out = []
        for uri in arcs["arc"].to_pylist():
            def chunks():
                for offset, fields, block in read_arc(uri):
                    _, head, payload = split_http(block)
                    refers = to.get(offset)
                    yield member(warc_record(fields, record_id(uri, offset), head if refers else block,
                                             hashlib.sha256(payload).hexdigest(), refers))

            out.append(write_file(folder, ".warc.gz", chunks()))
        return pa.table({"warc": pa.array(out, pa.string())})

    slim = one_task_per_file(manifest.select("arc"), "arc")
    return materialize(slim.groupBy("arc").cogroup(again.groupBy("arc")).applyInArrow(write, "warc string"))


def read_warcs(manifest: DataFrame) -> DataFrame:
    """Every record: record_id, refers_to_id, record_type, target, date, page_id,
    payload_bytes, payload_digest, and html (null in revisits). A response's
    digest is checked against its payload."""

    def read(batches):
        names = ["record_id", "refers_to_id", "record_type", "target", "date", "page_id", "payload_bytes",
                 "payload_digest", "html"]
        types = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.string()] * 2
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_file(uri) as stream:
                    for offset, data in members(stream):
                        head, _, rest = data.partition(b"\r\n\r\n")
                        f = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                        block = rest[:int(f["Content-Length"])]
                        http, _, payload = split_http(block)
                        kind, digest = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{uri}: payload at {offset} does not match its digest")
                        page = http.get("X-Page-Id")
                        rows.append((f["WARC-Record-ID"], f.get("WARC-Refers-To"), kind, f.get("WARC-Target-URI"),
                                     f["WARC-Date"], int(page) if page else None, int(http["Content-Length"]), digest,
                                     payload.decode() if kind == "response" else None))
                        held += len(payload)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return one_task_per_file(manifest.select("warc"), "warc").mapInArrow(
        read, "record_id string, refers_to_id string, record_type string, target string, date string, page_id long, "
              "payload_bytes long, payload_digest string, html string")


def warc_round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Pages -> ARC -> WARC -> rows: page_id, payload_bytes, payload_digest,
    record_type, refers_to.

    Null html: empty payload. Null url: no target. Null page id: kept, last
    among equals. Rows that repeat entirely: one response, revisits of it.
    Empty table: no rows. Columns besides page_id, url, html are not read.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    arcs = write_arcs(pages, f"{folder}/arc")
    warcs = convert(arcs, f"{folder}/warc", min_bytes)
    rows = materialize(read_warcs(warcs).drop("html"))
    first = rows.filter("record_type = 'response'").select(F.col("record_id").alias("rid"),
                                                           F.col("page_id").alias("refers_to"))
    return rows.join(first, F.col("refers_to_id") == F.col("rid"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_warc(spark, sf_dir: str) -> DataFrame:
    return warc_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f"""
