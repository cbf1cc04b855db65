"""Operator 10 - legacy archive converter: ARC files to WARC files, both written by Spark.

* ``write_arc`` stores pages as ARC version 1 and 2 files (one version block a file, then
  ``header line, network document, newline`` records; gzip).
* ``read_arc`` parses them: the version block tells the field names of the header lines,
  every document is cut by its declared length, never by looking for a separator.
* ``convert`` synthesises the WARC side: record ids (name-based UUIDs), ISO timestamps
  from 14-digit dates, record types and SHA-1 payload digests.  Of records with equal
  payloads of ``min_bytes`` or more, that with the largest page_id is the response and
  the others are revisits of it.  Duplicates are found by a shuffle of digests alone
  (max per digest, summed map-side); payloads move once, as their gzipped archive.
* ``read_warc`` reads the archives back by their headers and declared lengths.

Archives hold about ``ARCHIVE_BYTES`` of content (one record at least), which bounds the
memory of the task that reads one.  All files go to the shared folder through Spark's own
text writer, so any file system Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm import textops as tx
from shiplens.session import checkpoint_dir

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 1000
CAPTURE_DATE = "20240101000000"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122

# fixed values: the URL record definitions of ARC versions 1 and 2, and the profile of
# revisits with an identical payload
ARC_FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
          "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ------------------------------------------------------------------------ ARC

def _field(x: str | None) -> str:
    """A header field: no white space, ASCII."""
    return urllib.parse.quote(x, safe="%/:?#[]@!$&'()*+,;=-._~") if x else "-"


def arc_version_block(name: str, version: str, date: str = CAPTURE_DATE) -> bytes:
    body = f"{version} 0 shiplens\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
              "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name,
              "Archive-length": str(len(body))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body


def arc_record(version: str, name: str, offset: int, url: str | None, page_id, html: bytes,
               date: str = CAPTURE_DATE) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n" \
           f"X-Page-Id: {'' if page_id is None else page_id}\r\n\r\n".encode()
    doc = head + html
    values = {"URL": _field(url), "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html",
              "Result-code": "200", "Checksum": hashlib.md5(html).hexdigest(), "Location": "-", "Offset": str(offset),
              "Filename": name, "Archive-length": str(len(doc))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + doc


def _arc_rows(batches):
    from pyspark import TaskContext
    part_id, number, size, seq = TaskContext.get().partitionId(), 0, None, 0
    for batch in batches:
        for part in tx.slices(batch, "html"):
            names, seqs, values = [], [], []
            for pid, url, html in zip(tx.column(part, "page_id").to_pylist(), tx.column(part, "url").to_pylist(),
                                      tx.column(part, "html").cast(pa.binary()).to_pylist()):
                html = html or b""
                if size is None or size + len(html) > ARCHIVE_BYTES:
                    name, version = f"a{part_id:06d}-{number:06d}", "12"[(part_id + number) % 2]
                    number, seq = number + 1, 0
                    values.append(arc_version_block(name + ".arc.gz", version))
                    size = len(values[-1]) + 1
                    names.append(name)
                    seqs.append(0)
                seq += 1
                values.append(arc_record(version, name + ".arc.gz", size, url, pid, html))
                size += len(values[-1]) + 1
                names.append(name)
                seqs.append(seq)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(seqs, pa.int64()), pa.array(values, pa.binary())],
                                             names=["archive", "seq", "value"])


def _save(rows: DataFrame, path: str, line_end: str) -> str:
    """Write (archive, seq, value) as one gzipped file an archive."""
    (rows.sortWithinPartitions("archive", "seq").select("archive", F.col("value").cast("string").alias("value"))
     .write.partitionBy("archive").option("lineSep", line_end).option("compression", "gzip").text(path))
    return path


def write_arc(pages: DataFrame, path: str) -> str:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return _save(rows.mapInArrow(_arc_rows, "archive string, seq long, value binary"), path, "\n")


def archives(spark, path: str) -> DataFrame:
    """(archive, content) of the gzipped archives below ``path``; none is no row."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    return found.select(F.regexp_extract("path", "archive=([^/]+)", 1).alias("archive"), "content")


def parse_arc(data: bytes):
    """Yield (fields, document) of each record; ``fields`` by the names of the version block."""
    pos, names = 0, None
    while pos < len(data):
        if data[pos:pos + 1] == b"\n":  # the newline between records
            pos += 1
            continue
        end = data.index(b"\n", pos)
        line = data[pos:end].decode("utf-8", "replace").split(" ")
        if names is None:
            if not line[0].startswith("filedesc://"):
                raise ValueError("an ARC file starts with its version block")
            length = int(line[-1])
            version = data[end + 1:end + 2].decode()
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version!r}")
            names = ARC_FIELDS[version]
        if len(line) != len(names):
            raise ValueError(f"ARC header line of {len(line)} fields, {len(names)} declared")
        fields = dict(zip(names, line))
        length = int(fields["Archive-length"])
        doc = data[end + 1:end + 1 + length]
        if len(doc) != length:
            raise ValueError("ARC document shorter than declared")
        pos = end + 1 + length
        yield fields, doc


def http_parts(doc: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers, header block, body) of an HTTP response; without one, all is body."""
    cut = doc.find(b"\r\n\r\n")
    if not doc.startswith(b"HTTP/") or cut < 0:
        return {}, b"", doc
    head = dict(x.split(": ", 1) for x in doc[:cut].decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    return head, doc[:cut + 4], doc[cut + 4:]


def _page_id(x: str | None) -> int | None:
    return int(x) if x and re.fullmatch(r"-?\d+", x) else None


def _arc_index(batches):
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            out = [[], [], [], []]
            for seq, (fields, doc) in enumerate(parse_arc(zlib.decompress(content.as_py(), 31))):
                if fields["URL"].startswith("filedesc://"):
                    continue
                head, _, body = http_parts(doc)
                for col, v in zip(out, (seq, _page_id(head.get("X-Page-Id")), len(body), hashlib.sha1(body).hexdigest())):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(out[0]), pa.string()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                names=["archive", "seq", "page_id", "payload_bytes", "payload_digest"])


# ----------------------------------------------------------------------- WARC

def warc_date(arc: str) -> str:
    """ISO 8601 of an ARC date of 4 to 14 digits (missing parts are the earliest)."""
    d = (arc + "00000101000000"[len(arc):]) if len(arc) < 14 else arc[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, key)}>"


def _page_key(page_id, digest: str, archive: str, seq: int) -> str:
    return f"page:{page_id}:{digest}" if page_id is not None else f"record:{archive}:{seq}:{digest}"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without its closing CRLF (the writer's line end adds it)."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n"


def _convert_archive(name: str, data: bytes, revisits: dict[int, int]):
    for seq, (fields, doc) in enumerate(parse_arc(data)):
        date = warc_date(fields["Archive-date"])
        if fields["URL"].startswith("filedesc://"):
            yield seq, warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(f"warcinfo:{name}")),
                                    ("WARC-Date", date), ("WARC-Filename", f"{name}.warc.gz"),
                                    ("Content-Type", "application/warc-fields")],
                                   f"software: shiplens\r\nformat: WARC File Format 1.1\r\nconverted-from: {fields['URL']}\r\n".encode())
            continue
        head, block, body = http_parts(doc)
        digest = hashlib.sha1(body)
        pid = _page_id(head.get("X-Page-Id"))
        kind = "response" if block else "resource"
        headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(_page_key(pid, digest.hexdigest(), name, seq))),
                   ("WARC-Target-URI", fields["URL"]), ("WARC-Date", date), ("WARC-IP-Address", fields["IP-address"]),
                   ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest.digest()).decode()),
                   ("Content-Type", "application/http; msgtype=response" if block else fields["Content-type"])]
        if pid is not None:
            headers.append(("X-Page-Id", str(pid)))
        if seq in revisits:
            headers[0] = ("WARC-Type", "revisit")
            headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(revisits[seq])),
                        ("WARC-Refers-To", record_id(_page_key(revisits[seq], digest.hexdigest(), "", 0)))]
            body = b""
        yield seq, warc_record(headers, block + body)


def _warc_rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            name, content, revisits = (batch.column(j)[i].as_py() for j in range(3))
            again = {x["seq"]: x["refers_to"] for x in revisits or []}
            seqs, values, size = [], [], 0
            for seq, value in _convert_archive(name, zlib.decompress(content, 31), again):
                seqs.append(seq)
                values.append(value)
                size += len(value)
                if size > 1 << 21:
                    yield _warc_batch(name, seqs, values)
                    seqs, values, size = [], [], 0
            yield _warc_batch(name, seqs, values)


def _warc_batch(name, seqs, values):
    return pa.RecordBatch.from_arrays([pa.array([name] * len(seqs), pa.string()), pa.array(seqs, pa.int64()),
                                       pa.array(values, pa.binary())], names=["archive", "seq", "value"])


def convert(spark, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """Convert the ARC files below ``arc_path`` to WARC files below ``warc_path``."""
    arcs = archives(spark, arc_path)
    index = arcs.mapInArrow(_arc_index, "archive string, seq long, page_id long, payload_bytes long, payload_digest string") \
        .filter(F.col("payload_bytes") >= min_bytes)
    first = index.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")) \
        .filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    again = index.join(first, ["payload_digest", "payload_bytes"]).filter("NOT page_id <=> refers_to") \
        .groupBy("archive").agg(F.collect_list(F.struct("seq", "refers_to")).alias("revisits"))  # an archive is bounded
    rows = arcs.join(again, "archive", "left").select("archive", "content", "revisits")
    return _save(rows.mapInArrow(_warc_rows, "archive string, seq long, value binary"), warc_path, "\r\n")


def parse_warc(data: bytes):
    """Yield (headers, block) of each record, cut by Content-Length."""
    pos = 0
    while pos < len(data):
        if data[pos:pos + 2] == b"\r\n":
            pos += 2
            continue
        cut = data.index(b"\r\n\r\n", pos)
        lines = data[pos:cut].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a WARC record starts with its version")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        length = int(headers["Content-Length"])
        yield headers, data[cut + 4:cut + 4 + length]
        pos = cut + 4 + length


def _warc_index(batches):
    for batch in batches:
        for content in batch.column(1):
            out = [[], [], [], [], [], []]
            for headers, block in parse_warc(zlib.decompress(content.as_py(), 31)):
                if headers["WARC-Type"] == "warcinfo":
                    continue
                head, _, body = http_parts(block)
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                size = int(head.get("Content-Length", len(body)))
                if headers["WARC-Type"] != "revisit":
                    size = len(body)
                    if hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"payload digest of {headers['WARC-Record-ID']} differs")
                for col, v in zip(out, (_page_id(headers.get("X-Page-Id")), headers["WARC-Target-URI"], size, digest,
                                        headers["WARC-Type"], _page_id(headers.get("X-Refers-To-Page-Id")))):
                    col.append(v)
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_warc(spark, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of the records below ``path``.

    The digest of every stored payload is checked against its header.
    """
    return archives(spark, path).mapInArrow(
        _warc_index, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def convert_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> tuple[str, DataFrame]:
    """Pages to ARC files to WARC files; (folder of the WARC files, their records read back).

    Defined cases: a null html is an empty payload; a null url is written as '-'; a row
    without page_id is written like any other, and may revisit but is never revisited.
    Repeated rows are records of their own: those that equal the chosen response in
    page_id and payload are all responses.  Payloads under ``min_bytes`` are all
    responses.  An empty table gives no records.  Further columns are not read.
    """
    spark = pages.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/archives/{uuid.uuid4().hex}"
    if not pages.limit(1).count():
        return base, spark.createDataFrame([], "page_id long, url string, payload_bytes long, payload_digest string, "
                                               "record_type string, refers_to long")
    write_arc(pages, f"{base}/arc")
    convert(spark, f"{base}/arc", f"{base}/warc", min_bytes)
    arc = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/arc")
    arc.getFileSystem(spark._jsc.hadoopConfiguration()).delete(arc, True)
    return f"{base}/warc", read_warc(spark, f"{base}/warc")
