"""Legacy archives to WARC: ARC files of either version are parsed, and equivalent WARC records synthesised.

An ARC file begins with a version block. Its second line is "<version> <reserved> <origin>", its third names the fields
of each record's header line; version 1 has five fields, version 2 ten. A header line ends with the declared length of
the record's body in bytes, which is followed by a line end. From a header line and its body the converter makes a WARC
record: an identifier (a UUID from URL, date, digest, page and type, so that repeated runs agree), the timestamp in ISO form, the
type - ``response``, or ``revisit`` without payload when an equal payload is kept elsewhere -, the content type, and a
base32 SHA-1 of the payload. Records are members of a gzip file each, so that one can be read by itself.

Edge cases: a null or empty body is a payload of 0 bytes; white space in a URL is percent-encoded, a null URL is "-";
null page ids come after all others in choosing the response; of repeated rows of the chosen id all are responses; rows
that agree in page, URL and payload are the same record, under one identifier; one
digest may be that of any share of all rows; a body of any length is one record; an empty table gives no files; extra
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import HOT_KEYS, flagged, materialise, open_input, open_output, prepare, shared_dir

# The fields of a header line, by version.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
SCHEME = "filedesc://"
#: Archives are closed when they have this many compressed bytes.
FILE_BYTES = 64 << 20
LEVEL = 6
#: Smaller payloads than this are never revisits.
LEAST_REVISIT = 0


class ArcRecord(NamedTuple):
    header: dict[str, str]
    body: bytes


class Revisit(NamedTuple):
    """Where an equal payload is kept."""

    record_id: str
    uri: str
    date: str


def arc_bytes(records: Iterable[tuple[dict[str, str], bytes]], version: int, name: str = "pages.arc", date: str = "19960101000000") -> Iterator[bytes]:
    """An ARC file in pieces: the version block, then each record's header line and body."""
    fields = FIELDS[version]
    block = f"{version} 0 waymark\n{' '.join(fields)}\n".encode()
    own = {"URL": SCHEME + name, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain", "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name}
    yield " ".join([own[f] for f in fields[:-1]] + [str(len(block))]).encode() + b"\n" + block + b"\n"
    for header, body in records:
        line = [header.get(f, "-") or "-" for f in fields[:-1]] + [str(len(body))]
        yield " ".join(line).encode() + b"\n" + body + b"\n"


def parse_arc(stream) -> Iterator[ArcRecord]:
    """The records of an ARC stream of either version; raises ValueError where it isn't one.

    Fields are named by the version block itself. Blank lines between records are passed over; a header line with more
    words than fields keeps the extra ones in its URL, as old writers left spaces in URLs.
    """
    first = stream.readline()
    if not first.startswith(SCHEME.encode()):
        raise ValueError("an ARC stream begins with a filedesc header")
    block = stream.read(int(first.rsplit(b" ", 1)[1]))
    version, _, names = block.partition(b"\n")
    if int(version.split()[0]) not in FIELDS:
        raise ValueError(f"ARC version {version!r}")
    fields = names.split(b"\n")[0].decode().split()
    while line := stream.readline():
        if not line.strip():
            continue
        words = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        if len(words) < len(fields) or not words[-1].isdigit():
            raise ValueError(f"not an ARC header line: {line[:80]!r}")
        extra = len(words) - len(fields)
        values = [" ".join(words[: extra + 1]), *words[extra + 1 :]]
        header = dict(zip(fields, values, strict=True))
        body = stream.read(size := int(values[-1]))
        if len(body) < size:
            raise ValueError(f"body of {len(body)} bytes, {size} declared")
        yield ArcRecord(header, body)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uuid(uri: str, date: str, digest: str, kind: str = "response", page: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {digest} {kind} {page}')}>"


def iso_date(arc_date: str) -> str:
    """``YYYYMMDDhhmmss``, or a leading part of it, as ISO 8601 in UTC; what is missing is the earliest possible."""
    full = arc_date + "00000101000000"[len(arc_date) :] if len(arc_date) < 14 else arc_date
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(record: ArcRecord, revisit: Revisit | None = None, extra: dict[str, str] | None = None) -> bytes:
    """The WARC record (version 1.1) of an ARC record, not yet compressed."""
    header, body = record
    uri, date, digest = header["URL"], iso_date(header["Archive-date"]), base32_sha1(body)
    code, kind = header.get("Result-code", "200"), header["Content-type"]
    http = f"HTTP/1.0 {code if code.isdigit() else 200} OK\r\nContent-Type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode("utf-8", "surrogateescape")
    block, own = http if revisit else http + body, "revisit" if revisit else "response"
    lines = {
        "WARC-Type": own, "WARC-Record-ID": record_uuid(uri, date, digest, own, (extra or {}).get("X-Page", "")), "WARC-Date": date, "WARC-Target-URI": uri, "WARC-IP-Address": header["IP-address"],
        "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
    }
    if revisit:
        lines |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": revisit.record_id, "WARC-Refers-To-Target-URI": revisit.uri, "WARC-Refers-To-Date": revisit.date}
    lines |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))} | (extra or {})
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def read_warc(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """``(headers, HTTP header, payload)`` of each record of a WARC stream that isn't compressed."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "surrogateescape").partition(":")
            headers[k.strip()] = v.strip()
        block = stream.read(int(headers["Content-Length"]))
        http, _, payload = block.partition(b"\r\n\r\n") if headers.get("Content-Type", "").startswith("application/http") else (b"", b"", block)
        yield headers, http, payload


def _gunzip(stream) -> Iterator[bytes]:
    """The members of a gzip stream, one at a time."""
    unit, parts = zlib.decompressobj(31), []
    while raw := stream.read(1 << 18):
        while raw:
            parts.append(unit.decompress(raw))
            raw = unit.unused_data
            if unit.eof:
                yield b"".join(parts)
                unit, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("a gzip member is cut off")


def with_responses(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (id, url, html, date) with the response of each page that revisits another: ``revisit`` (boolean),
    ``keep``, ``keep_url`` and ``keep_date``.

    The response among equal payloads (by SHA-1 and length) of ``least`` bytes or more is the one of the largest id.
    Ids and digests are grouped first, without bodies. Digests with over a thousandth of all pages - fewer than a
    thousand of them - are broadcast, so their bodies don't move; nor do bodies that a map of fixed size shows to be single.
    Only the others are shuffled, by digest.
    """
    same = F.concat_ws("-", F.sha1("html"), F.octet_length("html"))
    marks = materialise(pages.select("id", "url", "date", same.alias("same"), F.octet_length("html").alias("bytes")), "digests")
    last = F.max(F.struct(F.col("id").alias("keep"), F.col("url").alias("keep_url"), F.col("date").alias("keep_date")))
    kept = marks.filter(F.col("bytes") >= least).groupBy("same").agg(F.count("*").alias("n"), last.alias("k")).filter("n > 1")
    kept, hot_over = materialise(kept.select("same", "n", "k.*"), "kept"), marks.count() // HOT_KEYS
    hot, rare = kept.filter(F.col("n") > hot_over).drop("n"), kept.filter(F.col("n") <= hot_over).drop("n")
    named = pages.withColumn("same", same).join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "same", "left")
    warm = named.filter("_hot").drop("_hot")
    cold = flagged(named.filter("_hot is null").select("same", *pages.columns), rare, "same")
    single = cold.filter("not _may").drop("_may").select("*", *[F.lit(None).cast(t).alias(c) for c, t in rare.dtypes if c != "same"])
    out = warm.unionByName(cold.filter("_may").drop("_may").join(rare, "same", "left")).unionByName(single)
    return out.withColumn("revisit", F.col("keep_url").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))).drop("same")


class Row(NamedTuple):
    """A page with its response, if it revisits one."""

    id: int | None
    url: str
    html: str
    date: str
    keep: int | None
    keep_url: str | None
    keep_date: str | None
    revisit: bool


def digits(number: int | None) -> str:
    return "" if number is None else str(number)


def convert(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT, path: str | None = None) -> DataFrame:
    """Pages through an ARC stream of both versions into WARC files; gives the manifest ``(file, records, bytes)``.

    Each page is an ARC stream of one record, versions by turns, which the converter parses and turns into a member of a
    ``.warc.gz`` file; memory holds a record at a time. Files are new ones; a lost task's are named by no manifest.
    """
    spark = pages.sparkSession
    prepare(spark)
    path = path or shared_dir(spark, "warc")
    url = F.regexp_replace(F.coalesce(F.col(url_col), F.lit("-")), r"\s", "%20")
    url = F.when(F.length(url) == 0, "-").otherwise(url)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.lit("20000101000000").alias("date"))
    joined = with_responses(rows, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, done = None, []

        def close() -> None:
            out[0].close()
            done.append((out[1], out[2], out[3]))

        for batch in batches:  # ids as Python's integers: as a pandas column with nulls they would be doubles
            for row in map(Row, *[batch.column(c).to_pylist() for c in Row._fields]):
                version = 1 + (row.id or 0) % 2
                header = {"URL": row.url, "IP-address": "0.0.0.0", "Archive-date": row.date, "Content-type": "text/html", "Result-code": "200"}
                arc = io.BytesIO(b"".join(arc_bytes([(header, row.html.encode("utf-8", "replace"))], version)))
                for record in parse_arc(arc):
                    revisit = None
                    if row.revisit:
                        date, digest = iso_date(row.keep_date), base32_sha1(record.body)
                        revisit = Revisit(record_uuid(row.keep_url, date, digest, "response", digits(row.keep)), row.keep_url, date)
                    extra = {"X-Page": digits(row.id), "X-Payload-Length": str(len(record.body))} | ({"X-Refers-To-Page": digits(row.keep)} if revisit else {})
                    unit = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = unit.compress(warc_record(record, revisit, extra)) + unit.flush()
                    if out is None or out[3] >= FILE_BYTES:
                        if out is not None:
                            close()
                        file = f"{path}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out = [open_output(file), file, 0, 0]
                    out[0].write(member)
                    out[2] += 1
                    out[3] += len(member)
        if out is not None:
            close()
        columns = [*zip(*done, strict=True)] or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["file", "records", "bytes"])

    return materialise(joined.mapInArrow(run, "file string, records long, bytes long"), "manifest")


#: What is read of a record.
READ = pa.schema([("id", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string()), ("type", pa.string()), ("refers", pa.int64()), ("record_id", pa.string()), ("date", pa.string())])


def read_archives(manifest: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``(id_col, payload_bytes, payload_digest, record_type, refers_to, record_id, date)`` of every record in the files.

    A response's length and digest are counted from the payload read; a revisit has no payload, and they are its headers'.
    """
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with open_input(file) as stream:
                    for member in _gunzip(stream):
                        for h, _, payload in read_warc(io.BytesIO(member)):
                            whole = h["WARC-Type"] == "response"
                            rows.append((
                                int(h["X-Page"]) if h["X-Page"] else None, len(payload) if whole else int(h["X-Payload-Length"]), base32_sha1(payload) if whole else h["WARC-Payload-Digest"].partition(":")[2],
                                h["WARC-Type"], int(h["X-Refers-To-Page"]) if h.get("X-Refers-To-Page") else None, h["WARC-Record-ID"], h["WARC-Date"],
                            ))
                columns = [*zip(*rows, strict=True)] or [[]] * len(READ)
                yield pa.RecordBatch.from_arrays([pa.array(c, READ.field(k).type) for k, c in enumerate(columns)], schema=READ)

    files = manifest.select("file").repartition(max(1, spark.sparkContext.defaultParallelism), "file")
    out = files.mapInArrow(run, "id long, bytes long, digest string, type string, refers long, record_id string, date string")
    return out.select(F.col("id").alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers").alias("refers_to"), "record_id", "date")
