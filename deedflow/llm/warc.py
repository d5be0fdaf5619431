"""WARC archives of web pages, written with segmentation and chunked transfer coding, and read back.

A record longer than ``segment_bytes`` is cut into a first record and continuation records, which
name the first by ``WARC-Segment-Origin-ID`` and carry their number; the last one carries the total
length.  Reading groups records by origin, orders them by segment number, checks that no number is
missing and that the lengths add up, then undoes the chunked coding.

Files are written by Spark's text writer whose separator is the blank line that ends a WARC record.
They hold at most ``RECORDS_PER_FILE`` records of bounded size, so that one file fits a task.

Defined results: a null html is an empty payload; a null page_id is kept, and such a page revisits
the largest id with its payload (all are responses if none has an id); of repeated rows with the
largest page_id all are responses, each with a record of its own.  Other columns are ignored.  A
record whose head can't be read, or that ends early, is one row of type ``damaged``; reading goes on
at the next blank line that a record's first line follows.  A page without a url has the target
``urn:page:`` and its id.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.llm.rows import new_folder, written

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 512
BATCH_BYTES = 8 << 20
_END = b"\r\n\r\n"

# Fixed values of the format.
DATE = "2024-01-01T00:00:00Z"
HTTP = "application/http; msgtype=response"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = (
    "page_id long, record_type string, refers_to long, origin string, segment int, total long, "
    "digest string, payload_length long, block binary"
)
_PAGE = (
    "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, problem string"
)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP chunked framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Undo :func:`chunked`; extensions after a chunk's size and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is not closed")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(_END)
    if not mark:
        raise ValueError("no end of the HTTP head")
    coded = any(
        line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")
    )
    return dechunked(body) if coded else body


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _head(kind: str, name: str, length: int, **fields: object) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    lines += [f"{key.replace('_', '-')}: {value}" for key, value in fields.items() if value is not None]
    return "\r\n".join([*lines, f"Content-Length: {length}"]).encode() + _END


def target_uri(url: str | None, page: int | None) -> str:
    if url is None:
        return f"urn:page:{'' if page is None else page}"
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def records_of(
    name: str,
    page: int | None,
    url: str | None,
    payload: bytes,
    refers_to: int | None,
    segment_bytes: int,
    refers_url: str | None = None,
) -> list[bytes]:
    """The records of one page, without the blank line that ends each.

    A revisit names the page that it repeats by address and date, as several records may hold that page.
    """
    about = {
        "Content_Type": HTTP, "WARC_Target_URI": target_uri(url, page), "WARC_Page_ID": page,
        "WARC_Payload_Digest": f"sha1:{bare_digest(payload)}",
    }
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + _END
        about |= {
            "WARC_Profile": SAME_PAYLOAD, "WARC_Refers_To_Target_URI": target_uri(refers_url, refers_to),
            "WARC_Refers_To_Date": DATE, "WARC_Refers_To_Page_ID": refers_to, "WARC_Payload_Length": len(payload),
        }
        return [_head("revisit", name, len(block), **about) + block]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + _END
    block += chunked(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_head("response", name, len(block), **about) + block]
    made = [_head("response", name, len(parts[0]), WARC_Segment_Number=1, **about) + parts[0]]
    for number, part in enumerate(parts[1:], 2):
        total = len(block) if number == len(parts) else None
        head = _head(
            "continuation", f"{name}:{number}", len(part), WARC_Target_URI=about["WARC_Target_URI"],
            WARC_Segment_Number=number, WARC_Segment_Origin_ID=f"<{name}>", WARC_Segment_Total_Length=total,
        )
        made.append(head + part)
    return made


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files; of equal payloads one record carries the bytes.

    Repeated payloads are looked up among small rows of digest and id, whose counts are combined
    before they are shuffled.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    sent = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("payload"))
    sent = sent.withColumn("key", F.unhex(F.sha1("payload")))
    repeats = written(
        sent.groupBy("key")
        .agg(F.max(F.struct("page_id", "url")).alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND owner.page_id IS NOT NULL")
        .select("key", F.col("owner.page_id").alias("owner"), F.col("owner.url").alias("owner_url")),
        "warc-repeats",
    )
    revisit = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("owner")), F.col("owner"))
    tagged = sent.join(repeats, "key", "left").select("page_id", "url", "payload", revisit.alias("refers_to"), "owner_url")
    # Names are the same if a task is run again, and others in every other archive.
    archive = uuid.uuid4()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, made, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page, url, payload, refers_to, refers_url = (x.as_py() for x in row)
                name, n = f"urn:uuid:{uuid.uuid5(archive, f'{part}:{n}')}", n + 1
                for record in records_of(name, page, url, payload, refers_to, segment_bytes, refers_url):
                    made.append(record)
                    size += len(record)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])
                    made, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    (
        tagged.mapInArrow(encode, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", _END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


_DAMAGED = dict.fromkeys(x.split()[0] for x in _RECORD.split(",")) | {"record_type": "damaged", "block": b""}


def _inflated(data: bytes) -> tuple[bytes, bool]:
    """The content of a file of one or more gzip members, and whether all of it could be read."""
    parts = []
    while data:
        member = zlib.decompressobj(31)
        try:
            for at in range(0, len(data), 1 << 16):
                parts.append(member.decompress(data[at : at + (1 << 16)]))
                if member.eof:
                    break
        except zlib.error:
            return b"".join(parts), False
        if not member.eof:
            return b"".join(parts), False
        data = member.unused_data + data[at + (1 << 16) :]
    return b"".join(parts), True


def _parsed(data: bytes) -> Iterator[dict]:
    """The records of one archive's bytes."""
    at = 0
    while at < len(data):
        end = data.find(_END, at)
        try:
            if end < 0:
                raise ValueError("no end of the head")
            lines = data[at:end].decode().split("\r\n")
            fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
            length = int(fields["content-length"])
            block = data[end + 4 : end + 4 + length]
            if not lines[0].startswith("WARC/") or len(block) != length:
                raise ValueError("no record, or one that ends early")
            name = fields["warc-record-id"].strip("<>")
            number = {k: int(v) for k, v in fields.items() if k in _NUMBERS}
            record = {
                "page_id": number.get("warc-page-id"),
                "record_type": fields["warc-type"],
                "refers_to": number.get("warc-refers-to-page-id"),
                "origin": fields.get("warc-segment-origin-id", name).strip("<>"),
                "segment": number.get("warc-segment-number"),
                "total": number.get("warc-segment-total-length"),
                "digest": fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
                "payload_length": number.get("warc-payload-length"),
                "block": block,
            }
        except (ValueError, KeyError):
            yield dict(_DAMAGED)
            mark = data.find(_END + b"WARC/", at + 1)
            at = len(data) if mark < 0 else mark + len(_END)
        else:
            yield record
            at = end + 4 + length + 4


_NUMBERS = {
    "warc-page-id", "warc-refers-to-page-id", "warc-segment-number", "warc-segment-total-length", "warc-payload-length",
}


def _records(data: bytes) -> Iterator[dict]:
    """The records of one file; what can't be inflated is a damaged record."""
    content, whole = _inflated(data)
    yield from _parsed(content)
    if not whole:
        yield dict(_DAMAGED)


def _batched(rows: Iterator[dict], schema: pa.Schema, field: str) -> Iterator[pa.RecordBatch]:
    made, size = [], 0
    for row in rows:
        made.append(row)
        size += len(row[field] or b"") + 200
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(made, schema)
            made, size = [], 0
    yield pa.RecordBatch.from_pylist(made, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(","))])


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per WARC record found in the folder's files."""
    schema = _arrow(_RECORD)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for x in b.column("content") for r in _records(x.as_py()))
        yield from _batched(rows, schema, "block")

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(decode, _RECORD)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page: type, payload with its length and digest, and what is wrong with it, if anything.

    Only records that were cut are shuffled; a group is one page's segments.
    """
    records = read_records(spark, folder)
    segments = F.sort_array(F.collect_list(F.struct("segment", "block")))
    carried = [F.max(c).alias(c) for c in ("page_id", "refers_to", "total", "digest", "payload_length")]
    # The first record of a segmented one is a response; "response" sorts after "continuation".
    cut = (
        records.filter("segment IS NOT NULL")
        .groupBy("origin")
        .agg(F.max("record_type").alias("record_type"), *carried, segments.alias("parts"))
    )
    whole = records.filter("segment IS NULL").select(
        "record_type", "page_id", "refers_to", F.lit(None).cast("long").alias("total"), "digest",
        "payload_length", F.array(F.struct(F.lit(1).alias("segment"), "block")).alias("parts"),
    )
    schema = _arrow(_PAGE)

    def page(row: dict) -> dict:
        parts, problem, payload = row["parts"], None, None
        block = b"".join(p["block"] for p in parts)
        out = {k: row[k] for k in ("page_id", "record_type", "refers_to")}
        if row["record_type"] == "damaged":
            return out | {"payload_bytes": None, "payload_digest": None, "payload": None, "problem": "record damaged"}
        if row["record_type"] == "revisit":
            return out | {"payload_bytes": row["payload_length"], "payload_digest": row["digest"], "payload": None}
        if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
            problem = "segment missing"
        elif len(parts) > 1 and row["total"] != len(block):
            problem = "length differs"
        else:
            try:
                payload = http_payload(block)
            except ValueError as error:
                problem = str(error)
        digest = None if payload is None else bare_digest(payload)
        if problem is None and row["digest"] and row["digest"] != digest:
            problem = "digest differs"
        size = None if payload is None else len(payload)
        return out | {"payload_bytes": size, "payload_digest": digest, "payload": payload, "problem": problem}

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (page({n: c[i].as_py() for n, c in zip(b.schema.names, b.columns, strict=True)}) for b in batches for i in range(b.num_rows))
        yield from _batched(({"payload": None, "problem": None} | r for r in rows), schema, "payload")

    return cut.drop("origin").select(whole.columns).unionByName(whole).mapInArrow(join_up, _PAGE)


def warc_round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, segment_bytes)
    return read_archives(spark, folder)
