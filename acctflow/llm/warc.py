"""WARC archives: records written in segments, read back and reassembled.

Writing. Records whose payloads are equal and at least ``min_revisit`` bytes
long share one response, that with the smallest id; the others become revisit
records that name it. A response's HTTP block carries its payload in chunked
transfer framing, and a block longer than ``segment_bytes`` is cut into a first
record and continuation records, which name the first one's record id, count
on from 2, and tell the total length in the last. Record ids are name-based UUIDs
under a new one of each run, and all records of a run carry its date. The target of a
record is the page's address, if it has one; extension fields carry the page ids.
Archives are gzip files in a shared folder, each of a bounded number of records; a
file is one gzip member, as Spark's text writer makes it, not one a record.

Reading. Each archive is parsed once, record by record by its Content-Length. Whole
records are decoded at once; they and the segments are written as one typed table.
The segments go through one shuffle by the identifier of their origin; there the segments are ordered by number, checked
to be all there, checked against the total length, joined and decoded. Whole
records never enter that shuffle. What a task gathers is one record.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctflow.llm.common import arrow_rows, shared_folder, text_or_empty, written

CRLF = b"\r\n"
# Fixed by the WARC 1.1 standard: version line, record types, field names.
VERSION = b"WARC/1.1"
# Characters of a URI that are not percent-encoded beside letters, digits and -._~.
URI_CHARS = "%:/?#[]@!$&'()*+,;="
ROW = "id long, payload_bytes long, digest string, type string, refers_to long, payload binary, uri string"
SEGMENT = "origin string, number long, total long"


def with_revisits(pages: DataFrame, id_col: str, text_col: str, min_revisit: int, url_col: str | None) -> DataFrame:
    """id, uri, payload, payload_bytes, digest, type, refers_to and refers_to_uri of every row."""
    spark = pages.sparkSession
    page_id = F.col(id_col).cast("long")
    url = F.nullif(F.trim(F.col(url_col).cast("string")), F.lit("")) if url_col in pages.columns else F.lit(None).cast("string")
    uri = F.coalesce(url, F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit(""))))
    rows = pages.select(page_id.alias("id"), uri.alias("uri"), text_or_empty(text_col).cast("binary").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    repeated = (
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "uri"))).alias("least"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("digest", F.col("least.id").alias("first"), F.col("least.uri").alias("first_uri"))
    )
    # Written, so that the join has two plain inputs: rows of a hot payload are
    # then split by the skew-join.
    repeated = written(repeated, shared_folder(spark, "warc-repeated"))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(repeated, "digest", "left").select(
        "id", "uri", "payload_bytes", "digest", F.when(again, "revisit").otherwise("response").alias("type"),
        F.when(again, F.col("first")).alias("refers_to"), F.when(again, F.col("first_uri")).alias("refers_to_uri"), F.when(~again, F.col("payload")).alias("payload"),
    )


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing of ``payload``."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, CRLF]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError on broken framing.
    Chunk extensions and trailer fields are allowed."""
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            break
        part = body[at : at + n]
        if len(part) != n or body[at + n : at + n + 2] != CRLF:
            raise ValueError("a chunk does not end where its length says")
        out.append(part)
        at += n + 2
    while (end := body.index(CRLF, at)) != at:  # trailer fields
        at = end + 2
    return b"".join(out)


def head(fields: list[tuple[str, object]]) -> bytes:
    return b"".join([VERSION, CRLF, *(f"{k}: {v}\r\n".encode() for k, v in fields), CRLF])


def records(row: dict, run: uuid.UUID, name: str, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The WARC records of one row, without the two line ends behind each; ``name``
    is the row's own within the run."""

    def record_id(k: int) -> str:
        return f"<{uuid.uuid5(run, f'{name}-{k}').urn}>"

    common = [
        ("WARC-Date", date), ("WARC-Target-URI", quote(row["uri"], URI_CHARS)),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Page-ID", "" if row["id"] is None else row["id"]),
    ]
    if row["type"] == "revisit":
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(1)), *common]
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To-Target-URI", quote(row["refers_to_uri"], URI_CHARS)),
            ("WARC-Refers-To-Date", date),
            ("Refers-To-Page-ID", row["refers_to"]),
            ("Content-Type", "application/http;msgtype=response"),
        ]
        yield head([*fields, ("Content-Length", len(block))]) + block
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n"
    block += chunked(row["payload"], chunk_bytes)
    n = -(-len(block) // segment_bytes)
    for k in range(n):
        part = block[k * segment_bytes : (k + 1) * segment_bytes]
        kind = "response" if k == 0 else "continuation"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(k + 1)), *common]
        if n > 1:
            fields.append(("WARC-Segment-Number", k + 1))
        if k:
            fields.append(("WARC-Segment-Origin-ID", record_id(1)))
        if k and k == n - 1:
            fields.append(("WARC-Segment-Total-Length", len(block)))
        yield head([*fields, ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(part))]) + part


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", text_col: str = "html", min_revisit: int = 100,
    segment_bytes: int = 16 << 10, chunk_bytes: int = 4 << 10, records_per_file: int = 4000, url_col: str | None = "url",
) -> None:
    """Write one record per row of ``pages`` as ``*.gz`` archives in ``folder``.

    A null text is an empty payload. Rows of one id and payload that is the
    smallest are all responses; a null id is larger than any other. An archive
    holds at most ``records_per_file`` records of ``segment_bytes`` each. A row
    without an address (null, blank or no such column) gets ``urn:page:`` and its
    id. Other columns are not read.
    """
    run, date = uuid.uuid4(), datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    schema = pa.schema([("record", pa.binary())])

    def rows(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                for record in records(row, run, f"{part}-{number}", date, segment_bytes, chunk_bytes):
                    yield {"record": record}
                number += 1

    typed = with_revisits(pages, id_col, text_col, min_revisit, url_col)
    lines = typed.mapInArrow(arrow_rows(rows, schema), "record binary").select(F.col("record").cast("string"))
    writer = lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(folder)


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of each record of an archive;
    raises ValueError where it is not one."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == CRLF:
            continue
        if line.rstrip() != VERSION:
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (CRLF, b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("the archive ends inside a record")
        yield fields, block


def opened(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP fields and payload of a block, its transfer framing decoded."""
    top, _, body = block.partition(b"\r\n\r\n")
    fields = dict(
        (k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in top.decode().split("\r\n")[1:])
    )
    return fields, unchunked(body) if fields.get("transfer-encoding") == "chunked" else body


def page_of(text: str | None) -> int | None:
    return int(text) if text else None


def read_row(fields: dict[str, str], block: bytes) -> dict:
    http, payload = opened(block)
    kind = fields["warc-type"]
    revisit = kind == "revisit"
    return {
        "id": page_of(fields.get("page-id")),
        "payload_bytes": int(http["content-length"]) if revisit else len(payload),
        "digest": fields["warc-payload-digest"].partition(":")[2],
        "type": kind,
        "refers_to": page_of(fields.get("refers-to-page-id")),
        "payload": None if revisit else payload,
        "uri": fields.get("warc-target-uri"),
    }


def read_archives(spark: SparkSession, folder: str, id_col: str = "page_id") -> DataFrame:
    """``id_col``, ``payload_bytes``, ``digest``, ``type``, ``refers_to``,
    ``payload`` (null for revisits) and ``uri`` of every record in ``folder``.

    A missing segment, a wrong total length, broken framing or a digest that
    does not fit the payload fails the job. No archives give no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    fields_out = [
        ("id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.string()), ("type", pa.string()),
        ("refers_to", pa.int64()), ("payload", pa.binary()), ("uri", pa.string()),
    ]
    out = pa.schema(fields_out)
    parsed_out = pa.schema([*fields_out, ("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64())])

    def parsed(batches):
        """Whole records as read, segments with their part of the block as payload."""
        for batch in batches:
            for content in batch.column(0):
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    for fields, block in parse(stream):
                        if "warc-segment-number" in fields:
                            yield segment(fields, block)
                        elif fields["warc-type"] in ("response", "revisit"):
                            yield read_row(fields, block)

    def segment(fields: dict[str, str], block: bytes) -> dict:
        total = fields.get("warc-segment-total-length")
        return {
            "id": page_of(fields.get("page-id")),
            "digest": fields["warc-payload-digest"].partition(":")[2],
            "type": fields["warc-type"],
            "payload": block,
            "uri": fields.get("warc-target-uri"),
            "origin": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
            "number": int(fields["warc-segment-number"]),
            "total": None if total is None else int(total),
        }

    def joined(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                found = batch.column(0)[k].as_py()
                total = batch.column(1)[k].as_py()
                if [s["number"] for s in found] != list(range(1, len(found) + 1)):
                    raise ValueError(f"segments are missing or repeated: {[s['number'] for s in found][:20]}")
                block = b"".join(s["payload"] for s in found)
                if total != len(block):
                    raise ValueError(f"segments hold {len(block)} bytes; the total length says {total}")
                first = found[0]
                _, payload = opened(block)
                yield {**{c: first[c] for c in ("id", "digest", "type", "uri")}, "payload_bytes": len(payload), "payload": payload}

    # Written, so that each archive is read and unzipped once for both kinds.
    typed = written(files.mapInArrow(arrow_rows(parsed, parsed_out), f"{ROW}, {SEGMENT}"), shared_folder(spark, "warc-read"))
    # A group is one record: its segments are no more than its payload.
    grouped = typed.where(F.col("origin").isNotNull()).groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "id", "digest", "type", "uri", "payload"))).alias("segments"),
        F.max("total").alias("total"),
    )
    whole = typed.where(F.col("origin").isNull()).drop("origin", "number", "total")
    both = whole.unionByName(grouped.select("segments", "total").mapInArrow(arrow_rows(joined, out), ROW))
    checked = both.withColumn(
        "digest",
        F.when(F.col("payload").isNull() | (F.sha2("payload", 256) == F.col("digest")), F.col("digest")).otherwise(
            F.raise_error(F.concat(F.lit("the payload does not fit its digest "), "digest"))
        ),
    )
    return checked.withColumnRenamed("id", id_col)
