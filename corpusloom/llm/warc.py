"""Web archives: writing WARC files with segmented, chunked and revisited records, and reassembling them.

Writing turns each row into one HTTP response with chunked transfer framing. A block longer than ``segment_bytes`` is cut
into a first record and continuation records that name it as their origin. Rows with the same payload as a row of a smaller id become
revisit records without a payload. Records are spread over archive files by a hash, so the segments of one page lie in
several archives; files are gzip-compressed and hold a bounded number of records each.

Reading parses each archive by the lengths its headers give, groups continuation records by origin, orders them by segment
number, verifies that the numbers have no gap, that there is a total and that it is right, decodes the chunked framing and
verifies the digest. A record that fails is returned with its fault and without a payload; it stops nothing.

Null html is an empty payload; null ids are kept as such; repeated rows are written as often as they occur (the first id wins, equal ids
are all responses); an empty table gives an archive without records. Only the id, url and html columns are archived.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VERSION = b"WARC/1.1"
END = "\r\n\r\n"  # what ends a record; the writer puts it after each row
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text in UTF-8: eight groups of 20 bits, four letters each."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``: whose payload a row repeats, if it repeats one.

    Equal payloads are found on ids and digests alone; the payloads move once, keyed by their own row, so copies
    of one page do not meet in one task.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": payload_digest(F.col("payload")), "known": F.col("page_id").isNotNull(), "id": F.coalesce("page_id", F.lit(0).cast("long"))})
    ids = rows.groupBy("digest", "known", "id").agg(F.count("*").alias("n"))
    least = ids.filter("known").groupBy("digest").agg(F.min("id").alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    repeats = ids.join(least, "digest").filter("not known or id <> first").select("digest", "known", "id", "first")
    joined = rows.join(repeats, ["digest", "known", "id"], "left")
    return joined.select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"))


def _header(kind: str, name: str, fields: list[tuple[str, str]], length: int) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", "WARC-Date: 2024-01-01T00:00:00Z", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {length}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%X\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunk(body: bytes) -> bytes:
    """The payload of a body in chunked framing; ``ValueError`` if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at : at + size])
        at += size + 2


def records_of(page_id: int | None, row: int, url: str | None, payload: str, digest: str, refers_to: int | None, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one row, without the record end."""
    name = f"urn:page:{'' if page_id is None else page_id}:{row}"
    target = [("WARC-Target-URI", (url or "").replace("\r", "").replace("\n", "")), ("WARC-Payload-Digest", f"sha1:{digest}")]
    raw = payload.encode()
    if refers_to is not None:
        fields = target + [("WARC-Refers-To", f"<urn:page:{refers_to}:>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        block = f"HTTP/1.1 200 OK\r\nContent-Length: {len(raw)}\r\n\r\n".encode()
        return [_header("revisit", name, fields, len(block)) + block]
    block = HTTP + chunked(raw, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_header("response", name, target, len(block)) + block]
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_header("response", name, target + [("WARC-Segment-Number", "1")], len(parts[0])) + parts[0]]
    for i, part in enumerate(parts[1:], 2):
        fields = [("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", str(i))]
        if i == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_header("continuation", f"{name}:{i}", fields, len(part)) + part)
    return out


def write_archives(planned: DataFrame, path: str, segment_bytes: int = 32 << 10, chunk_bytes: int = 8 << 10, file_records: int = 2000) -> None:
    """Write the rows of ``plan_records`` as gzip-compressed WARC files of at most ``file_records`` records below ``path``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for r in batch.to_pylist():
                out += records_of(r["page_id"], r["row"], r["url"], r["payload"], r["digest"], r["refers_to"], segment_bytes, chunk_bytes)
                size += len(r["payload"])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = planned.withColumn("row", F.monotonically_increasing_id()).mapInArrow(build, "record binary")
    # A record is bytes; the text writer copies them and adds the record's end.
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names lower-cased) and block of each record of an archive."""
    at = 0
    while (at := data.find(VERSION, at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head: dict[str, str] = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            head[k.decode().strip().lower()] = v.decode("utf-8", "replace").strip()
        length = int(head.get("content-length", "0") or 0)
        yield head, data[end + 4 : end + 4 + length]
        at = end + 4 + length


_PARTS = "origin string, segment int, total long, type string, uri string, digest string, refers_to string, block binary"
_PAGES = "origin string, type string, uri string, payload binary, payload_bytes long, digest string, refers_to string, fault string"


def _finish(origin, kind, uri, digest, refers, block: bytes, fault: str | None) -> tuple:
    """Decode a whole block and verify it."""
    payload, size, found = None, None, None
    try:
        if fault is None:
            head, _, body = block.partition(b"\r\n\r\n")
            fields = head.lower()
            if kind == "revisit":
                size, found = int(fields.partition(b"content-length:")[2].split(b"\r\n")[0]), digest
            else:
                payload = unchunk(body) if b"transfer-encoding: chunked" in fields else body
                size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if digest and found != digest:
                    fault, payload = "digest differs", None
    except ValueError as error:
        fault = f"framing: {error}"
    return origin, kind, uri, payload, size, found, refers, fault


def _archive_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("type", pa.string()), ("uri", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary())])
    bare = lambda v: v.strip("<>") if v else None
    for batch in batches:
        for raw in batch.column("content"):
            data = raw.as_py()
            # Archives may be one gzip member or a member for each record.
            plain: list[bytes] = []
            while data[:2] == b"\x1f\x8b":
                inflate = zlib.decompressobj(31)
                plain.append(inflate.decompress(data))
                data = inflate.unused_data
            rows, size = [], 0
            for head, block in parse_records(b"".join(plain) or data):
                segment = int(head.get("warc-segment-number", "0"))
                origin = bare(head.get("warc-segment-origin-id") or head.get("warc-record-id"))
                total = head.get("warc-segment-total-length")
                digest = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                rows.append((origin, segment, int(total) if total else None, head.get("warc-type"), head.get("warc-target-uri"), digest, bare(head.get("warc-refers-to")), block))
                size += len(block)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("origin", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string()), ("refers_to", pa.string()), ("fault", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _batch([_finish(r["origin"], r["type"], r["uri"], r["digest"], r["refers_to"], r["block"], None) for r in batch.to_pylist()])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            parts = r["parts"]
            first, fault = parts[0], None
            block = b"".join(p["block"] for p in parts)
            total = next((p["total"] for p in parts if p["total"] is not None), None)
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                fault = "segments missing"
            elif total != len(block):
                fault = "total length differs"
            rows.append(_finish(r["origin"], first["type"], first["uri"], first["digest"], first["refers_to"], block, fault))
        if rows:
            yield _batch(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(origin, type, uri, payload, payload_bytes, digest, refers_to, fault)``: a row for each page in the archives below ``path``.

    Whole records are decoded where they are read; only segments are shuffled, by their origin. A revisit has no payload;
    its size is the one its HTTP headers state and its digest the recorded one.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")
    parts = files.mapInArrow(_archive_parts, _PARTS)
    whole = parts.filter("segment = 0").mapInArrow(_whole, _PAGES)
    kept = F.struct("segment", "total", "type", "uri", "digest", "refers_to", "block")
    grouped = parts.filter("segment > 0").groupBy("origin").agg(F.array_sort(F.collect_list(kept), lambda a, b: a["segment"] - b["segment"]).alias("parts"))
    return whole.unionByName(grouped.mapInArrow(_joined, _PAGES))


def page_of(origin: Column) -> Column:
    """The page id in a record name written by ``write_archives``."""
    return F.nullif(F.split(origin, ":")[2], F.lit("")).cast("long")
