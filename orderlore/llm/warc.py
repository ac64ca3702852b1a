"""Web archives: records written with segments and chunked framing, and read back whole."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.llm.common import located
from orderlore.sources.tables import materialise

SEGMENT = 32_768  # most bytes of a record's block; longer ones are continued
CHUNK = 8_192  # bytes of a chunk of the transfer framing
RECORDS = 1_500  # records of a file, so that a file stays below RECORDS * SEGMENT bytes and some headers
SAME = 1_000  # payloads from so many bytes on are written once

_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ----------------------------------------------------------------------------

def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in the chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(x), x) for x in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0", _END])


def unchunked(data: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if at + size + 2 > len(data) or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(data[at : at + size])
        at += size + 2


def body_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, _, body = block.partition(_END)
    framed = any(
        name.strip().lower() == b"transfer-encoding" and b"chunked" in value.lower()
        for name, _, value in (line.partition(b":") for line in head.split(b"\r\n")[1:])
    )
    return unchunked(body) if framed else body


def _record(kind: str, name: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), *fields, ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    return head.encode() + b"\r\n" + block


def _uuid(digest: bytes) -> str:
    x = digest.hex()
    return f"{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:32]}"


def records_of(row: dict, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page: a revisit, or a response with as many continuations as it needs."""
    name = row["record"]
    url = row["url"]
    if url is not None:
        url = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    shared = [
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Page-ID", row["page_id"]),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if row["refers_to"] is not None:
        fields = [*shared, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:uuid:{row['refers_to']}>")]
        return [_record("revisit", name, fields, head + b"\r\n")]
    block = head + b"Transfer-Encoding: chunked" + _END + chunked(row["payload"])
    if len(block) <= segment:
        return [_record("response", name, shared, block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [_record("response", name, [*shared, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        own = _uuid(hashlib.md5(f"{name} {k}".encode()).digest())
        fields = [
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", f"<urn:uuid:{name}>"),
            ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None),
        ]
        out.append(_record("continuation", own, fields, part))
    return out


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive file."""
    at = 0
    while at < len(content):
        end = content.index(_END, at)
        first, *lines = content[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if stop > len(content):
            raise ValueError("a record is cut off")
        yield fields, content[start:stop]
        at = stop + (4 if content[stop : stop + 4] == _END else 0)


# --- writing ----------------------------------------------------------------------------

def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for each row of ``pages`` (page_id long, url, html) to archive files below ``path``.

    Payload is the html in UTF-8; null counts as empty. Of rows with equal payloads of at least SAME bytes the one
    with the largest page_id (null last; of equal ones any) is the response, the others revisit it. Blocks longer than SEGMENT
    are continued in further records. Spark's text writer puts the records, which end with two line ends, into files, so
    the archives go wherever Spark can write.
    """
    rows, file, at = located(pages.select("page_id", "url", "html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.select(
        F.col("page_id").cast("long"), "url", payload.alias("payload"), F.sha1(payload).alias("digest"),
        F.md5(F.concat_ws(" ", file, at)).alias("record"),
    )
    large = rows.where(F.octet_length("payload") >= SAME).select("digest", "page_id", "record")
    again = large.groupBy("digest").count().where("count > 1").select("digest")
    largest = F.max(F.struct(F.col("page_id").isNotNull().alias("some"), "page_id", "record")).alias("x")
    chosen = large.join(again, "digest").groupBy("digest").agg(largest)
    chosen = materialise(chosen.select("digest", F.col("x.record").alias("first"), F.col("x.page_id").alias("id")), "first")
    # equal rows of the chosen id are responses too
    refers = F.when((F.col("first") != F.col("record")) & ~F.col("page_id").eqNullSafe(F.col("id")), F.col("first"))
    dashed = lambda c: F.regexp_replace(c, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    named = rows.join(chosen, "digest", "left").select(
        "page_id", "url", "payload", "digest", dashed(F.col("record")).alias("record"), dashed(refers).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = [r for row in batch.slice(start, 200).to_pylist() for r in records_of(row)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = named.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS).text(path)


# --- reading ----------------------------------------------------------------------------

_READ = "record string, type string, page_id long, url string, refers_record string, digest string, number int, total long, payload binary"


def _row(fields: dict[str, str], record: str, payload: bytes | None, number: int | None = None) -> dict:
    bare = lambda x: x.strip("<>").removeprefix("urn:uuid:") if x else None
    total = fields.get("warc-segment-total-length")
    return {
        "record": bare(record), "type": fields["warc-type"], "url": fields.get("warc-target-uri"),
        "page_id": int(fields["warc-page-id"]) if "warc-page-id" in fields else None,
        "refers_record": bare(fields.get("warc-refers-to")),
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "number": number, "total": int(total) if total else None, "payload": payload,
    }


_ARROW = pa.schema([
    ("record", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("refers_record", pa.string()), ("digest", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
    ("payload", pa.binary()),
])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all records; parts of segmented ones keep their raw block and the name of the first record."""
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for fields, block in parsed(content.as_py()):
                if fields["warc-type"] not in ("response", "revisit", "continuation"):
                    continue
                number = fields.get("warc-segment-number")
                origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                if number is None:
                    payload = body_of(block) if fields["warc-type"] == "response" else None
                    rows.append(_row(fields, fields["warc-record-id"], payload))
                else:
                    rows.append(_row(fields, origin, block, int(number)))
                held += len(block)
                if held > 1 << 22:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _whole(parts: list[dict]) -> dict:
    """One response from its segments in order; they must be complete and as long as the last one says."""
    first, last = parts[0], parts[-1]
    if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or first["type"] != "response":
        raise ValueError(f"segments of {first['record']} are missing or repeated")
    block = b"".join(p["payload"] for p in parts)
    if last["total"] != len(block):
        raise ValueError(f"segments of {first['record']} hold {len(block)} bytes instead of {last['total']}")
    return first | {"payload": body_of(block), "number": None, "total": len(block)}


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments arrive by name and number; one row per name leaves."""
    parts: list[dict] = []
    for batch in batches:
        for row in (r for start in range(0, batch.num_rows, 64) for r in batch.slice(start, 64).to_pylist()):
            if parts and parts[0]["record"] != row["record"]:
                yield _batch([_whole(parts)])
                parts = []
            parts.append(row)
    if parts:
        yield _batch([_whole(parts)])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits of the archive files below ``path``.

    Continuation records are grouped with the first record by its identifier, ordered by segment number, checked
    for gaps and total length, and only then freed of the chunked framing. Broken archives raise an error.

    Returns record, type, page_id, url, refers_record, digest (as written), payload (null for revisits).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    rows = files.mapInArrow(_read, _READ)
    parts = rows.where("number is not null").repartition("record").sortWithinPartitions("record", "number")
    whole = rows.where("number is null").unionAll(parts.mapInArrow(_joined, _READ))
    return whole.select("record", "type", "page_id", "url", "refers_record", "digest", "payload")


def payload_table(records: DataFrame) -> DataFrame:
    """Per record page_id, payload_bytes, payload_digest (of the payload itself), record_type, refers_to.

    A revisit has the payload of the record that it refers to, and that record's page_id as refers_to.
    """
    measured = records.select(
        "record", F.col("type").alias("record_type"), "page_id", "refers_record",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
    )
    measured = materialise(measured, "payloads")
    full = measured.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    target = measured.where("record_type = 'response'").select(
        F.col("record").alias("refers_record"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    again = measured.where("record_type = 'revisit'").select("page_id", "record_type", "refers_record")
    again = again.join(target, "refers_record", "left")
    return full.unionByName(again.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Archives of ``pages`` written below ``path`` and read back: the ``payload_table`` with one row per page.

    Null html is an empty payload; null ids, null urls and repeated rows are kept. Empty tables give empty results;
    other columns are ignored.
    """
    spark = pages.sparkSession
    write_archives(pages, path)
    return payload_table(read_archives(spark, path))
