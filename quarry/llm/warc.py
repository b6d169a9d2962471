"""WARC archives: writing, reading back, and assembling transactions through concurrent-to identifiers (operator 5).

Each page becomes a request, a response or revisit, and a metadata record; request and metadata name the response by WARC-Concurrent-To.
Of equal payloads the response with the smallest page id is stored, the others become revisits that refer to it. Spark's
text writer stores the records (their last line feed is the line's end), gzipped, in files of a bounded number of bytes.
Reading takes the records apart by their Content-Length, joins request and metadata to their response, and resolves revisits.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_arrow, new_path, struct

LEAST_REVISIT_BYTES = 100
#: Bytes of records, before gzip, at which a file ends; the record at hand still goes into it.
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = struct(("record", "binary"))
RECORDS = struct(
    ("record_id", "string"), ("type", "string"), ("concurrent_to", "string"), ("refers_to", "string"), ("target_uri", "string"), ("date", "string"),
    ("http", "string"), ("fields", "string"), ("payload", "binary"), ("payload_bytes", "bigint"), ("payload_digest", "string"),
)


def record_id(kind: str, page_id: int | None, url: str | None, digest: str) -> str:
    """Always the same for the same capture, so that a task run again writes the same records."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{kind} {page_id} {digest} {url}'.encode('utf-8', 'surrogatepass')).digest())}>"


def record(kind: str, own_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def on_one_line(url: str | None) -> str:
    """A URL as a header's value: control characters escaped."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url or "").strip()


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, first_id: int | None, first_url: str | None, revisit: bool) -> list[bytes]:
    uri = on_one_line(url)
    target = [("WARC-Target-URI", uri)] if uri else []
    capture = record_id("capture", page_id, url, digest)
    status = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    host, _, path = uri.partition("://")[2].partition("#")[0].partition("/")
    request = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode("utf-8", "surrogatepass")
    known = [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        main = record("revisit", capture, [*target, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("capture", first_id, first_url, digest)), *known], status)
    else:
        main = record("response", capture, [*target, *known], status + payload)
    return [
        record("request", record_id("request", page_id, url, digest), [*target, ("WARC-Concurrent-To", capture), ("Content-Type", "application/http;msgtype=request")], request),
        main,
        record("metadata", record_id("metadata", page_id, url, digest), [*target, ("WARC-Concurrent-To", capture), ("Content-Type", "application/warc-fields")], b"" if page_id is None else b"page-id: %d\r\n" % page_id),
    ]


def write_warc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Writes three records per row of pages (page_id, url, html) below path, which all executors must reach, in files of at most `file_bytes` and one page's records before gzip.

    Of equal payloads of at least 100 bytes, those with the smallest page_id are responses and the others revisits (rows that repeat
    the smallest id are all responses; null ids count last). Null html is an empty payload. An empty table writes no records.
    """
    page = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("size", F.octet_length("html")).withColumn("digest", F.sha2("html", 256))
    groups = page.filter(F.col("size") >= LEAST_REVISIT_BYTES).groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url"))).alias("first"), F.count("*").alias("n"))
    first = groups.filter("n > 1").select(F.col("digest").alias("known"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    told = page.join(first, page["digest"] == first["known"], "left").withColumn("revisit", F.col("known").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))

    def archive(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(records)[:-1]], pa.binary())], WRITTEN.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "digest", "first_id", "first_url", "revisit")]
            for page_id, url, digest, first_id, first_url, revisit, payload in zip(*columns, batch.column("html").cast(pa.large_binary()).to_pylist()):
                records = records_of(page_id, url, payload, digest, first_id, first_url, revisit)
                out += records
                held += sum(map(len, records))
                if held >= file_bytes:
                    yield archive(out)
                    out, held = [], 0
        if out:
            yield archive(out)

    # a row is a whole archive, so a file has one
    lines = map_arrow(told.select("page_id", "url", "digest", "first_id", "first_url", "revisit", "html"), run, WRITTEN).select(F.col("record").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def parse(archive: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    while line := archive.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := archive.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = archive.read(size)
        if len(block) < size:
            raise ValueError("an archive ends inside a record")
        yield fields, block


def readable(archive: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """As parse; where an archive is damaged, what stands before the damage and then one record of type damaged, whose block says why."""
    try:
        yield from parse(archive)
    except (ValueError, KeyError, EOFError, OSError, zlib.error) as error:
        yield {"warc-type": "damaged"}, f"{type(error).__name__}: {error}".encode()


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below path (gzipped or not, each below Spark's 2 GB for a value); payload is null without `payloads`, its length and digest are always those of the whole payload.

    Of a damaged archive the records before the damage come back, and one of type damaged whose fields say what is wrong; the others aren't affected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_py()
                archive = gzip.open(io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
                rows: list[tuple] = []
                held = 0
                for fields, block in readable(archive):
                    kind = fields.get("warc-type")
                    http, payload = block, b""
                    if kind in ("response", "revisit", "request"):
                        http, _, payload = block.partition(b"\r\n\r\n")
                    stored = kind == "response"
                    digest = hashlib.sha256(payload).hexdigest() if stored else fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    text = http.decode("utf-8", "replace")
                    rows.append((fields.get("warc-record-id"), kind, fields.get("warc-concurrent-to"), fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"), None if kind in ("metadata", "damaged") else text, text if kind in ("metadata", "damaged") else None, payload if stored and payloads else None, len(payload) if stored else None, digest))
                    held += len(block)
                    if held > 8 << 20 or len(rows) >= 5_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(list(c), kinds.get(n, pa.string())) for n, c in zip(RECORDS.names, zip(*rows))], RECORDS.names)

    return map_arrow(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content"), run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture (records are read several times, so pass a table): capture_id, target_uri, record_type, request, response, metadata.

    Request and metadata join the response or revisit that they name as concurrent (null where there is none; of several, one with the least id). A
    revisit's payload is that of the response it refers to; payload fields are null if that is missing. Captures written twice come back twice.
    """

    def of(kind: str) -> DataFrame:
        return records.filter(F.col("type") == kind).filter("concurrent_to IS NOT NULL")

    request = of("request").groupBy("concurrent_to").agg(F.min(F.struct("record_id", "http")).alias("request"))
    page_id = F.regexp_extract("fields", r"(?m)^page-id: (-?\d+)", 1)
    metadata = of("metadata").groupBy("concurrent_to").agg(F.min(F.struct("record_id", F.when(page_id != "", page_id.cast("bigint")).alias("page_id"), "fields")).alias("metadata"))
    main = records.filter(F.col("type").isin("response", "revisit"))
    joined = (
        main.join(request.withColumnRenamed("concurrent_to", "r_to"), F.col("record_id") == F.col("r_to"), "left")
        .join(metadata.withColumnRenamed("concurrent_to", "m_to"), F.col("record_id") == F.col("m_to"), "left")
        .select("record_id", "target_uri", "type", "date", "refers_to", "http", "payload", "payload_bytes", "payload_digest", "request", "metadata")
    )
    stored = joined.filter("type = 'response'")
    # a response written twice is one referent
    referent = stored.groupBy("record_id").agg(F.first(F.struct("payload", "payload_bytes", "payload_digest", F.col("metadata.page_id").alias("page_id"))).alias("of")).withColumnRenamed("record_id", "of_id")
    again = joined.filter("type = 'revisit'").join(referent, F.col("refers_to") == F.col("of_id"), "left")
    nested = lambda payload, size, digest, page: F.struct("record_id", "date", "http", payload.alias("payload"), size.alias("payload_bytes"), digest.alias("payload_digest"), F.col("refers_to"), page.alias("refers_to_page"))
    same = F.col("of.payload_digest") == F.col("payload_digest")
    rows = [
        stored.withColumn("response", nested(F.col("payload"), F.col("payload_bytes"), F.col("payload_digest"), F.lit(None).cast("bigint"))),
        again.withColumn("response", nested(F.when(same, F.col("of.payload")), F.when(same, F.col("of.payload_bytes")), F.when(same, F.col("of.payload_digest")), F.col("of.page_id"))),
    ]
    wanted = [F.col("record_id").alias("capture_id"), "target_uri", F.col("type").alias("record_type"), "request", "response", "metadata"]
    return rows[0].select(*wanted).unionByName(rows[1].select(*wanted))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back, and returns one row per page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = new_path(pages.sparkSession, "warc")
    write_warc(pages, path)
    captures = assemble(cut(read_records(pages.sparkSession, path, payloads=False), "records"))
    return captures.select(F.col("metadata.page_id").alias("page_id"), "response.payload_bytes", "response.payload_digest", "record_type", F.col("response.refers_to_page").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS least FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN n >= 100 AND least < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND least < page_id THEN least END AS refers_to
FROM g
"""
