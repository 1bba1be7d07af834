"""WARC archives: write page captures as transactions, read archives, assemble captures.

``write_archives`` writes three records per row - request, response (or revisit) and metadata,
tied by WARC-Concurrent-To - through Spark's text writer: a record is one value, and the line
separator is the CRLF CRLF that ends every WARC record, so each part file is a WARC 1.1 file,
committed by Spark. Parts are compressed (gzip, the file as a whole) and hold at most
``records_per_file`` records; a reader takes a part from its start to its end, so a payload that
itself holds a record start is always put together again by its Content-Length. Parts written
with ``compression="none"`` are read in splits; only there must ``whole_files`` be used if such a
payload lies across two of them (an error says so). ``assemble`` joins the records of a
transaction into one nested row.

Of equal payloads of at least ``least_bytes`` bytes the smallest id is stored as response, the
others as revisits that name it. Null payloads are empty; null ids never become the stored copy
if their payload has another; rows repeated in full are kept as often as they occur (equal ids
and payloads are all responses); other columns are ignored; empty tables give empty archives
and results.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import stage_root

END = "\r\n\r\n"
VERSION = "WARC/1.1\r\n"
#: The alphabets of base 32 as Spark's conv() writes it and as RFC 4648 does.
CONV32, RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base-32 digits."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), CONV32, RFC32)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str | Column, record_id: Column, uri: Column, block: Column, content_type: str,
            date: str, more: list[Column]) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    length = F.octet_length(block).cast("string")
    return F.concat(F.lit(VERSION), F.lit("WARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id,
                    F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri, *more,
                    F.lit(f"\r\nContent-Type: {content_type}\r\nContent-Length: "), length, F.lit(END), block)


def captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """The rows with digest, size, record id and, for revisits, the stored copy's id and record id."""
    text = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.regexp_replace(F.coalesce(F.col(url_col), F.lit("about:blank")), r"[\x00-\x20]", "%20").alias("uri"),
                        text.alias("payload"), base32_sha1(text.cast("binary")).alias("digest"), F.octet_length(text).alias("size"))
    rows = rows.withColumn("record_id", _uuid(F.col("id"), F.col("uri"), F.col("digest"), F.lit("response")))
    own = F.struct("id", "record_id")
    first = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(
        F.coalesce(F.min(F.when(F.col("id").isNotNull(), own)), F.min(own)).alias("first"))
    out = rows.join(first, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))
    return out.withColumn("revisit", revisit)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip", records_per_file: int = 60_000) -> None:
    """Write the archives of all rows into the folder ``path``."""
    rows = captures(pages, id_col, url_col, payload_col, least_bytes)
    rid, uri, digest = F.col("record_id"), F.col("uri"), F.col("digest")
    concurrent = F.concat(F.lit("\r\nWARC-Concurrent-To: "), rid)
    request = _record("request", _uuid(rid, F.lit("request")), uri, F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\n\r\n")),
                      "application/http; msgtype=request", date, [concurrent])
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    named = F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), digest)
    refers = F.when(F.col("revisit"), F.concat(
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
        F.col("first.record_id"))).otherwise(F.lit(""))
    response = _record(F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), rid, uri,
                       F.concat(head, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload"))),
                       "application/http; msgtype=response", date, [named, refers])
    metadata = _record("metadata", _uuid(rid, F.lit("metadata")), uri,
                       F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit(""))),
                       "application/warc-fields", date, [concurrent])
    rows.select(F.explode(F.array(request, response, metadata)).alias("value")) \
        .write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


RECORD = "type string, record_id string, concurrent_to string, uri string, refers_to string, digest string, head string, payload binary"


def _parse(raw: bytes) -> tuple | None:
    """The fields of one record, None if its block is not complete."""
    head, _, block = raw.partition(b"\r\n\r\n")
    named = {}
    for line in head.split(b"\r\n"):
        k, _, v = line.partition(b":")
        named[k.strip().lower()] = v.strip().decode("utf-8", "replace")
    length = int(named.get(b"content-length", "0"))
    if len(block) < length:
        return None
    block = block[:length]
    if named.get(b"content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
    else:
        http, body = b"", block
    digest = named.get(b"warc-payload-digest", "").removeprefix("sha1:")
    return (named.get(b"warc-type"), named.get(b"warc-record-id"), named.get(b"warc-concurrent-to"),
            named.get(b"warc-target-uri"), named.get(b"warc-refers-to"), digest or None, http.decode("utf-8", "replace"), body)


def _records(values: Iterable[bytes]) -> Iterator[tuple]:
    """Records from the pieces between record starts; pieces of one record are joined again."""
    start, held = VERSION.encode(), b""
    for value in values:
        held = held + END.encode() + start + value if held else value.removeprefix(start)
        got = _parse(held)
        if got is not None:
            held = b""
            yield got
    if held.strip():
        raise ValueError("a record with a record start in its payload lies across file splits; read with whole_files=True")


def read_records(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``. ``whole_files`` reads each file in one
    task instead of in splits."""
    if whole_files:
        source = spark.read.format("binaryFile").load(path).select(F.col("content").alias("value"))
    else:
        source = spark.read.option("lineSep", END + VERSION).text(path).select(F.col("value").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        kinds = [pa.string()] * 7 + [pa.binary()]

        def values() -> Iterator[bytes]:
            for b in batches:
                for v in b.column("value"):
                    yield from ((END + VERSION).encode().join([b"", v.as_py()]).split((END + VERSION).encode())[1:] if whole_files else [v.as_py()])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        rows, held = [], 0
        for r in _records(values()):
            rows.append(r)
            held += len(r[-1])
            if held > 8 << 20 or len(rows) >= 5000:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    return source.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (record id), ``copies``, and the structs
    ``response`` (response or revisit), ``request`` and ``metadata`` (null where missing).
    Records that share an id and content are one capture with several copies."""
    key = F.when(F.col("type").isin("request", "metadata"), F.col("concurrent_to")).otherwise(F.col("record_id"))
    main = F.col("type").isin("response", "revisit")
    part = lambda cond, *cols: F.min(F.when(cond, F.struct(*cols)))
    return records.withColumn("capture", key).where(F.col("capture").isNotNull()).groupBy("capture").agg(
        F.count(F.when(main, 1)).alias("copies"),
        part(main, "type", "uri", "digest", "refers_to", "head", "payload").alias("response"),
        part(F.col("type") == "request", "record_id", "uri", "head").alias("request"),
        part(F.col("type") == "metadata", "record_id", "head", "payload").alias("metadata"))


def digests(records: DataFrame) -> DataFrame:
    """The records with size and digest of the payload in place of the payload, so that
    assembling moves few bytes. Metadata keep their fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, bodies, named = b.column("type").to_pylist(), b.column("payload").to_pylist(), b.column("digest").to_pylist()
            sha = [base64.b32encode(hashlib.sha1(x).digest()).decode() if k == "response" else d for k, x, d in zip(kinds, bodies, named)]
            fields = [x.decode("utf-8", "replace") if k == "metadata" else "" for k, x in zip(kinds, bodies)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("type", "record_id", "concurrent_to", "uri", "refers_to")), pa.array(sha, pa.string()),
                 pa.array(fields, pa.string()), pa.array([len(x) for x in bodies], pa.int64())],
                names=["type", "record_id", "concurrent_to", "uri", "refers_to", "digest", "head", "payload"])

    return records.mapInArrow(run, RECORD.replace("payload binary", "payload long"))


def roundtrip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` (page_id, url, html) to the shared folder, read them back,
    assemble the transactions, and return per page what the archives say of it."""
    spark = pages.sparkSession
    path = f"{stage_root(spark)}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes=least_bytes)
    caps = assemble(digests(read_records(spark, path))).select(
        "capture", "copies", F.expr("try_cast(nullif(substring(metadata.head, 10), '') as bigint)").alias("page_id"), "response.*")
    stored = caps.where(F.col("type") == "response").select(
        F.col("capture").alias("stored"), F.col("page_id").alias("stored_id"), F.col("payload").alias("stored_bytes"))
    # only revisits are joined: the others' empty reference would meet in one task
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    found = caps.where(F.col("refers_to").isNotNull()).join(stored, F.col("refers_to") == F.col("stored"), "left").select(
        "page_id", F.coalesce("stored_bytes", "payload").alias("payload_bytes"), "digest", "type", "stored_id", copies)
    own = caps.where(F.col("refers_to").isNull()).select(
        "page_id", F.col("payload").alias("payload_bytes"), "digest", "type", F.lit(None).cast("long").alias("stored_id"), copies)
    return found.union(own).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"),
                                   F.col("type").alias("record_type"), F.col("stored_id").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, h,
        array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            CAST(((('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INTEGER), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1 AS INTEGER), 1)
            for k in range(0, 32)], '') AS payload_digest
      FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
