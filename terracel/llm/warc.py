"""WARC archives: written from pages, read back record by record and assembled into captures by transaction."""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_join, read_table, scratch_path, stage
from .registry import query

VERSION = "WARC/1.1"
CRLF = "\r\n"
#: Between records.
GAP = CRLF + CRLF
RECORDS_PER_FILE = 1_000
DATE = "2020-01-01T00:00:00Z"
#: Digits of base 32 as ``conv`` writes them, and as archives do.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Base-32 SHA-1 of ``payload``: every five hex digits are four digits of base 32."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def urn(*parts: Column) -> Column:
    """A record id made from ``parts``."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def record(kind: Column, record_id: Column, fields: dict[str, Column], block: Column) -> Column:
    """One record without the gap after it; fields that are null are left out."""
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": F.lit(DATE)} | fields
    head["Content-Length"] = F.octet_length(block).cast("string")
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in head.items()]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(GAP), block)


def one_line(text: Column) -> Column:
    """``text`` with line breaks percent-encoded, so that it stays one header line."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write request, response or revisit, and metadata records of ``pages`` (page_id, url, html) as gzipped archives.

    Of equal payloads of at least ``min_revisit_bytes`` bytes the smallest page_id is a response; the others are
    revisits without payload that refer to it.  Only keys decide this: pages move once, to the digests that occur
    more than once or not, and a very frequent payload is salted.  Files hold ``records_per_file`` pages at most.

    Null html is an empty payload, told apart in the metadata; null urls have no target; a null page_id is larger
    than any other; rows repeated with the smallest page_id are all responses; an empty table gives no captures; other
    columns are not written.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", "html", base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    groups = stage(
        p.filter(F.col("bytes") >= min_revisit_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")),
        "payloads",
    )
    n_pages = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    p = hot_join(p, groups, ["digest", "bytes"], "n", n_pages, ["page_id", "url"], "left")
    revisit = (F.col("bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    p = p.withColumn("revisit", revisit).withColumn("nth", F.monotonically_increasing_id())
    first = urn(F.lit("response"), F.col("digest"), F.col("first_id"))
    main_id = F.when(F.col("revisit"), urn(F.lit("revisit"), F.col("digest"), F.col("page_id"), F.col("nth"))).otherwise(
        urn(F.lit("response"), F.col("digest"), F.col("page_id"))
    )
    url = one_line(F.col("url"))
    host = F.coalesce(F.regexp_extract(url, "^[a-z]+://([^/]*)", 1), F.lit(""))
    target = F.coalesce(F.regexp_extract(url, "^[a-z]+://[^/]*(/[^#]*)", 1), F.lit(""))
    ask = F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(GAP))
    status = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(GAP)
    )
    note = F.concat_ws(
        CRLF, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.concat(F.lit("html: "), F.when(F.col("html").isNull(), "null").otherwise("text")), F.lit("")
    )
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = lambda kind: F.lit(f"application/http;msgtype={kind}")
    side = lambda kind: urn(F.lit(kind), F.col("main_id"), F.col("nth"))
    p = p.withColumn("main_id", main_id)
    request = record(F.lit("request"), side("request"), {"WARC-Target-URI": url, "WARC-Concurrent-To": F.col("main_id"), "Content-Type": http("request")}, ask)
    main = record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), F.col("main_id"),
        {
            "WARC-Target-URI": url, "WARC-Payload-Digest": digest, "Content-Type": http("response"),
            "WARC-Refers-To": F.when(F.col("revisit"), first),
            "WARC-Profile": F.when(F.col("revisit"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        },
        F.when(F.col("revisit"), status).otherwise(F.concat(status, F.coalesce("html", F.lit("")))),
    )
    meta = record(
        F.lit("metadata"), side("metadata"), {"WARC-Target-URI": url, "WARC-Concurrent-To": F.col("main_id"), "Content-Type": F.lit("application/warc-fields")}, note
    )
    text = p.select(F.concat(request, F.lit(GAP), main, F.lit(GAP), meta).alias("value"))
    text.write.option("lineSep", GAP).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse_records(stream):
    """(headers, block) of each record of an uncompressed archive; header names in lower case, each with all its values."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:60]!r}")
        head: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(head["content-length"][0])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {head.get('warc-record-id', [None])[0]} is cut off")
        yield head, block


RECORD = pa.schema([
    ("kind", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("stated_digest", pa.string()), ("head", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])


def _records(with_payload: bool):
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                raw = pa.py_buffer(content.as_buffer())
                stream = io.BufferedReader(io.BytesIO(raw))
                if stream.peek(2)[:2] == b"\x1f\x8b":
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18)
                rows: list[tuple] = []
                held = 0
                for fields, block in parse_records(stream):
                    head = {name: values[0] for name, values in fields.items()}
                    kind = head.get("warc-type")
                    http = head.get("content-type", "").startswith("application/http")
                    first, _, payload = block.partition(b"\r\n\r\n") if http else (block, b"", b"")
                    full = kind == "response"
                    rows.append((
                        kind, head.get("warc-record-id"), head.get("warc-target-uri"), fields.get("warc-concurrent-to", []), head.get("warc-refers-to"),
                        head.get("warc-payload-digest"), first.decode("utf-8", "replace"), payload if full and with_payload else None,
                        len(payload) if full else None, b32encode(hashlib.sha1(payload).digest()).decode() if full else None,
                    ))
                    held += len(block)
                    if held > 4 << 20 or len(rows) > 2000:
                        yield pa.RecordBatch.from_pylist([dict(zip(RECORD.names, r, strict=True)) for r in rows], RECORD)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(RECORD.names, r, strict=True)) for r in rows], RECORD)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all archives below ``path``, gzipped (one or many members) or plain; one file is one unit of work."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(
        _records(with_payload),
        "kind string, record_id string, target_uri string, concurrent_to array<string>, refers_to string, stated_digest string, "
        "head string, payload binary, payload_bytes long, payload_digest string",
    )


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, kind, target_uri, refers_to, digest, response, requests, metadata.

    A capture is a response or revisit.  Requests and metadata records, all of them, belong to the captures that
    they name as concurrent or that name them; both are arrays of (record_id, head) by record_id, empty
    where there is none.  Sides without a capture belong to none, captures repeated with one id keep a row
    each, sides repeated with one id and head count once, records without an id have no sides.  Very long
    payloads stay in their row.  ``records`` is read three times: stage it if it is costly.
    """
    main = records.filter(F.col("kind").isin("response", "revisit"))
    sides = records.filter(F.col("kind").isin("request", "metadata")).select("kind", "concurrent_to", F.struct("record_id", "head").alias("side"))
    named = sides.select(F.explode("concurrent_to").alias("capture"), "kind", "side")
    asked = main.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("wanted"))
    answered = asked.join(sides.select("kind", "side", F.col("side.record_id").alias("wanted")), "wanted").select("capture", "kind", "side")
    of = lambda kind: F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("side"))))
    found = named.unionByName(answered).groupBy(F.col("capture").alias("record_id")).agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    captures = main.select(
        "record_id", "kind", "target_uri", "refers_to", F.regexp_replace("stated_digest", "^sha1:", "").alias("digest"),
        F.struct("head", "payload", "payload_bytes", "payload_digest").alias("response"),
    ).join(found, "record_id", "left")
    none = F.array().cast("array<struct<record_id:string,head:string>>")
    return captures.withColumns({c: F.coalesce(c, none) for c in ("requests", "metadata")})


def page_id_of(metadata: Column) -> Column:
    """The page id that the first of a capture's metadata records names that names one."""
    ids = F.transform(metadata, lambda m: F.regexp_extract(m["head"], r"(?m)^page-id: (-?\d+)\r?$", 1))
    return F.get(F.filter(ids, lambda x: x != ""), F.lit(0)).cast("long")


def capture_pages(captures: DataFrame) -> DataFrame:
    """Page, payload and reference of each of the staged ``captures``; revisits take size and digest of what they refer to."""
    c = captures.select(
        "record_id", "kind", "refers_to", "digest", page_id_of(F.col("metadata")).alias("page_id"), "response.payload_bytes", "response.payload_digest"
    )
    revisits = c.filter("kind = 'revisit'").select("page_id", "digest", F.col("refers_to").alias("ref"))
    wanted = revisits.groupBy("ref").agg(F.count(F.lit(1)).alias("n"))
    given = c.filter("kind = 'response'").groupBy(F.col("record_id").alias("ref")).agg(
        F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest")
    )
    groups = stage(wanted.join(given, "ref", "left"), "referred")
    n = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = hot_join(revisits, groups, ["ref"], "n", n, ["page_id"], "left")
    right = F.col("payload_digest") == F.col("digest")
    checked = F.when(right, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload does not have its stated digest")))
    columns = ["page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to"]
    revisited = found.withColumn("record_type", F.lit("revisit")).select(*columns)
    responses = c.filter("kind = 'response'").withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")}).select(*columns)
    return responses.unionByName(revisited)


OP7_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT h, octet_length(payload) AS n, min(page_id) AS first_id FROM p GROUP BY ALL),
b AS (
  SELECT p.page_id, f.n AS payload_bytes, p.h, f.first_id FROM p JOIN f ON p.h = f.h AND octet_length(p.payload) = f.n
)
SELECT page_id, payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(b.h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31), 1), '' ORDER BY k)
   FROM range(32) t(k)) AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
"""


@query("op7_warc", OP7_SQL)
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives, read back and assembled."""
    path = scratch_path(spark, "warc")
    write_warc(read_table(spark, folder, "pages"), path)
    records = stage(read_records(spark, path, with_payload=False), "records")
    return capture_pages(stage(assemble(records), "captures"))
