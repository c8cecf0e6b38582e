"""WARC archives with revisit resolution.

Record headers (no payloads) meet by payload digest; of records with equal payloads the
one with the largest id is written as ``response`` and the others as ``revisit`` records
that refer to it, with headers of their own and no payload.  Payloads move once, by digest,
to the task that writes their file.  The few digests that hold more than a ``HOT``-th of all
records are told beforehand: their revisits travel without payload and by row, so a digest
of any size is spread over all files.  Archives are written by
Spark's text sink: a record is one value and the ``CRLF CRLF`` that ends a WARC record is
the line separator, so every part file is a WARC/1.1 file (gzipped as a whole unless asked
otherwise) and commits, retries and lost executors are Spark's business.  They are read back record by record, by their
Content-Length, so a payload may hold any text, WARC headers included.

Defined results: null payload counts as empty and is archived as such; payloads are equal
when their SHA-1 and length are; records that repeat the largest id of their group are all
responses; a null id never beats another id, and a group of null ids is all responses; an
empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import table, written
from tripaudit.session import scratch_path

CRLF = "\r\n"
END = CRLF + CRLF
# Fixed value: the first bytes of a gzipped file.
GZIP = b"\x1f\x8b"
#: Bytes of an archive file aimed at; a file holds whole records and is read by one task.
FILE_BYTES = 32 << 20
#: A digest with more than one in so many records is hot; there are fewer than this of them.
HOT = 10_000
READ_SCHEMA = ("record_id string, record_type string, url string, payload_bytes bigint, "
               "payload_digest string, refers_to string")


def base32_sha1(payload):
    """Upper-case base32 SHA-1 of a string column: 20 bits (four digits) at a time."""
    hexed = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_digests(pages: DataFrame, payload: str = "html") -> DataFrame:
    body = F.coalesce(F.col(payload), F.lit(""))
    return (pages.withColumn("payload", body).withColumn("payload_bytes", F.octet_length(body).cast("bigint"))
            .withColumn("payload_digest", base32_sha1(body)))


def resolve_revisits(headers: DataFrame, id_col: str, min_bytes: int = 0) -> DataFrame:
    """Digests held by several records (``_n``), and the id that is kept as response.

    Only groups of at least ``min_bytes`` payload bytes; partial aggregation folds a hot
    digest before the shuffle."""
    return (headers.where(F.col("payload_bytes") >= min_bytes)
            .groupBy("payload_digest", "payload_bytes")
            .agg(F.max(id_col).alias("response_id"), F.count("*").alias("_n"))
            .where("_n > 1"))


def record_text(id_col: str, url: str, date: str):
    """A WARC record without its closing CRLF CRLF."""
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    # Header values are JSON strings, so line breaks in a url cannot end a header.
    ident = F.concat(F.lit("<urn:record:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(">"))
    target = F.to_json(F.struct(F.col(url).alias("u")))
    plain = F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", ident),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", plain), F.lit("")),
        line("X-Target", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(F.col("record_type") == "revisit", F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<urn:record:"), F.col("response_id").cast("string"), F.lit(">"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("X-Payload-Length", F.col("payload_bytes").cast("string"))))
        .otherwise(line("Content-Type", F.lit("text/html; charset=utf-8"))),
        line("Content-Length", F.when(F.col("record_type") == "revisit", F.lit("0"))
             .otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF))
    return F.concat(head, F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("payload")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
                   min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES,
                   compression: str = "gzip") -> None:
    """Write ``pages`` as deduplicated WARC archives under ``path``."""
    recs = with_digests(pages, payload)
    total = recs.agg(F.sum("payload_bytes"), F.count("*")).first()
    files = 1 + ((total[0] or 0) + 400 * total[1]) // file_bytes
    headers = recs.select(id_col, "payload_digest", "payload_bytes")
    kept = written(resolve_revisits(headers, id_col, min_bytes)
                   .withColumn("_key", F.concat_ws(":", "payload_digest", "payload_bytes")), "revisits")
    hot = kept.where(F.col("_n") > total[1] / HOT).select("_key", F.col("response_id").alias("_hot"))

    def revisit(response):
        return ~F.col(id_col).eqNullSafe(response) & response.isNotNull()

    # Fewer than HOT rows, whatever the input.
    told = (recs.withColumn("_key", F.concat_ws(":", "payload_digest", "payload_bytes"))
            .join(F.broadcast(hot), "_key", "left")
            .withColumn("payload", F.when(~revisit(F.col("_hot")), F.col("payload")))
            .withColumn("_key", F.when(F.col("_hot").isNull(), F.col("_key")).otherwise(F.monotonically_increasing_id().cast("string")))
            .repartition(files, "_key"))
    # The only exchange of payloads; the other side of the join follows its partitioning.
    typed = (told.join(kept.where(F.col("_n") <= total[1] / HOT).select("_key", "response_id").hint("shuffle_hash"),
                       "_key", "left")
             .withColumn("response_id", F.coalesce("_hot", "response_id"))
             .withColumn("record_type", F.when(revisit(F.col("response_id")), "revisit").otherwise("response")))
    (typed.select(record_text(id_col, url, date).alias("value"))
     .write.option("lineSep", END).option("compression", compression).text(path))


def parse_records(data: bytes):
    """(headers, payload) of every record of an archive file."""
    at, end = 0, END.encode()
    while at < len(data):
        stop = data.index(end, at)
        lines = data[at:stop].decode().split(CRLF)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin = stop + len(end)
        size = int(head["Content-Length"])
        if data[begin + size:begin + size + len(end)] != end:
            raise ValueError(f"record at byte {at} is cut off")
        yield head, data[begin:begin + size]
        at = begin + size + len(end)


def _length(head: dict[str, str]) -> int | None:
    """Payload length that a revisit record states of the response it refers to."""
    stated = head.get("X-Payload-Length")
    return None if stated is None else int(stated)


def _read(batches):
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())])

    def ident(value):
        inner = value and value.removeprefix("<urn:record:").removesuffix(">")
        return None if inner in (None, "null") else inner

    for batch in batches:
        for content in batch.column(0):
            rows = []
            data = content.as_py()
            for head, payload in parse_records(gzip.decompress(data) if data[:2] == GZIP else data):
                kind = head["WARC-Type"]
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                rows.append((ident(head["WARC-Record-ID"]), kind, json.loads(head["X-Target"]).get("u"),
                             len(payload) if kind == "response" else _length(head), digest, ident(head.get("WARC-Refers-To"))))
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under ``path`` in one scan; payload lengths and digests of
    responses are taken from the payloads, those of revisits from their headers (``resolved``
    looks lengths up that a header does not state)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("content").mapInArrow(_read, READ_SCHEMA))


def resolved(recs: DataFrame) -> DataFrame:
    """Give every revisit that states none the payload length of its response."""
    sizes = (recs.where("record_type = 'response'")
             .groupBy(F.col("record_id").alias("refers_to"), "payload_digest")
             .agg(F.max("payload_bytes").alias("_bytes")))
    return (recs.join(sizes, ["refers_to", "payload_digest"], "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_bytes"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archives back and resolve the revisits."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    recs = read_archives(spark, path)
    return recs.select(F.col("record_id").cast("bigint").alias("page_id"), "url", "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


ORACLE_OP7 = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
h AS (
  SELECT *, sha1(body) AS hexed, max(page_id) OVER (PARTITION BY body) AS newest FROM p),
d AS (
  SELECT *, array_to_string(
    [to_base(('0x' || substr(hexed, (1 + 5 * i)::BIGINT, 5))::BIGINT, 32, 4) FOR i IN range(8)], '') AS digits FROM h)
SELECT page_id, url, payload_bytes,
  translate(digits, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM newest AND newest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM d"""
