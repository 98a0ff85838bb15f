"""WARC archives with revisit resolution.

Headers (not payloads) are grouped by payload digest; of equal payloads the smallest page
id stays a response and the others become revisits of it. Records are put together in SQL
functions and written by Spark's text sink, so archives can lie in any store that Spark
writes to: gzip files whose records end in a blank line each, as the format asks.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm.lineage import cut, shared_folder

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Payload bytes from which a record may be a revisit.
MIN_BYTES = 0
EOL = "\r\n"
RECORD = "record_id string, page_id long, url string, record_type string, refers_to_id string, payload_digest string, payload_bytes long, payload binary"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: four digits of 5 bits for each five hex digits."""
    digest = F.sha1(payload)
    digits = F.concat(*[F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page: Column, url: Column) -> Column:
    """A UUID that is the same however often a task is run again."""
    h = F.md5(F.concat_ws("\t", F.coalesce(page.cast("string"), F.lit("-")), url))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def with_types(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload`` and ``digest, n_bytes, record_type`` and what a revisit refers to."""
    rows = pages.withColumn("digest", base32_sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    heads = rows.where(F.col("n_bytes") >= min_bytes).select("digest", F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url").alias("head"))
    first = heads.groupBy("digest").agg(F.min("head").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    # written, so that the join below can split a digest that many pages have
    rows = rows.join(cut(first), "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Writes a record for each row: HTTP response records, and revisits without payload.

    Null payloads are empty ones, null urls empty strings; a row without an id can only be
    the response if all rows of its payload have none. Rows that repeat an id and its
    payload are all written as what that page is. Other columns are not looked at.
    """
    url = F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\x00-\x20]", "%20")
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = with_types(plain, min_bytes)
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(EOL + EOL))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    head = F.concat_ws(
        EOL,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("url"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),  # absent for a null id
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{EOL}WARC-Refers-To: "), record_id(F.col("first.page_id"), F.col("first.url")), F.lit(f"{EOL}WARC-Refers-To-Target-URI: "), F.col("first.url"), F.lit(f"{EOL}WARC-Refers-To-Date: {date}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    rows.select(F.concat(head, F.lit(EOL + EOL), block)).write.mode("overwrite").option("lineSep", EOL + EOL).option("compression", "gzip").text(folder)


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzip archive, by its lengths, a part at a time."""
    unpack, buffer, at = zlib.decompressobj(31), bytearray(), 0

    def more() -> bool:
        nonlocal unpack, at
        while at < len(content) or unpack.unconsumed_tail:
            tail = unpack.unconsumed_tail
            part = tail or content[at : at + (1 << 20)]
            at += 0 if tail else len(part)
            buffer.extend(unpack.decompress(part, 1 << 22))
            if unpack.eof:  # the next member
                at -= len(unpack.unused_data)
                unpack = zlib.decompressobj(31)
            if buffer:
                return True
        return False

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            size = len(buffer)
            if not more() or len(buffer) == size:
                if buffer.strip():
                    raise ValueError("the archive ends within a record")
                return
        first, *fields = bytes(buffer[:end]).decode().split(EOL)
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        head = {k.lower(): v.strip() for k, v in (f.split(":", 1) for f in fields)}
        stop = end + 4 + int(head["content-length"])
        while len(buffer) < stop + 4:
            size = len(buffer)
            more()
            if len(buffer) == size:
                raise ValueError("the archive ends within a record")
        yield head, bytes(buffer[end + 4 : stop])
        del buffer[: stop + 4]


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each record, its payload digest checked against the payload. Revisits have
    neither payload nor its size before ``resolve``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (f.split(" ") for f in RECORD.split(", "))])
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                for head, block in records(content.as_py()):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    revisit = head["warc-type"] == "revisit"
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if not revisit and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                        raise ValueError(f"payload digest of {head['warc-record-id']} does not hold")
                    page = head.get("x-page-id")
                    uuid.UUID(head["warc-record-id"][10:-1])
                    out.append((head["warc-record-id"], int(page) if page else None, head["warc-target-uri"], head["warc-type"], head.get("warc-refers-to"), digest, None if revisit else len(payload), payload if payloads and not revisit else None))
                    size += len(payload)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content").mapInArrow(run, RECORD)


def resolve(found: DataFrame) -> DataFrame:
    """Records with ``refers_to`` (the page id of the original) and, for revisits, its size and payload."""
    originals = found.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.struct(F.col("page_id").alias("refers_to"), "payload_bytes", "payload").alias("o")).dropDuplicates(["refers_to_id"])
    rows = found.join(originals, "refers_to_id", "left")
    return rows.select("record_id", "page_id", "url", "record_type", F.col("o.refers_to"), "payload_digest", *[F.coalesce(F.col(c), F.col(f"o.{c}")).alias(c) for c in ("payload_bytes", "payload")])


def op8_warc(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    found = resolve(read_warc(spark, folder, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p),
d AS (
  SELECT page_id, list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    CAST((CAST(('0x' || substr(h, 5 * CAST(k // 4 AS INT) + 1, 5)) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31 AS INT), 1)), 'string_agg', '') AS payload_digest FROM p
)
SELECT f.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN f.page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f JOIN d USING (page_id)
"""
