"""WARC archives: written by Spark's text sink, read back through verified record boundaries.

A payload may itself contain what looks like the start of a record. Reading therefore takes no
magic for granted: every place with the magic that parses is a candidate with the offset of its
successor, as its own length field gives it. Following successors from the start of the file
reaches the true records and no others. The chain is not walked step by step: pointers are
doubled, so a file with n records takes log n rounds over arrays.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import scratch, stored, table

#: Records per archive, so that one fits well into a task's memory.
RECORDS_PER_FILE = 4000
#: A gzipped archive is unpacked in pieces of that size.
UNZIP_BYTES = 1 << 22
#: Payloads below this size are never revisits.
LEAST_REVISIT_BYTES = 0

#: Fixed values of the format.
MAGIC = rb"WARC/1\.[01]\r\n"
MAGIC_BYTES = 10
BLANK = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CANDIDATE = (
    "file string, length long, start long, next long, type string, record_id string, "
    "payload_bytes long, payload_digest string, sound boolean"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: each ten of the forty hexadecimal digits make eight."""
    digest = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One response record per row of ``pages`` (page_id, url, html), as gzipped archives.

    NULL html is an empty payload, a NULL page_id an empty id; line breaks in a URL become blanks.
    The text sink ends each row with a blank line, as the format ends each record.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]+", " ")
    header = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(payload.cast("binary")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"),
        F.lit(BLANK),
    )
    records = pages.select(F.concat(header, payload).alias("value"))
    records.write.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path, compression="gzip", lineSep=BLANK)


def fields(header: bytes) -> dict[str, str]:
    out = {}
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def candidates(data: bytes) -> Iterator[tuple]:
    """(start, next, type, record id, payload bytes, digest, sound) of all that may be a record."""
    end, head = len(data), -1
    for found in re.finditer(MAGIC, data):
        start = found.start()
        if head < start:
            head = data.find(BLANK.encode(), start)
        if head < 0:
            break
        values = fields(data[start:head])
        size = values.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            continue
        body = head + 4
        after = body + int(size)
        # a record ends with a blank line, and the next begins there
        if after + 4 > end or data[after : after + 4] != BLANK.encode():
            continue
        if after + 4 < end and not re.match(MAGIC, data[after + 4 : after + 4 + MAGIC_BYTES]):
            continue
        digest = base64.b32encode(hashlib.sha1(memoryview(data)[body:after]).digest()).decode()
        said = values.get("warc-payload-digest", "").partition(":")[2]
        yield (
            start, after + 4, values.get("warc-type"), values.get("warc-record-id"), int(size), digest,
            said in ("", digest),
        )


def reachable(start: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which of the records that begin at ``start`` (ascending) are reached from offset 0."""
    n = len(start)
    at = np.searchsorted(start, after)
    known = (at < n) & (start[np.minimum(at, n - 1)] == after)
    jump = np.append(np.where(known, at, n), n)
    reached = np.append(start == 0, False)
    while (jump[:-1] < n).any():
        reached[jump[reached]] = True
        jump = jump[jump]
    return reached[:n]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, type, record_id, payload_bytes, payload_digest, sound) of every record.

    Archives may be plain or gzipped, of version 1.0 or 1.1, and called anything that does not begin
    with ``_`` or ``.``, which Spark takes for hidden. A file whose chain does not end at its end is damaged: the
    read fails and names it. ``sound`` tells whether the payload has the digest in its header.
    A folder without archives gives no rows.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if data[:2] == b"\x1f\x8b":
                    data = unzipped(data)
                if not data:
                    continue
                rows = list(candidates(data)) or [(-1, -1, None, None, 0, None, False)]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), pa.array([len(data)] * len(rows), pa.int64()), *cols],
                    names=["file", "length", "start", "next", "type", "record_id", "payload_bytes", "payload_digest", "sound"],
                )

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start", ignore_index=True)
        kept = rows[reachable(rows["start"].to_numpy(), rows["next"].to_numpy())]
        if not len(kept) or kept["next"].iloc[-1] != kept["length"].iloc[0]:
            raise ValueError(f"the records of {rows['file'].iloc[0]} do not reach its end")
        return kept.drop(columns=["length", "next"])

    files = spark.read.format("binaryFile").load(path)
    found = files.select("path", "content").mapInArrow(emit, CANDIDATE)
    out = ", ".join(c for c in CANDIDATE.split(", ") if c.split()[0] not in ("length", "next"))
    return found.groupBy("file").applyInPandas(chain, out)


def unzipped(data: bytes) -> bytes:
    """All members of a gzip file, of which there may be one per record; a cut one as far as it goes."""
    out = []
    with gzip.GzipFile(fileobj=io.BytesIO(data)) as members:
        try:
            while piece := members.read1(UNZIP_BYTES):
                out.append(piece)
        except EOFError:
            pass  # the chain of records will not reach the end
    return b"".join(out)


def revisits(records: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to per record.

    Of records with equal payloads, that of the largest page_id is the response and the others
    revisit it. Payloads below ``least_bytes`` and records without an id are all responses;
    repeated rows of the largest id are all responses too.
    """
    page = F.regexp_extract("record_id", r"^<urn:page:(-?[0-9]+)>$", 1)
    rows = records.select(
        F.when(page != "", page).cast("long").alias("page_id"), "payload_bytes", "payload_digest"
    )
    rows = stored(rows, "records")
    same = ["payload_digest", "payload_bytes"]
    newest = stored(rows.groupBy(*same).agg(F.max("page_id").alias("newest")), "newest")
    again = (F.col("page_id") < F.col("newest")) & (F.col("payload_bytes") >= least_bytes)
    return rows.join(newest, same).select(
        "page_id", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("newest")).alias("refers_to"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return revisits(read_warc(spark, path))


#: The same from the pages themselves.
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, strlen(body)::BIGINT AS n, sha1(body) AS x FROM p),
d AS (
  SELECT page_id, n, array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
    ((('0x' || substr(x, 10 * (i // 8)::INTEGER + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER + 1, 1)), '')
    AS digest FROM h),
m AS (SELECT digest, n, max(page_id) AS newest FROM d GROUP BY digest, n)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN d.page_id < m.newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id < m.newest THEN m.newest END AS refers_to
FROM d JOIN m USING (digest, n)
"""
