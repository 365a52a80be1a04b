"""WARC archives written and read as a table of record chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import store, text_or_empty
from shelfline.session import scratch_path

HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record_id string, record_type string, refers_to string, chunk_no long, bytes_upto long, digest_upto string, last boolean, intact boolean, data binary"


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def record_chunks(pages: DataFrame, least: int = 1000, chunk_bytes: int = 1 << 16) -> DataFrame:
    """One row for each WARC record to write, ``content`` its bytes without the final line feed.

    A payload over ``chunk_bytes`` becomes a first record and continuation records, the segments of
    WARC 1.1, so no row and no reader holds more than one chunk beside the page itself. Of payloads of
    at least ``least`` bytes that are equal (SHA-256 and length) the largest page_id is written in
    full; the others become revisit records, which carry the digest and no payload.
    """
    rows = pages.select("page_id", "url", text_or_empty("html").cast("binary").alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("same"))
    repeated = (
        rows.filter(F.col("n") >= least).groupBy("same", "n").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("records"))
        .filter("records > 1").drop("records")
    )
    repeated = store(repeated, "repeated")  # so that the join can split the copies of a page that very many rows hold
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.coalesce("url", F.lit("urn:unknown")), r"[\x00-\x20\x7f]", "%20")
    own, first = record_id(F.col("page_id")), F.col("chunk_no") == 0
    parts = F.when(F.col("revisit"), F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n") / chunk_bytes))).cast("long")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).when(first, F.lit("response")).otherwise(F.lit("continuation"))),
        line("WARC-Record-ID", F.when(first, own).otherwise(F.concat(F.expr("substr(own, 1, length(own) - 1)"), F.lit(":"), F.col("chunk_no").cast("string"), F.lit(">")))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Target-URI", url),
        F.when(first, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload")))).otherwise(F.lit("")),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("response_id"))))).otherwise(F.lit("")),
        F.when(F.col("parts") > 1, line("WARC-Segment-Number", (F.col("chunk_no") + 1).cast("string"))).otherwise(F.lit("")),
        F.when(~first, line("WARC-Segment-Origin-ID", own)).otherwise(F.lit("")),
        F.when(~first & (F.col("chunk_no") + 1 == F.col("parts")), line("WARC-Segment-Total-Length", (F.col("n") + len(HTTP)).cast("string"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"))
    piece = F.expr(f"substring(payload, int(chunk_no * {chunk_bytes} + 1), {chunk_bytes})")
    block = F.concat(F.when(first, F.lit(HTTP)).otherwise(F.lit("")).cast("binary"), F.when(F.col("revisit"), F.lit(b"")).otherwise(piece))
    return (
        rows.join(repeated.hint("shuffle_hash"), ["same", "n"], "left")
        .withColumn("revisit", F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id")))
        .withColumn("parts", parts).withColumn("own", own)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("block", block)
        .select(F.concat(head.cast("binary"), F.col("block"), F.lit(b"\r\n\r")).cast("string").alias("content"))
    )


def write_archives(pages: DataFrame, path: str, **settings) -> None:
    """One gzip archive for each task, which a single task reads back in order."""
    record_chunks(pages, **settings).write.option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


class Parser:
    """Follows a stream of WARC bytes and gives chunk rows; holds at most one chunk and one header."""

    def __init__(self, chunk_bytes: int, payloads: bool):
        self.most, self.payloads = chunk_bytes, payloads
        self.rest, self.left, self.trailer = b"", None, 0
        self.record = None

    def feed(self, data: bytes) -> Iterator[tuple]:
        data, at = self.rest + data, 0
        while at < len(data):
            if self.trailer:
                step = min(self.trailer, len(data) - at)
                self.trailer, at = self.trailer - step, at + step
            elif self.left is None:
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                yield from self._open(data[at:end])
                at = end + 4
                if not self.left:
                    self.left, self.trailer = None, 4
            elif self.http:
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self.left -= end + 4 - at
                self.http, at = False, end + 4
                if not self.left:
                    self.left, self.trailer = None, 4
            else:
                step = min(self.left, len(data) - at, self.most - len(self.chunk))
                part = data[at:at + step]
                self.sha.update(part)
                self.total += step
                self.chunk += part
                self.left, at = self.left - step, at + step
                if not self.left:
                    self.left, self.trailer = None, 4
                if len(self.chunk) == self.most:
                    yield self._row(False)
        self.rest = data[at:]

    def _open(self, head: bytes) -> Iterator[tuple]:
        fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:])
        self.left = int(fields["Content-Length"])
        self.http = fields["WARC-Type"] != "continuation"
        if self.http:
            yield from self.close()
            self.record, self.type = fields["WARC-Record-ID"], fields["WARC-Type"]
            self.refers, self.digest = fields.get("WARC-Refers-To"), fields.get("WARC-Payload-Digest", "")
            self.sha, self.total, self.chunk, self.no = hashlib.sha1(), 0, b"", 0
        elif fields["WARC-Segment-Origin-ID"] != self.record:
            raise ValueError(f"segment of {fields['WARC-Segment-Origin-ID']} follows {self.record}")

    def _row(self, last: bool) -> tuple:
        done = self.sha.hexdigest() if self.type == "response" else self.digest.removeprefix("sha1:")
        intact = not last or self.digest == f"sha1:{done}"
        row = (self.record, self.type, self.refers, self.no, self.total, done, last, intact, bytes(self.chunk) if self.payloads else None)
        self.no, self.chunk = self.no + 1, b""
        return row

    def close(self) -> Iterator[tuple]:
        """The last chunk of the record that is open; empty when the payload is or when it ended with a full chunk."""
        if self.record is not None:
            yield self._row(True)
            self.record = None


def parse(chunk_bytes: int, payloads: bool):
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("chunk_no", pa.int64()), ("bytes_upto", pa.int64()),
                        ("digest_upto", pa.string()), ("last", pa.bool_()), ("intact", pa.bool_()), ("data", pa.binary())])

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(chunk_bytes, payloads)
        for batch in batches:
            rows = []
            for line in batch.column("value"):
                rows += parser.feed(line.as_py() + b"\n")
                if payloads and len(rows) * chunk_bytes > 32 << 20:
                    yield pack(rows)
                    rows = []
            yield pack(rows)
        yield pack(list(parser.close()))

    return run


def read_archives(spark: SparkSession, path: str, chunk_bytes: int = 1 << 16, payloads: bool = True) -> DataFrame:
    """The chunk rows of all archives below ``path``.

    Each row has the bytes and the SHA-1 of its record's payload up to and with this chunk; the row with
    ``last`` has those of the whole payload, and ``intact`` tells whether they agree with the header.
    A gzip file is read by one task in order, line by line; segments are joined again as they pass.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(parse(chunk_bytes, payloads), CHUNKS)


def archived_pages(pages: DataFrame, least: int = 1000, chunk_bytes: int = 1 << 16) -> DataFrame:
    """Write every page to WARC archives in the shared folder, read them back, one row for each page:
    page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Null html is an empty payload, null url becomes urn:unknown, and control characters and spaces of a
    url %20. Null page_ids rank below all others; rows that repeat the page_id of the response are
    responses too. A revisit takes its length from the response it refers to.
    An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path, least=least, chunk_bytes=chunk_bytes)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:([^>]*)>', 1) as bigint)")
    records = store(
        read_archives(spark, path, chunk_bytes, payloads=False).filter("last")
        .select(page("record_id").alias("page_id"), "record_type", page("refers_to").alias("refers_to"),
                F.col("bytes_upto").alias("own_bytes"), F.col("digest_upto").alias("payload_digest"), "intact"), "records")
    own = records.filter("record_type = 'response'").withColumn("payload_bytes", F.col("own_bytes"))
    again = records.filter("record_type = 'revisit'")
    wanted = again.select(F.col("refers_to").alias("full_id")).distinct()
    lengths = (
        own.join(wanted, F.col("page_id") == F.col("full_id"), "left_semi")
        .groupBy(F.col("page_id").alias("full_id")).agg(F.max("own_bytes").alias("payload_bytes"))
    )
    lengths = store(lengths, "lengths")  # as above, for a response with very many revisits
    again = again.join(lengths, F.col("refers_to") == F.col("full_id"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    return own.select(*cols).unionByName(again.select(*cols))


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT *, CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS response_id FROM p)
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN response_id IS DISTINCT FROM page_id AND response_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response_id IS DISTINCT FROM page_id THEN response_id END AS refers_to, TRUE AS intact
FROM r
"""
