"""WARC archives written and read as tables of record-and-chunk rows.

Writing: each page becomes one WARC/1.1 record, or, when its payload is longer
than ``chunk_bytes``, a first segment and ``continuation`` segments (the
standard's own way to split a record). A segment is a row with a record
identifier and a segment number; Spark's text writer puts the rows one after the
other into gzip files. Chunks are cut out of the batch's own buffer: no row, and no
copy, holds more than one of them, and the SHA-1 of the payload is carried along
from chunk to chunk.

Reading: gzip files are not split, so a partition is a run of whole files, read
as lines in order. The parser goes by Content-Length, updates the digest as
chunks pass, checks it against the record's own, and gives a row for each chunk
(``read_chunks``); it never joins the chunks of a payload. A record's row is that
of its last chunk (``read_warc``).

Defined cases: a null html is the empty payload; a null page_id is written and
read back as null; of equal payloads whose greatest page_id occurs twice both
rows are responses; a row with a null page_id revisits a response that has one; if
all page_ids of a payload are null, all are responses. Line ends in URLs are
escaped. Bytes of html that are no UTF-8 are written, digested and read back as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Ways that the rows of one payload are dealt for the join with the response that stands for it.
SALTS = 16
CHUNKS = "record long, chunk_no int, page_id long, record_type string, refers_to long, n_bytes long, total_bytes long, running_digest string, digest_ok boolean, last boolean, chunk binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def decide(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """(page_id, url, html, digest, kept): ``kept`` is the page_id of the response that stands for this payload.

    Only digests that occur more than once are looked up, aggregated first. Rows of one payload are
    dealt out in SALTS ways, and those of small payloads, which are never looked up, by themselves.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.cast("binary").alias("html"), F.sha1(html).alias("digest"), (F.octet_length(html) >= min_bytes).alias("large"))
    top = rows.filter("large").groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    top = top.select(F.col("digest").alias("key"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), "kept")
    own = F.xxhash64("page_id", "url")
    keyed = rows.withColumns({"key": F.when(F.col("large"), F.col("digest")), "salt": F.when(F.col("large"), F.pmod(own, F.lit(SALTS))).otherwise(own)})
    return keyed.join(top, ["key", "salt"], "left").select("page_id", "url", "html", "digest", F.coalesce("kept", "page_id").alias("kept"))


def cut(payload: memoryview, size: int) -> Iterator[memoryview]:
    """Chunks of at most ``size`` bytes (4 at least) that end between code points; where bytes are no UTF-8, anywhere."""
    at = 0
    while at < len(payload):
        end = whole = min(at + max(size, 4), len(payload))
        while end < len(payload) and payload[end] & 0xC0 == 0x80 and whole - end < 4:
            end -= 1
        end = end if end == len(payload) or payload[end] & 0xC0 != 0x80 else whole
        yield payload[at:end]
        at = end


def record_rows(page_id: int | None, url: str | None, data: memoryview, digest: str, kept: int | None, chunk_bytes: int) -> Iterator[str]:
    """The segments of one record as text, in which bytes that are no UTF-8 are surrogate escapes."""
    name = f"<urn:page:{'' if page_id is None else page_id}>"
    common = [f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if kept != page_id:
        head = ["WARC/1.1", "WARC-Type: revisit", f"WARC-Record-ID: {name}", *common, f"WARC-Refers-To: <urn:page:{kept}>", f"WARC-Profile: {PROFILE}", f"Payload-Length: {len(data)}", "Content-Length: 0"]
        yield CRLF.join(head) + CRLF + CRLF
        return
    running, chunks = hashlib.sha1(), list(cut(data, chunk_bytes)) or [data]
    for k, chunk in enumerate(chunks, 1):
        running.update(chunk)
        kind = "response" if k == 1 else "continuation"
        own = name if k == 1 else f"<urn:page:{'' if page_id is None else page_id}:{k}>"
        head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *common]
        if len(chunks) > 1:
            head += [f"WARC-Segment-Number: {k}", f"Running-Digest: sha1:{running.hexdigest()}"]
            head += [f"WARC-Segment-Origin-ID: {name}"] * (k > 1) + [f"WARC-Segment-Total-Length: {len(data)}"] * (k == len(chunks))
        head += [f"WARC-Segments: {len(chunks)}", f"Content-Length: {len(chunk)}"]
        yield CRLF.join(head) + CRLF + CRLF + str(chunk, "utf-8", "surrogateescape")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 1000, chunk_bytes: int = 1 << 16) -> None:
    """Write the pages as gzip WARC files into the folder ``path``; payloads of ``min_bytes`` or more are kept once."""

    def rows_of(texts: list[str]) -> pa.RecordBatch:
        # as bytes that are called a string: Spark writes them as they are
        return pa.RecordBatch.from_arrays([pa.array([t.encode("utf-8", "surrogateescape") for t in texts], pa.binary()).view(pa.string())], ["value"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            size = 0
            ids, digests, kept = (batch.column(k).to_pylist() for k in (0, 3, 4))
            urls = [None if u is None else u.decode("utf-8", "surrogateescape") for u in batch.column(1).view(pa.binary()).to_pylist()]
            for k in range(len(batch)):
                payload = memoryview(batch.column(2)[k].as_buffer())
                for text in record_rows(ids[k], urls[k], payload, digests[k], kept[k], chunk_bytes):
                    out.append(text)
                    size += len(text)
                    if size > 8 << 20:
                        yield rows_of(out)
                        out, size = [], 0
            if out:
                yield rows_of(out)

    rows = decide(pages, id_col, url_col, html_col, min_bytes)
    rows.mapInArrow(segments, "value string").write.option("compression", "gzip").option("lineSep", CRLF * 2).text(path)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        yield from batch.column(0).to_pylist()


def parse(lines: Iterator[bytes], first: int = 0, payloads: bool = True) -> Iterator[tuple]:
    """Rows of CHUNKS from the lines of whole files, in order; lines lack their final newline.

    ``first``: number of the first record. Without ``payloads`` the chunks themselves are null.
    """
    digest, total, parts, good, record = None, 0, 0, True, first - 1
    now: dict[bytes, bytes] = {}
    for line in lines:
        if line != b"WARC/1.1\r":
            if line not in (b"\r", b""):
                raise ValueError(f"not the start of a record: {line[:60]!r}")
            continue
        head: dict[bytes, bytes] = {}
        for line in lines:
            if line == b"\r":
                break
            key, _, value = line.rstrip(b"\r").partition(b": ")
            head[key] = value
        left = int(head[b"Content-Length"])
        if head[b"WARC-Type"] != b"continuation":
            digest, total, parts, good, record = hashlib.sha1(), 0, 0, True, record + 1
            now = head
        size, taken = left, []
        while left > 0:
            line = next(lines)
            # a payload may end in the middle of a line: CR LF CR LF follows it
            take = line[:left] if len(line) >= left else line + b"\n"
            digest.update(take)
            left -= len(take)
            if payloads:
                taken.append(take)
        total, parts = total + size, parts + 1
        if b"Running-Digest" in head:
            good = good and head[b"Running-Digest"] == b"sha1:" + digest.hexdigest().encode()
        page = now[b"WARC-Record-ID"][len(b"<urn:page:") : -1]
        page_id, said = int(page) if page else None, now[b"WARC-Payload-Digest"].partition(b":")[2].decode()
        if now[b"WARC-Type"] == b"revisit":
            yield record, 0, page_id, "revisit", int(now[b"WARC-Refers-To"][len(b"<urn:page:") : -1]), 0, int(now[b"Payload-Length"]), said, True, True, None
        else:
            last = parts == int(now[b"WARC-Segments"])
            good = good and (not last or digest.hexdigest() == said)
            yield record, parts, page_id, "response", None, size, total, digest.hexdigest(), good, last, b"".join(taken) if payloads else None


def read_chunks(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The archives in ``path`` as a table of chunks (CHUNKS).

    ``record`` numbers the records of a task; ``running_digest`` and ``total_bytes`` are of the
    payload up to and with this chunk; a revisit is one row without a chunk.
    """
    fields = [x.split() for x in CHUNKS.split(", ")]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)], [n for n, _ in fields])

        for row in parse(_lines(batches), TaskContext.get().partitionId() << 33, payloads):
            out.append(row)
            held += len(row[-1] or b"")
            if len(out) == 10_000 or held > 8 << 20:
                yield flush()
                out, held = [], 0
        if out:
            yield flush()

    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").cast("binary").alias("line")).mapInArrow(chunks, CHUNKS)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives in ``path``, payloads digested anew while they stream by."""
    last = read_chunks(spark, path, payloads=False).filter("last")
    return last.select("page_id", F.col("total_bytes").alias("payload_bytes"), F.col("running_digest").alias("payload_digest"), "record_type", "refers_to", F.col("chunk_no").alias("n_chunks"), "digest_ok")


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS kept FROM q WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept IS NULL OR kept IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept IS NOT DISTINCT FROM page_id THEN NULL ELSE kept END AS refers_to,
  true AS digest_ok
FROM q LEFT JOIN m USING (payload_digest)"""
