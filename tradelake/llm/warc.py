"""WARC archives: writing records in segments, reading and reassembling them.

Writing: a page becomes a ``response`` record whose block is an HTTP message in
chunked transfer framing.  Blocks longer than ``segment_bytes`` are split over a
first record and ``continuation`` records.  Of pages with equal payloads of at
least ``min_revisit`` bytes only the one with the smallest id is a response, the
others are ``revisit`` records that refer to it.  Spark's text writer lays the
records down as files in the shared folder, no file longer than
``records_per_file`` segments.

Reading: files are parsed record by record (by Content-Length, never by looking
for a mark), continuation records are grouped by the identifier of the record
they continue, put in the order of their segment numbers and checked against
the total length; then the transfer framing is decoded and length and SHA-256
are taken from the bytes that come out.  A digest that differs from the
record's, a gap between segments or a wrong length raises an error.

Defined results: a null payload is empty; a null id takes part and is a revisit
of an equal payload with an id, if there is one; rows that repeat an id and its
payload share one record id, are restored as often as they were written and
are all responses (or all revisits); a null URL leaves out its field.
"""

from __future__ import annotations

import hashlib
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm.common import ship, stored

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = ("kind string, record_id string, origin_id string, segment int, total long, page_id string, "
          "digest string, refers string, block binary")


def record_id(page_id, digest: str) -> str:
    """The same for the same page and payload, so that a rerun writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None),
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def chunked(payload: bytes, size: int = 4096) -> bytes:
    """Payload in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """What chunked framing carries; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response message."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(x.lower().split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
    return dechunked(body) if fields.get(b"transfer-encoding", b"").strip() == b"chunked" else body


def page_records(page_id, url, payload: bytes, refers_to, segment_bytes: int, date: str):
    """The records of one page, one after the other."""
    digest = hashlib.sha256(payload).hexdigest()
    own = record_id(page_id, digest)
    uri = None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")
    common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("X-Page-ID", None if page_id is None else str(page_id)),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", PROFILE),
                      ("WARC-Refers-To", record_id(refers_to, digest)), http], head)
        return
    block = head + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, http], block)
        return
    cuts = range(0, len(block), segment_bytes)
    for n, at in enumerate(cuts, 1):
        part = block[at:at + segment_bytes]
        total = str(len(block)) if n == len(cuts) else None
        if n == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, ("WARC-Segment-Number", "1"), http]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(f"{page_id}/{n}", digest)),
                      ("WARC-Date", date), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(n)),
                      ("WARC-Segment-Total-Length", total)]
        yield record(fields, part)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = 32_768, min_revisit: int = 100,
                   records_per_file: int = 1024, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``."""
    ship(pages.sparkSession)
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("payload"),
                        F.sha2(html, 256).alias("digest"))
    # first ids of payloads that occur more than once; no other page needs a lookup
    firsts = (rows.where(F.length("payload") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    told = rows.join(stored(firsts, "warc-firsts"), "digest", "left").select(
        F.col("page_id"), "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                for r in page_records(page_id, url, payload, first, segment_bytes, date):
                    out.append(r)
                    held += len(r)
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    # a cast from binary keeps the bytes as they are, also those of a cut character
    (told.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path))


def parse(content: bytes):
    """(fields, block) of every record of one archive file."""
    at, view = 0, memoryview(content)
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower().decode(): v.strip().decode() for k, v in (x.split(b":", 1) for x in lines[1:])}
        start, size = end + 4, int(fields["content-length"])
        if content[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, bytes(view[start:start + size])
        at = start + size + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, one row each."""
    ship(spark)
    schema = [f.split()[0] for f in PARSED.split(", ")]
    types = [pa.string()] * 3 + [pa.int32(), pa.int64()] + [pa.string()] * 3 + [pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for f, block in parse(content.as_py()):
                    number, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
                    rows.append((f["warc-type"], f["warc-record-id"], f.get("warc-segment-origin-id"),
                                 number and int(number), total and int(total), f.get("x-page-id"),
                                 f.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                                 f.get("warc-refers-to"), block))
                    held += len(block)
                    if held > 16 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, PARSED)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole response blocks: record_id, page_id, digest, block, times.

    ``times`` is how often the record was written.  Grouping is by record, so a
    task holds the segments of one message at a time."""
    # the fields of a record stand on its first segment, the total on its last
    parts = (records.where(F.col("segment").isNotNull())
             .select(F.coalesce("origin_id", "record_id").alias("record_id"), "segment", "total", "page_id", "digest", "block")
             .groupBy("record_id", "segment")
             .agg(F.first("block").alias("block"), F.first("total", True).alias("total"),
                  F.first("page_id", True).alias("page_id"), F.first("digest", True).alias("digest"),
                  F.count(F.lit(1)).alias("times")))
    joined = (parts.groupBy("record_id")
              .agg(F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
                   F.max("total").alias("total"), F.max("page_id").alias("page_id"), F.max("digest").alias("digest"),
                   F.max(F.when(F.col("segment") == 1, F.col("times"))).alias("times")))
    block = F.expr("aggregate(parts, X'', (b, p) -> concat(b, p.block))")
    whole = joined.select("record_id", "page_id", "digest", "total", "parts", "times", F.explode(F.array(block)).alias("block"))
    in_order = F.transform("parts", lambda p: p.segment) == F.sequence(F.lit(1), F.size("parts"))
    good = F.coalesce(in_order & (F.octet_length("block") == F.col("total")), F.lit(False))
    whole = whole.select("record_id", "page_id", "digest", "block", "times",
                         F.assert_true(good, F.concat(F.lit("segments missing or too many in "), "record_id")).alias("fine"))
    alone = (records.where((F.col("kind") == "response") & F.col("segment").isNull())
             .select("record_id", "page_id", "digest", "block", F.lit(1).cast("long").alias("times")))
    return alone.unionByName(whole.where("fine is null").drop("fine"))


def decoded(blocks: DataFrame, with_payload: bool = False) -> DataFrame:
    """Response blocks -> record_id, page_id, payload_bytes, payload_digest (both
    of the decoded payload), times, and the payload itself if asked for."""
    names = ["record_id", "page_id", "payload_bytes", "payload_digest", "times"] + ["payload"] * with_payload

    def run(batches):
        for batch in batches:
            ids, _, digests, _, _ = batch.columns
            sizes, found, payloads = [], [], []
            for own, told, block in zip(ids.to_pylist(), digests.to_pylist(), batch.column(3)):
                payload = http_payload(block.as_py())
                found.append(hashlib.sha256(payload).hexdigest())
                sizes.append(len(payload))
                if with_payload:
                    payloads.append(payload)
                if told is not None and told != found[-1]:
                    raise ValueError(f"the payload of {own} does not have the digest of its record")
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(1), pa.array(sizes, pa.int64()), pa.array(found), batch.column(4)]
                + [pa.array(payloads, pa.binary())] * with_payload, names)

    spec = "record_id string, page_id string, payload_bytes long, payload_digest string, times long"
    return blocks.select("record_id", "page_id", "digest", "block", "times").mapInArrow(
        run, spec + ", payload binary" * with_payload)


def read_pages(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Every page of the archives: page_id, payload_bytes, payload_digest,
    record_type and refers_to; a revisit takes both from the response it names."""
    records = read_records(spark, path)
    responses = stored(decoded(reassemble(records)), "warc-responses")
    shown = responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                             F.lit(None).cast("string").alias("refers_to"),
                             F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("n")).drop("n")
    named = responses.select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"),
                             "payload_bytes", "payload_digest").dropDuplicates(["refers"])
    revisits = records.where(F.col("kind") == "revisit").select("page_id", "digest", "refers")
    found = revisits.join(stored(named, "warc-named"), "refers", "left")
    same = F.coalesce(F.col("digest") == F.col("payload_digest"), F.lit(False))
    found = found.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to",
                         F.assert_true(same, F.concat(F.lit("no response for "), "refers")).alias("fine"))
    return (shown.unionByName(found.where("fine is null").drop("fine"))
            .withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}))


def round_trip_sql(min_revisit: int = 100) -> str:
    """The same rows in DuckDB, straight from the pages."""
    return f"""
with payloads as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes,
                         sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (select *, case when payload_bytes >= {min_revisit}
                          then min(page_id) over (partition by payload_digest) end as first_id from payloads)
select page_id, payload_bytes, payload_digest,
       case when first_id is null or page_id is not distinct from first_id then 'response' else 'revisit' end as record_type,
       case when first_id is null or page_id is not distinct from first_id then null else first_id end as refers_to
from firsts"""
