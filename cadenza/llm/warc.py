"""WARC archives and revisit resolution.

``write_archive`` writes one WARC/1.1 record per row into gzip files of at most SEGMENT_BYTES of records
(or one longer record). ``read_archive`` parses them by Content-Length and hashes each payload again.
``resolve`` shuffles the headers by payload digest: of the records with equal payloads of at least MIN_BYTES
the one with the smallest page id (then record id) is the response, the others revisit it. Revisits are
joined to their responses, and a deduplicated archive with fresh headers is written; payloads are read
from the first archive and only meet the decisions about revisits.

All files go below a path that executors share, through Spark's own writers and readers. Groups of equal
payloads are aggregated map-side and joined by ``join_counted``, so a payload on a third of all pages loads
no single task. Defined cases: a null html is an empty payload; a null url or page id gets no header; control
characters and blanks in urls are percent-encoded, as are signs in page ids, which may be of any type that has a text form; null page ids sort last; repeated rows become records of their own, of
which one is the response; empty tables give empty archives; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import join_counted, maybe_broadcast
from cadenza.session import cut_lineage

MIN_BYTES = 100
SEGMENT_BYTES = 8 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, page_id string, url string, refers_to string, digest string, payload_bytes long, date string, payload string"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A response record per page, with a fresh record id."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return pages.select(
        F.concat(F.lit("urn:uuid:"), F.expr("uuid()")).alias("record_id"), F.lit("response").alias("record_type"),
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.lit(None).cast("string").alias("refers_to"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("payload_bytes"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), html.alias("payload"))


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def _record(r: dict) -> str:
    revisit = r["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n"
    body = "" if revisit else r["payload"]
    head = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {r['date']}"]
    if r["url"] is not None:
        head.append(f"WARC-Target-URI: {_clean(r['url'])}")
    if r["page_id"] is not None:
        head.append(f"X-Page-ID: {quote(str(r['page_id']))}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{r['refers_to']}>"]
    size = len(http) + (0 if revisit else r["payload_bytes"])
    head += [f"WARC-Payload-Digest: sha256:{r['digest']}", "Content-Type: application/http;msgtype=response", f"Content-Length: {size}"]
    return "\r\n".join(head) + "\r\n\r\n" + http + body + "\r\n\r\n"


def write_archive(rows: DataFrame, path: str) -> None:
    """Records (columns of RECORD) as ``path/*.gz``. Each task joins its records to segments of SEGMENT_BYTES; each segment is a file."""
    def segments(batches):
        part, size = [], 0
        for b in batches:
            for r in (r for i in range(0, b.num_rows, 64) for r in b.slice(i, 64).to_pylist()):
                part.append(_record(r))
                size += r["payload_bytes"] + 600
                if size >= SEGMENT_BYTES:
                    yield _segment(part)
                    part, size = [], 0
        if part:
            yield _segment(part)

    def _segment(part):
        return pa.RecordBatch.from_arrays([pa.array(["".join(part).removesuffix("\r\n")])], ["value"])  # the writer ends it

    (rows.mapInArrow(segments, "value string").write.option("maxRecordsPerFile", 1).option("lineSep", "\r\n")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def parse(data: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, headers, block) of each record; lengths decide, whatever the blocks hold."""
    at = 0
    while at < len(data):
        if data[at:at + 2] == b"\r\n":
            at += 2
            continue
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield at, head, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_archive(spark, path: str, payloads: bool = True, id_type: str = "long") -> DataFrame:
    """The records below ``path`` (columns of RECORD, page ids of the given type; payload null if ``payloads`` is off). Payload digests are computed again
    from the payloads; a response that doesn't match its header is an error."""
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches):
        for b in batches:
            for data in b.column(0):
                raw = zlib.decompress(data.as_py(), 47) if len(data.as_py()) else b""
                rows, size = [], 0
                for _, head, block in parse(raw):
                    cut = block.index(b"\r\n\r\n") + 4
                    declared = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind, body = head["WARC-Type"], block[cut:]
                    if kind == "response" and hashlib.sha256(body).hexdigest() != declared:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
                    page = head.get("X-Page-ID")
                    refers = head.get("WARC-Refers-To")
                    rows.append((head["WARC-Record-ID"][1:-1], kind, None if page is None else unquote(page), head.get("WARC-Target-URI"),
                                 refers and refers[1:-1], declared, len(body) if kind == "response" else None, head.get("WARC-Date"),
                                 body.decode() if payloads and kind == "response" else None))
                    size += len(body)
                    if size >= SEGMENT_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        kinds = [pa.int64() if n == "payload_bytes" else pa.string() for n in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD).withColumn("page_id", F.col("page_id").cast(id_type))


def with_originals(headers: DataFrame) -> DataFrame:
    """Revisit records joined to the responses that they refer to: each record's full payload size, and ``original``, the
    page id of the response (null for responses)."""
    revisits = headers.filter("record_type = 'revisit'")
    wanted = revisits.groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    origin = headers.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original"), F.col("payload_bytes").alias("full"))
    origin = cut_lineage(wanted.join(origin, "refers_to"))
    found = join_counted(revisits, origin, ["refers_to"], "n").select(*[c for c in headers.columns if c != "payload_bytes"], F.col("full").alias("payload_bytes"), "original")
    rest = headers.filter("record_type <> 'revisit'").withColumn("original", F.lit(None).cast(headers.schema["page_id"].dataType))
    return rest.unionByName(found)


def decide(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(record_id, refers_to) of the records that are or become revisits of another record; one with a payload is preferred as original."""
    h = headers.filter(F.col("payload_bytes") >= min_bytes).select("record_id", "record_type", "page_id", "digest", "payload_bytes")
    first = F.min(F.struct(F.col("record_type") != "response", F.col("page_id").isNull(), F.col("page_id"), F.col("record_id")))
    groups = h.groupBy("digest", "payload_bytes").agg(first["record_id"].alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return join_counted(h, cut_lineage(groups), ["digest", "payload_bytes"], "n").filter("record_id <> refers_to").select("record_id", "refers_to")


def resolve(spark, raw: str, deduplicated: str, min_bytes: int = MIN_BYTES, id_type: str = "long") -> None:
    """Writes the archive at ``raw``, which may hold revisits already, again, with equal payloads stored once."""
    headers = cut_lineage(with_originals(cut_lineage(read_archive(spark, raw, False, id_type).drop("payload"))))
    again = decide(headers, min_bytes).withColumnRenamed("refers_to", "first")
    # what rows of the archive don't say: the originals of new revisits, the payload sizes of old ones
    known = headers.select("record_id", "record_type", F.col("payload_bytes").alias("full")).join(again, "record_id", "left")
    known = cut_lineage(known.filter("first IS NOT NULL OR record_type = 'revisit'").select("record_id", "first", "full"))
    rows = read_archive(spark, raw, True, id_type)
    j = rows.join(maybe_broadcast(known), "record_id", "left").withColumns({"refers_to": F.coalesce("first", "refers_to"), "payload_bytes": F.coalesce("full", "payload_bytes")})
    j = j.withColumns({"record_type": F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"),
                       "payload": F.when(F.col("refers_to").isNull(), F.col("payload"))})
    write_archive(j.select(*rows.columns), deduplicated)


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``path/raw`` and ``path/deduplicated`` and returns the records read back from the latter: record_id, record_type,
    page_id, url, refers_to, digest, payload_bytes, date, original."""
    spark, id_type = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    write_archive(records(pages, id_col, url_col, html_col), f"{path}/raw")
    resolve(spark, f"{path}/raw", f"{path}/deduplicated", id_type=id_type)
    return with_originals(cut_lineage(read_archive(spark, f"{path}/deduplicated", False, id_type).drop("payload")))
