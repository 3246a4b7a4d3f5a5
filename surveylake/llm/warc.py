"""WARC archives: one gzip member per record, written by tasks and read back by byte ranges."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveylake.llm.common import table, written
from surveylake.llm.exact_dedup import grouped
from surveylake.session import scratch_path
from surveylake.sources.files import open_for_writing, open_in_place

#: Payloads below this are never stored as revisits.
LEAST_REVISIT = 100
FILE_BYTES = 1 << 30
RANGE_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
_STEP = 1 << 16
_DATE = "1970-01-01T00:00:00Z"  # equal input gives equal archives


def revisits(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """`page_id`, `digest`, `refers_to` of the pages whose payload an earlier page has, each once.

    Of equal payloads of at least `least` bytes the page with the smallest key is the response, and so are repeated
    rows of that key. A null key comes last. The payloads are read once, to a table of digests.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    facts = pages.where(F.octet_length(payload) >= least).select(
        F.col(key).alias("page_id"), F.sha2(payload, 256).alias("digest"), F.monotonically_increasing_id().alias("row")
    )
    found = grouped(written(facts.withColumn("no_key", F.col("page_id").isNull()), "payloads"), "digest", ["no_key", "page_id", "row"])
    others = found.where(~F.col("page_id").eqNullSafe(F.col("first.page_id")))
    return others.select("page_id", "digest", F.col("first.page_id").alias("refers_to")).distinct()


def record(key, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP header only, with the length of the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(32, 127))))}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    block = http + (payload if refers_to is None else b"")
    head.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_warc(
    pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes a record per row below `root`; returns the written table of files: `path`, `bytes`, `records`.

    A task writes files of its own under names that no other attempt uses, and its list counts only once it is
    done: files of attempts that failed are in no list, so they are never read. Null payloads are empty. `root` has
    to be on storage that tasks can open themselves.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    known = revisits(pages, key, html).toDF("_page", "_digest", "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.sha2("payload", 256) == F.col("_digest"))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.join(written(known, "revisits"), same, "left").select("page_id", "url", F.col("payload").cast("binary").alias("payload"), "refers_to")

    def write(batches):
        name = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, path, size, count, number = None, "", 0, 0, 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    path, size, count = f"{name}-{number}.warc.gz", 0, 0
                    out, number = open_for_writing(path), number + 1
                data = record(*row)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    return written(rows.mapInArrow(write, "path string, bytes bigint, records bigint"), "warc-files")


def member(data: bytearray, at: int, more) -> tuple[bytes, int] | None:
    """The content and the length of the gzip member at a place, None if it is not that of a WARC record.

    A place that looks like a member is decoded a little first and given up unless a WARC header comes out. `more`
    adds to the data what follows it in the file and says whether there was any.
    """
    try:
        unpack, content, fed = zlib.decompressobj(31), bytearray(), at
        while not unpack.eof:
            if fed >= len(data) and not more():
                return None
            part = data[fed : fed + _STEP]
            content += unpack.decompress(part)
            fed += len(part)
            if not b"WARC/".startswith(bytes(content[:5])):
                return None
    except zlib.error:
        return None
    return (bytes(content), fed - len(unpack.unused_data) - at) if content.startswith(b"WARC/") else None


def parsed(content: bytes) -> dict | None:
    """Header fields by lower-case name, and the block; None if the content is not one whole record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", errors="replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    size = fields.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size) or rest[int(size) :].strip():
        return None
    return fields | {"block": rest[: int(size)]}


def records_between(path: str, start: int, end: int):
    """The records whose member begins in the range, with where each begins and ends."""
    with open_in_place(path) as file:
        file.seek(start)
        buffer = bytearray(file.read(end - start + len(MAGIC) - 1))

        def more() -> bool:
            got = file.read(16 * _STEP)
            buffer.extend(got)
            return bool(got)

        at = buffer.find(MAGIC)
        while 0 <= at < end - start:
            found = member(buffer, at, more)
            fields = parsed(found[0]) if found else None
            if fields is None:
                at = buffer.find(MAGIC, at + 1)
                continue
            yield start + at, start + at + found[1], fields
            at = buffer.find(MAGIC, at + found[1])


READ = "path string, start bigint, begins bigint, ends bigint, type string, record string, refers string, url string, digest string, payload_bytes bigint, payload binary"


def scan_warc(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the files (`path`, `bytes`), by tasks that each scan byte ranges and own what begins there.

    `start` is that of the range. What a range holds never overlaps, as a task goes on behind each record it finds.
    `payload` is null in a revisit, whose `payload_bytes` and `digest` are those that its headers state; in a
    response both are those of the payload read.
    """
    spread = files.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0, bytes - 1, {range_bytes})")).alias("start"))
    tasks = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.lit(1))).first()[0]
    # Ranges are dealt out evenly; where there are very many, a task takes several.
    spread = spread.select("path", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end")).repartition(min(max(1, int(tasks)), 50_000))

    def read(batches):
        for batch in batches:
            for path, start, end in zip(*(column.to_pylist() for column in batch.columns)):
                for begins, ends, fields in records_between(path, start, end):
                    http, _, payload = fields["block"].partition(b"\r\n\r\n")
                    kind = fields.get("warc-type", "")
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    if kind == "revisit":
                        stated = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:] if b": " in line)
                        size, digest = int(stated.get(b"Content-Length", -1)), fields.get("warc-payload-digest", "").removeprefix("sha256:")
                    row = [path, start, begins, ends, kind, fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri")]
                    columns = [*row, digest, size, payload if kind != "revisit" else None]
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, _TYPES)], _NAMES)

    return spread.mapInArrow(read, READ)


_NAMES = [field.split()[0] for field in READ.split(", ")]
_TYPES = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[field.split()[1]] for field in READ.split(", ")]


def outermost(records: DataFrame) -> DataFrame:
    """Without records that begin inside another of their file.

    A payload may itself hold archives, and a range may begin inside it, so that its records are found as well. Within
    a range records do not overlap, so a row for each range tells how far the ranges before it reach; only ranges
    whose first record begins before that are joined back. The records are read twice: give a written table unless
    it is cheaper to scan the files again than to keep them.
    """
    ranges = records.groupBy("path", "start").agg(F.min("begins").alias("_first"), F.max("ends").alias("_last"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = ranges.withColumn("_reach", F.max("_last").over(before)).where("_first < _reach").select("path", "start", "_reach")
    found = records.join(written(reached, "overlapping-ranges"), ["path", "start"], "left")
    return found.where("_reach is null or begins >= _reach").select(records.columns)


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the files, each once, with their payloads, which move only where many ranges overlap.

    Every file is scanned twice, first for the places of its records.
    """
    return outermost(scan_warc(files, range_bytes))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    files = write_warc(pages, scratch_path(spark, "warc"))
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) as {pages.schema['page_id'].dataType.simpleString()})")
    found = scan_warc(files).select(
        "path", "start", "begins", "ends", page("record").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), page("refers").alias("refers_to"),
    )
    return outermost(written(found, "warc-records")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = f"""
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN strlen(p) < {LEAST_REVISIT} OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN strlen(p) < {LEAST_REVISIT} OR page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY d) AS first
      FROM (SELECT page_id, coalesce(html, '') AS p, sha256(coalesce(html, '')) AS d FROM pages))"""
