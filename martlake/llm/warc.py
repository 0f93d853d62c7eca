"""WARC writing, reading and revisit resolution (operator 6).

Archives are written by Spark's text writer: a record is header lines, an empty
line and the payload, and the two line ends that close a WARC record are the
writer's line separator.  Files are bounded by bytes: records are written by
classes of size, each with as many records a file as fit into ``FILE_BYTES``
(one, if the record is larger).  A file is read as one value, inflated piece by
piece and cut by ``Content-Length``, so a reading task holds a compressed file
and one record, and a payload may hold any text.

Every record has an id of its own (a UUID), the date of its writing and the
row's page_id in a header of its own, ``X-Page-ID``; an archive begins with a
``warcinfo`` record.

Resolution: payload digests are computed where the payload is; only the narrow
headers are shuffled, to the record of the smallest page_id of each digest,
pre-aggregated before the shuffle; revisit records join their original by
digest; then payloads join their decision by record id, which has no hot key.
The deduplicated archive gets fresh headers: new record ids and dates, and in a
revisit the new id, the date and the target of its original.

Edge cases: a null payload is empty; a null url gives no target header; a null
page_id is a revisit if its payload has an original with an id, else a
response; all rows that share the smallest page_id of a payload are responses;
payloads under ``min_bytes`` are always responses.  Line ends in a url are
percent-encoded in its header.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import stage, table
from martlake.session import checkpoint_dir

END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FILE_BYTES = 1 << 30        # bytes of a file's payloads before compression, at most (more only for one larger record)
SMALL, STEP = 256 << 10, 16 # classes of size: up to 256 KB, then 16 times as much each
PIECE = 1 << 20             # bytes inflated at a time
HEADERS = ("page_id long, record_type string, payload_digest string, payload_bytes long, "
           "refers_to long, target_uri string, record_id string, date string")


def base32_sha1(payload) -> F.Column:
    """Bare upper-case base32 of the SHA-1 of a binary column.

    The 40 hex digits are 8 groups of 20 bits, and each group is 4 symbols.
    """
    digest = F.sha1(payload)
    group = [F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int") for i in range(8)]
    symbol = [F.substr(F.lit(BASE32), F.shiftright(g, s).bitwiseAND(31) + 1, F.lit(1))
              for g in group for s in (15, 10, 5, 0)]
    return F.concat(*symbol)


def header(name: str, value) -> F.Column:
    """A header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def now() -> str:
    """The date of an archive's records."""
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def urn(hex_digits) -> F.Column:
    """A record id from 32 hex digits."""
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hex_digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
                    F.lit(">"))


def record_text(kind, page_id, url, digest, payload, full_bytes, record_id, date: str, original=None) -> F.Column:
    """One WARC record, without the two line ends that close it.  ``original``: (page_id, record id, target)
    of the record that a revisit refers to, of the same archive."""
    uri = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                     F.lit("Content-Length: "), full_bytes.cast("string"), F.lit(END), payload)
    refers = []
    if original:
        page, name, target, when = (F.when(kind == "revisit", x) for x in (*original, F.lit(date)))
        refers = [header("WARC-Refers-To", name), header("WARC-Refers-To-Target-URI", target),
                  header("WARC-Refers-To-Date", when), header("X-Refers-To-Page-ID", page.cast("string")),
                  header("WARC-Profile", F.when(kind == "revisit", F.lit(
                      "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))]
    return F.concat(
        F.lit("WARC/1.1\r\n"), header("WARC-Type", kind), header("WARC-Record-ID", record_id), header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", uri), header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        header("X-Page-ID", page_id.cast("string")), *refers,
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def info_record(spark: SparkSession, about: str) -> DataFrame:
    """The ``warcinfo`` record of an archive."""
    body = f"software: martlake\r\nformat: WARC File Format 1.1\r\ndescription: {about}\r\n"
    text = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\n"), header("WARC-Record-ID", urn(F.lit(uuid.uuid4().hex))),
                    header("WARC-Date", F.lit(now())), F.lit("Content-Type: application/warc-fields\r\n"),
                    F.lit(f"Content-Length: {len(body)}{END}{body}"))
    return spark.range(1).select(text.alias("value"))


def size_class(size) -> F.Column:
    """0 up to SMALL bytes, then one more for each STEP times as many."""
    return F.when(size <= SMALL, 0).otherwise(F.ceil(F.log(size / SMALL) / F.log(F.lit(float(STEP))))).cast("int")


def write_archive(records: DataFrame, sizes: DataFrame, about: str) -> str:
    """Write records (value, size: bytes of the payload in it) as gzip archives in the shared folder; returns
    the folder.  ``sizes`` holds the same sizes and tells which classes there are."""
    spark = records.sparkSession
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    found = sizes.select(size_class(F.col("size")).alias("c")).groupBy("c").count().collect()     # a few classes
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    parts = [(info_record(spark, about), 1)] + [
        (records.where(size_class(F.col("size")) == r["c"]) if len(found) > 1 else records,
         max(1, FILE_BYTES // (SMALL * STEP ** r["c"]))) for r in found]
    for part, per_file in parts:
        part.select("value").write.mode("append").option("lineSep", END).option("compression", "gzip") \
            .option("maxRecordsPerFile", per_file).text(path)
    return path


def inflated(data: bytes):
    """Pieces of an inflated gzip file of one member or several."""
    while data:
        d = zlib.decompressobj(31)
        for at in range(0, len(data), PIECE):
            yield d.decompress(data[at:at + PIECE])
            if d.eof:
                data = d.unused_data + data[at + PIECE:]
                break
        else:
            yield d.flush()
            return


def parse_archive(pieces):
    """Yields (headers dict, block bytes) of one archive from its inflated pieces, cut by Content-Length."""
    held, at, pieces = b"", 0, iter(pieces)

    def more(need: str | None) -> bool:
        nonlocal held, at
        piece = next(pieces, None)
        if piece is None and need:
            raise ValueError(f"an archive ends within {need}")
        held, at = held[at:] + (piece or b""), 0
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more("a record's headers" if at < len(held) else None):
                return
        headers = dict(x.split(": ", 1) for x in held[at:end].decode("utf-8").split("\r\n")[1:])
        size = int(headers["Content-Length"])
        at = end + 4
        if len(held) - at < size + 4:
            parts, have = [held[at:]], len(held) - at
            while have < size + 4:
                piece = next(pieces, None)
                if piece is None:
                    raise ValueError("an archive ends within a record")
                parts.append(piece)
                have += len(piece)
            held, at = b"".join(parts), 0
        yield headers, held[at:at + size]
        at += size + 4


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Response and revisit records of an archive folder: HEADERS and, if asked, the payload text."""
    schema = HEADERS + (", payload string" if payloads else "")
    whole = lambda x: int(x) if x is not None else None

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for h, block in parse_archive(inflated(content.as_py())):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    head, _, body = block.partition(b"\r\n\r\n")
                    full = int(head.rpartition(b"Content-Length: ")[2])
                    rows.append((whole(h.get("X-Page-ID")), h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:"),
                                 full, whole(h.get("X-Refers-To-Page-ID")), h.get("WARC-Target-URI"),
                                 h["WARC-Record-ID"], h["WARC-Date"], body))
                    held += len(body) * payloads
                    if len(rows) == 500 or held > PIECE:
                        yield columns(rows)
                        rows, held = [], 0
                if rows:
                    yield columns(rows)

    def columns(rows):
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3]
        data = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        names = [f.split(" ")[0] for f in HEADERS.split(", ")]
        if payloads:
            data.append(pa.array([r[8] for r in rows], pa.binary()).cast(pa.string()))
            names.append("payload")
        return pa.RecordBatch.from_arrays(data, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(read, schema)


def page_records(pages: DataFrame) -> DataFrame:
    """A response record (value, size) for each row of ``pages`` (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(record_text(
        F.lit("response"), F.col("page_id"), F.col("url"), base32_sha1(payload.cast("binary")), payload,
        F.octet_length(payload), urn(F.regexp_replace(F.expr("uuid()"), "-", "")), now()).alias("value"),
        F.octet_length(payload).alias("size"))


def archive_pages(pages: DataFrame) -> str:
    """Write a record for each row of ``pages``; returns the archive's folder."""
    return write_archive(page_records(pages), pages.select(F.octet_length(F.coalesce("html", F.lit(""))).alias("size")), "pages")


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Decide response or revisit from the headers alone: those of ``headers``, record_type, refers_to, and
    ``original``, the header fields of the record that a revisit refers to."""
    large = headers.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = large.groupBy("payload_digest").agg(
        F.min(F.struct("page_id", "record_id", "target_uri", "date")).alias("original"))
    revisit = ((F.col("payload_bytes") >= min_bytes) & F.col("original").isNotNull()
               & ~F.col("original.page_id").eqNullSafe(F.col("page_id")))
    return (headers.drop("record_type", "refers_to").join(first, "payload_digest", "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("original.page_id"))))


def deduplicate_archive(spark: SparkSession, path: str, min_bytes: int = 0) -> str:
    """Read the archive at ``path``, resolve revisits and write the deduplicated one; returns its folder.

    Payloads join their decision by record id, so the many copies of one payload do not meet in one task.
    """
    decided = stage(resolve_revisits(read_archive(spark, path), min_bytes).select(
        F.col("record_id").alias("id"), F.col("record_type").alias("kind"), "original",
        F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0).alias("size")), "warc-decided")
    records = read_archive(spark, path, payloads=True).join(decided, F.col("record_id") == F.col("id"))
    # the new id of a record follows from the old one and the archive
    mark = uuid.uuid4().hex
    fresh = lambda name: urn(F.md5(F.concat(name, F.lit(mark))))
    body = F.when(F.col("kind") == "response", F.col("payload")).otherwise("")
    original = (F.col("original.page_id"), fresh(F.col("original.record_id")), F.col("original.target_uri"))
    return write_archive(records.select(record_text(
        F.col("kind"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest"), body, F.col("payload_bytes"),
        fresh(F.col("record_id")), now(), original).alias("value"), "size"), decided.select("size"), f"deduplicated {path}")


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    clean = deduplicate_archive(spark, archive_pages(pages))
    return read_archive(spark, clean).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
