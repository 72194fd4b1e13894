"""Web archives: writing captures as WARC records, reading them back, assembling transactions.

A capture is written as a request, a response and a metadata record; the two others name the
response in WARC-Concurrent-To. Of captures with equal payloads the one with the smallest id is a
response, the others are revisits that refer to it. Archives are gzipped files of records, each
record ended by two line breaks, written by Spark with a bound on the records of a file that
comes from the mean size of a capture.

Reading unpacks archives in parts, parses them by their Content-Length, and joins the records of a capture through
their identifiers to one nested row. Payload bytes stay out of the joins unless asked for.

A null payload is an empty one, a null address gives no WARC-Target-URI. Rows with a null id are
responses only among themselves (an id is smaller than none) and carry no id. Repeated rows of
the responding id are all responses, each with a row of its own; an empty table gives no archive
and no rows.
"""

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.llm.support import stored
from playbill.session import fresh_path

ARCHIVE_BYTES = 64 * 1024 * 1024
#: Bytes of an archive that are unpacked at once.
READ_BYTES = 1024 * 1024
#: Payload bytes from which a batch of records is handed on.
BATCH_BYTES = 16 * 1024 * 1024
GZIP = b"\x1f\x8b"
LEAST_PAYLOAD = 0
RECORD_END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = (
    "record_id string, record_type string, concurrent_to string, target_uri string, "
    "record_date string, refers_to string, declared_digest string, block_type string, "
    "page_id string, payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(payload):
    """Bare upper-case base32 SHA-1: each 40 bits of the hash are eight digits."""
    hashed = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(hashed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*groups)), HEX32, BASE32)


def _record_id(*parts):
    hashed = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cuts = [F.substring(hashed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind, record_id, content_type, block, *headers):
    """One record without its end; ``headers`` are (name, value), left out where null."""
    lines = [
        F.lit(VERSION),
        F.lit(f"WARC-Type: {kind}") if isinstance(kind, str) else F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {DATE}"),
        *[F.concat(F.lit(f"{name}: "), value) for name, value in headers],
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(RECORD_END), block)


def write_archives(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_payload: int = LEAST_PAYLOAD,
) -> None:
    """Write all captures; of equal payloads of at least ``least_payload`` bytes one is kept."""
    captures = pages.select(
        F.col(id).alias("page_id"),
        # Control characters and spaces would end or split a header line.
        F.regexp_replace(F.col(url), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    captures = captures.withColumn("digest", base32_sha1(F.col("payload")))
    size = F.octet_length("payload")
    firsts = captures.groupBy("digest").agg(
        F.min("page_id").alias("first_id"),
        F.count(F.lit(1)).alias("copies"),
        F.max(size).alias("bytes"),
    )
    firsts = stored(firsts, "payloads")
    copies, total = firsts.agg(
        F.sum("copies"), F.sum(F.when(F.col("bytes") > 0, F.col("bytes")).otherwise(1))
    ).first()
    if not copies:
        pages.sparkSession.createDataFrame([], "value string").write.text(path)
        return
    keeper = firsts.filter((F.col("copies") > 1) & (F.col("bytes") >= least_payload))
    keeper = keeper.select("digest", "first_id")
    rows = captures.join(keeper, "digest", "left")
    mean = max(1, total // firsts.count()) + 2000
    rows = rows.withColumn(
        "revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
        & F.col("first_id").isNotNull(),
    )
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    own = _record_id(number, F.col("digest"), F.lit("capture"))
    origin = _record_id(F.col("first_id").cast("string"), F.col("digest"), F.lit("capture"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"),
        F.lit(RECORD_END),
    )
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    concurrent = ("WARC-Concurrent-To", own)
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        own,
        "application/http;msgtype=response",
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload"))),
        target,
        digest,
        ("WARC-Refers-To", F.when(F.col("revisit"), origin)),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(REVISIT_PROFILE))),
    )
    request = _record(
        "request",
        _record_id(number, F.col("digest"), F.lit("request")),
        "application/http;msgtype=request",
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{RECORD_END}")),
        target,
        concurrent,
    )
    known = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit(""))
    metadata = _record(
        "metadata",
        _record_id(number, F.col("digest"), F.lit("metadata")),
        "application/warc-fields",
        F.concat(known, F.lit("\r\n")),
        target,
        concurrent,
    )
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    per_file = max(3, 3 * (ARCHIVE_BYTES // mean))
    writer = records.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", per_file)
    writer.option("compression", "gzip").text(path)


def inflated(data: bytes, step: int = READ_BYTES):
    """The content of an archive in parts of ``step`` bytes, gzipped as a whole or in parts."""
    view, at = memoryview(data), 0
    if data[:2] != GZIP:
        while at < len(view):
            yield bytes(view[at : at + step])
            at += step
        return
    while at < len(view):
        if not view[at]:  # padding between members
            at += 1
            continue
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        while not member.eof:
            given = member.unconsumed_tail or bytes(view[at : at + step])
            if not member.unconsumed_tail:
                at += len(given)
            part = member.decompress(given, step)
            if part:
                yield part
            elif not given:
                raise ValueError("the archive is cut off")
        at -= len(member.unused_data)


def parse_archive(data: bytes):
    """Yield (headers, block) of each record of an archive, gzipped as a whole or in parts.

    One record and one part of the content are in memory besides the archive itself.
    """
    parts, held = inflated(data), bytearray()

    def more():
        part = next(parts, b"")
        held.extend(part)
        return bool(part)

    read = 0
    while True:
        while len(held) >= 2 and held[:2] == b"\r\n":
            del held[:2]
            read += 2
        if len(held) < 2:
            if more():
                continue
            if held:
                raise ValueError(f"no record at byte {read}")
            return
        seen = 0
        while (stop := held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(held) - 3)
            if not more():
                raise ValueError(f"no record at byte {read}")
        lines = held[:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {read}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        end = stop + 4 + int(headers["content-length"])
        while len(held) < end:
            if not more():
                raise ValueError("the last record is cut off")
        block = bytes(held[stop + 4 : end])
        del held[:end]
        read += end
        yield headers, block


def _row(headers, block, with_payload):
    kind = headers["warc-type"]
    payload, size, digest, page = None, None, None, None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            size = len(payload)
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            payload = None
            for line in head.split(b"\r\n"):
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length":
                    size = int(value)
            digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
    elif kind == "metadata":
        for line in block.decode("utf-8", "replace").split("\r\n"):
            name, _, value = line.partition(":")
            if name == "page-id":
                page = value.strip()
    return (
        headers["warc-record-id"], kind, headers.get("warc-concurrent-to"),
        headers.get("warc-target-uri"), headers.get("warc-date"), headers.get("warc-refers-to"),
        headers.get("warc-payload-digest"), headers.get("content-type"), page, size, digest,
        payload if with_payload else None,
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row for each record. A response's digest is computed from its payload."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(RECORD)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parse_archive(content.as_py()):
                    rows.append(_row(headers, block, with_payload))
                    held += len(block) if with_payload else 0
                    if len(rows) == 2000 or held > BATCH_BYTES:
                        yield _batch(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, schema)


def _batch(rows, arrow):
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
    return pa.RecordBatch.from_arrays(columns, schema=arrow)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row (request, response, metadata, refers_to_page) for each capture."""

    def partner(kind, *fields):
        own = records.filter(F.col("record_type") == kind)
        return own.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min(F.struct("record_id", *fields)).alias(kind)
        )

    captured = records.filter(F.col("record_type").isin("response", "revisit"))
    response = captured.select(
        "record_id",
        "refers_to",
        F.struct(
            "record_id", "record_type", "target_uri", "record_date", "declared_digest",
            "payload_bytes", "payload_digest", "payload",
        ).alias("response"),
    )
    whole = response.join(partner("request", "target_uri", "record_date"), "record_id", "left")
    whole = whole.join(partner("metadata", "page_id"), "record_id", "left")
    origin = partner("metadata", "page_id").select(
        F.col("record_id").alias("refers_to"), F.col("metadata.page_id").alias("refers_to_page")
    )
    # A response meets itself there: with nulls as keys, all responses would be in one task.
    known = F.coalesce("refers_to", "record_id")
    whole = whole.withColumn("__known", known).join(
        origin.withColumnRenamed("refers_to", "__known"), "__known", "left"
    )
    page = F.when(F.col("refers_to").isNotNull(), F.col("refers_to_page")).alias("refers_to_page")
    return whole.select("request", "response", "metadata", page)


def archive_round_trip(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write the captures to archives, read them back, and tell what each capture became."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, id, url, payload)
    found = transactions(stored(read_archives(pages.sparkSession, path), "records"))
    kind = pages.schema[id].dataType
    return found.select(
        F.col("metadata.page_id").cast(kind).alias(id),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.col("refers_to_page").cast(kind).alias("refers_to"),
        F.col("request").isNotNull().alias("has_request"),
    )
