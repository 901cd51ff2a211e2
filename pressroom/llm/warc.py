"""WARC archives: records with revisits and segments, written, read back, reassembled and decoded."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressroom.llm.common import salted_join

SEGMENT = 16_384
CHUNK = 4_096
#: Records to a file: with segments of bounded size a file stays small enough for one task.
PER_FILE = 4_000
#: Bytes of a file unpacked at a time.
PART = 1 << 20
END = "\r\n\r\n"
_RECORDS = (
    "record_id string, type string, uri string, key string, refers_to string, digest string, "
    "segment int, origin string, total long, block binary"
)


def bare_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body (extensions and trailers are skipped), or None where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        digits = body[at:end].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            return None
        size = int(digits, 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    """The entity of an HTTP response block; None if a head or the framing is missing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")[1:]]
    if any(f.startswith(b"transfer-encoding:") and f.endswith(b"chunked") for f in fields):
        return dechunked(body)
    return body


def record_id(*parts: Column) -> Column:
    """A name-based ``urn:uuid`` of some columns."""
    name = F.md5(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts])))
    cuts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = 0) -> DataFrame:
    """``(key, url, payload, record_id, refers_to)``: which records revisit an equal payload.

    Of equal payloads of at least ``least`` bytes the greatest id is the response; the others refer
    to it. A null payload is empty; a null id is never the one referred to while another has the
    payload. Digests are grouped before the join, and the join is salted, so a payload on a third
    of all pages is no hot group.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("key"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.length("payload"))
    same = rows.filter(F.col("bytes") >= least).groupBy("sha1", "bytes")
    repeated = same.agg(F.max("key").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = salted_join(rows, repeated.drop("n"), ["sha1", "bytes"], by="key")
    refers = F.when(
        F.col("keeper").isNotNull() & ~F.col("key").eqNullSafe(F.col("keeper")), record_id(F.col("keeper"), F.col("sha1"))
    )
    return joined.select("key", "url", "payload", record_id(F.col("key"), F.col("sha1")).alias("record_id"), refers.alias("refers_to"))


def write_archives(records: DataFrame, path: str, segment: int = SEGMENT, chunk: int = CHUNK) -> None:
    """Write gzipped archives of what ``with_revisits`` gives into a new folder.

    Payloads travel in chunked framing; blocks over ``segment`` bytes go on in continuation records.
    Every archive ends its records as the format asks because that is the writer's line separator.
    """

    def head(kind: str, row: dict, length: int, more: list[str]) -> bytes:
        lines = [
            "WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Record-ID: {row['id']}",
            *([f"WARC-Target-URI: {row['url']}"] if row["url"] else []),
            *([f"X-Record-Key: {row['key']}"] if row["key"] is not None else []),
            *more, "Content-Type: application/http; msgtype=response", f"Content-Length: {length}",
        ]
        return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")

    def records_of(key, url, payload, record, refers) -> Iterator[bytes]:
        url = "".join(url.split()) if url else url
        row = {"id": record, "url": url, "key": key}
        digest = f"WARC-Payload-Digest: sha1:{bare_digest(payload)}"
        answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
        if refers:
            profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            yield head("revisit", row, len(answer), [f"WARC-Refers-To: {refers}", profile, digest]) + answer
            return
        block = answer + chunked(payload, chunk)
        if len(block) <= segment:
            yield head("response", row, len(block), [digest]) + block
            return
        for number, at in enumerate(range(0, len(block), segment), 1):
            part = block[at : at + segment]
            more = [f"WARC-Segment-Number: {number}"]
            if number == 1:
                yield head("response", row, len(part), [*more, digest]) + part
                continue
            more.append(f"WARC-Segment-Origin-ID: {record}")
            if at + segment >= len(block):
                more.append(f"WARC-Segment-Total-Length: {len(block)}")
            own = {**row, "id": f"<urn:uuid:{hashlib.md5(f'{record}/{number}'.encode()).hexdigest()}>"}
            yield head("continuation", own, len(part), more) + part

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "url", "payload", "record_id", "refers_to")]
            out = [x for row in zip(*columns) for x in records_of(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = records.mapInArrow(work, "value binary").select(F.col("value").cast("string"))
    options = {"lineSep": END, "compression": "gzip", "maxRecordsPerFile": PER_FILE}
    lines.write.options(**options).text(path)


def unpacked(content: bytes) -> Iterator[bytes]:
    """The bytes of a plain or gzipped file, a part at a time; what cannot be unpacked ends them."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        unpack, rest = zlib.decompressobj(31), content
        try:
            while rest and not unpack.eof:
                part = unpack.decompress(rest, PART)
                rest = unpack.unconsumed_tail
                yield part
            if not unpack.eof:
                yield unpack.flush()
        except zlib.error:
            return
        content = unpack.unused_data


def parse_archive(content: bytes | Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record, of a file that may come in parts.

    A damaged tail ends the archive: what begins with no version or states no length, and a record
    whose header or block is cut.
    """
    parts = iter([content]) if isinstance(content, bytes) else content
    data, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        part = next(parts, None)
        if part is None:
            return False
        del data[:at]
        data.extend(part)
        at = 0
        return True

    while True:
        while len(data) - at < 5 or data[at : at + 2] == b"\r\n":
            if data[at : at + 2] == b"\r\n":
                at += 2
            elif not more():
                return
        if data[at : at + 5] != b"WARC/":
            return
        seen = 0
        while (end := data.find(b"\r\n\r\n", at + max(0, seen - 3))) < 0:
            seen = len(data) - at
            if not more():
                return
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = number_of(fields.get("content-length", "0"))
        if length is None:
            return
        size = end + 4 - at + length
        while len(data) - at < size:
            if not more():
                return
        yield fields, bytes(data[at + size - length : at + size])
        at += size


def number_of(value: str | None) -> int | None:
    """A number of at most 18 digits; anything else counts as absent."""
    return int(value) if value and len(value) <= 18 and value.isascii() and value.isdigit() else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives (plain or gzipped) in a folder; each file is read by one task, by bytes.

    Files are unpacked part by part. A damaged tail ends its archive, as ``parse_archive`` says;
    segment numbers and lengths that are not numbers count as absent. No files fail the read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 6 + [pa.int32(), pa.string(), pa.int64(), pa.binary()]
        names = "record_id type uri key refers_to digest segment origin total block".split()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, weight = [], 0
                for f, block in parse_archive(unpacked(content)):
                    segment = number_of(f.get("warc-segment-number"))
                    rows.append((
                        f.get("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri"), f.get("x-record-key"),
                        f.get("warc-refers-to"), f.get("warc-payload-digest"), segment if (segment or 0) < 2**31 else None,
                        f.get("warc-segment-origin-id"), number_of(f.get("warc-segment-total-length")), block,
                    ))
                    weight += len(block)
                    if weight > 8 * PART:
                        yield batch_of(rows)
                        rows, weight = [], 0
                yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(work, _RECORDS)


def reassemble(records: DataFrame) -> DataFrame:
    """Records with their blocks whole: continuation records join the record they go on from.

    Groups segments by origin, orders them by number, and verifies that the numbers run from 1 and
    that the lengths add up to the stated total; ``complete`` is false and ``block`` null where they
    do not, or where no first segment is there (the other columns are null then, but for the id).
    A segment that occurs more than once counts once, and its record comes back as often as its
    first segment. Records without segments pass unshuffled. A group is one record's own segments.
    """
    plain = ["record_id", "type", "uri", "key", "refers_to", "digest"]
    single = records.filter("segment is null and origin is null")
    single = single.select(*plain, "block", F.lit(True).alias("complete"))
    parts = records.filter("segment is not null or origin is not null")
    first = F.when(F.col("origin").isNull(), F.struct(*plain))
    groups = parts.groupBy(F.coalesce("origin", "record_id").alias("_origin")).agg(
        F.max(first).alias("_first"),
        F.count(first).alias("_copies"),
        F.max("total").alias("_total"),
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("_parts"),
    )
    numbers = F.transform("_parts", lambda x: x["segment"])
    length = F.aggregate("_parts", F.lit(0).cast("long"), lambda a, x: a + F.length(x["block"]))
    complete = (
        numbers.eqNullSafe(F.sequence(F.lit(1), F.size("_parts")))
        & length.eqNullSafe(F.col("_total"))
        & F.col("_first").isNotNull()
    )

    @F.arrow_udf("binary")
    def joined(column: pa.Array) -> pa.Array:
        return pa.array([None if p is None else b"".join(x["block"] for x in p) for p in column.to_pylist()], pa.binary())

    whole = groups.withColumn("complete", complete).withColumn(
        "block", joined(F.when(F.col("complete"), F.col("_parts")))
    )
    whole = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("_copies").cast("int")))))
    fields = [F.coalesce("_first.record_id", "_origin").alias("record_id"), *[f"_first.{c}" for c in plain[1:]]]
    return single.union(whole.select(*fields, "block", "complete"))


def decoded(records: DataFrame) -> DataFrame:
    """Whole records with ``payload`` instead of ``block``: transfer framing decoded.

    Null where the framing is broken or absent, as in revisits.
    """

    @F.arrow_udf("binary")
    def payload(blocks: pa.Array) -> pa.Array:
        return pa.array([None if b is None else http_payload(b) for b in blocks.to_pylist()], pa.binary())

    return records.withColumn("payload", payload("block")).drop("block")


def resolve_revisits(responses: DataFrame, revisits: DataFrame) -> DataFrame:
    """``revisits(key, refers_to, digest)`` with key, bytes and digest of the response each refers to, joined with salt."""
    targets = responses.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max("key").alias("response_key"), F.max("payload_bytes").alias("payload_bytes"),
        F.max("payload_digest").alias("response_digest"),
    )
    return salted_join(revisits, targets, ["refers_to"], by="key")
