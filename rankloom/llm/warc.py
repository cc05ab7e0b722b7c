"""WARC archives: segmented and chunked writing, and reassembly when reading.

Written records follow WARC/1.1: a response whose HTTP block is longer than
``segment_bytes`` is cut into a first segment and continuation records, the block
uses chunked transfer framing, and pages with a payload seen under a smaller id
become revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.session import stored

RECORD_END = "\r\n\r\n"
_END = RECORD_END.encode()
# Fixed, so that writing the same pages twice gives the same archives.
WARC_DATE = "2024-01-01T00:00:00Z"
SEGMENT_BYTES = 8192
CHUNK_BYTES = 2048
# With segments of 8 KB the largest archive is about 32 MB before compression.
RECORDS_PER_FILE = 4000
_BATCH_BYTES = 1 << 22
_RESPONSE_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """``payload`` in HTTP chunked transfer framing."""
    out = [b"%x\r\n%b\r\n" % (len(payload[k : k + size]), payload[k : k + size]) for k in range(0, len(payload), size)]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None when the framing is broken or cut off."""
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            return None
        try:
            size = int(body[at:stop].split(b";")[0], 16)
        except ValueError:
            return None
        at = stop + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def _record(kind: str, record_id: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", WARC_DATE), *fields]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head if value is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _page_records(page_id, url, html: bytes, first, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    digest = base32_sha1(html)
    number = "" if page_id is None else page_id
    record_id = f"urn:page:{number}:{digest}"
    uri = ("WARC-Target-URI", None if url is None else " ".join(url.split()))
    payload = ("WARC-Payload-Digest", f"sha1:{digest}")
    http = ("Content-Type", "application/http; msgtype=response")
    if first is not None and first != page_id:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        refers = ("WARC-Refers-To", f"<urn:page:{first}:{digest}>")
        yield _record("revisit", record_id, [uri, payload, refers, ("WARC-Profile", profile), http], b"")
        return
    block = _RESPONSE_HEAD + chunked(html, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _record("response", record_id, [uri, payload, http], block)
        return
    pieces = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    yield _record("response", record_id, [uri, payload, http, ("WARC-Segment-Number", "1")], pieces[0])
    for number, piece in enumerate(pieces[1:], start=2):
        fields = [uri, ("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", str(number))]
        if number == len(pieces):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record("continuation", f"{record_id}:{number}", fields, piece)


def _batched(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write one WARC record per page, and its continuations, as gzipped archives below ``path``.

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes the smallest
    id is the response and the others revisit it; a null id is never that smallest
    one. A page repeated with its id and payload is written as often. Null html is an
    empty payload; a null url leaves the target URI out.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    large = rows.filter(F.octet_length("html") >= min_revisit_bytes)
    shared = large.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # kept as a table so that a payload with very many pages is a skewed join Spark can split
    firsts = stored(shared.select("sha1", "first"), "first-pages")

    def records(batches):
        def each():
            for batch in batches:
                for values in zip(*(batch.column(k) for k in range(4))):
                    page_id, url, html, first = (v.as_py() for v in values)
                    for record in _page_records(page_id, url, html, first, segment_bytes, chunk_bytes):
                        yield (record,)

        yield from _batched(each(), pa.schema([("record", pa.binary())]), lambda r: len(r[0]))

    joined = rows.join(firsts, "sha1", "left").select("page_id", "url", "html", "first")
    written = joined.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    # the text writer puts bytes out as they are; every record ends with the two line ends
    written.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", RECORDS_PER_FILE).option(
        "compression", "gzip"
    ).text(path)


_SEGMENT_SCHEMA = (
    "record_id string, warc_type string, target_uri string, refers_to string, stated_digest string, "
    "origin_id string, segment int, total_length long, block binary"
)


def _inflated(content: bytes) -> bytes:
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def _bare(value: str | None) -> str | None:
    return None if value is None else value.strip().removeprefix("<").removesuffix(">")


def _parsed(archive: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(archive):
        stop = archive.find(_END, at)
        if stop < 0:
            raise ValueError("an archive ends within a record's head")
        version, *lines = archive[at:stop].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:60]!r}")
        head = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        begin = stop + len(_END)
        end = begin + int(head["content-length"])
        if archive[end : end + len(_END)] != _END:
            raise ValueError("a record's block does not have its stated length")
        record_id = _bare(head.get("warc-record-id"))
        number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
        yield (
            record_id,
            head.get("warc-type"),
            head.get("warc-target-uri"),
            _bare(head.get("warc-refers-to")),
            head.get("warc-payload-digest"),
            _bare(head.get("warc-segment-origin-id")) or record_id,
            None if number is None else int(number),
            None if total is None else int(total),
            archive[begin:end],
        )
        at = end + len(_END)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(n, pa.string()) for n in ("record_id", "warc_type", "target_uri", "refers_to", "stated_digest", "origin_id")]
        + [("segment", pa.int32()), ("total_length", pa.int64()), ("block", pa.binary())]
    )
    rows = (row for batch in batches for value in batch.column(0) for row in _parsed(_inflated(value.as_py())))
    yield from _batched(rows, schema, lambda r: len(r[8]) + 200)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Every WARC record below ``path``, one row each, blocks as stored (gzip or plain files).

    An archive is one row of the binary reader, so it has to fit a task.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(_read_segments, _SEGMENT_SCHEMA)


def _payload(block: bytes) -> bytes | None:
    head, separator, body = block.partition(b"\r\n\r\n")
    if not separator:
        return None
    names = {line.partition(b":")[0].strip().lower(): line.partition(b":")[2].strip().lower() for line in head.split(b"\r\n")[1:]}
    return unchunked(body) if b"chunked" in names.get(b"transfer-encoding", b"") else body


def _joined(pieces: list[tuple[int | None, int | None, bytes]]) -> tuple[bytes | None, str | None]:
    """One block from the sorted segments of one origin, or what is wrong with them."""
    if pieces[0][0] is None:
        return pieces[0][2], None
    once = [p for k, p in enumerate(pieces) if k == 0 or p[0] != pieces[k - 1][0]]
    if [p[0] for p in once] != list(range(1, len(once) + 1)):
        return None, "missing segment"
    block = b"".join(p[2] for p in once)
    if once[-1][1] != len(block):
        return None, "length differs"
    return block, None


def _decoder(with_payload: bool):
    schema = pa.schema(
        [(n, pa.string()) for n in ("record_id", "target_uri", "stated_digest")]
        + [("copies", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("problem", pa.string())]
        + [("payload", pa.binary())] * with_payload
    )

    def decode(batches):
        def each():
            for batch in batches:
                for values in zip(*(batch.column(k) for k in range(5))):
                    record_id, uri, stated, copies, segments = (v.as_py() for v in values)
                    block, problem = _joined([(s["segment"], s["total_length"], s["block"]) for s in segments])
                    payload = None if block is None else _payload(block)
                    if payload is None:
                        row = (record_id, uri, stated, copies, None, None, problem or "broken framing")
                    else:
                        digest = base32_sha1(payload)
                        wrong = stated is not None and stated != f"sha1:{digest}"
                        row = (record_id, uri, stated, copies, len(payload), digest, "digest differs" if wrong else None)
                    yield (*row, payload) if with_payload else row

        yield from _batched(each(), schema, lambda r: 200 + (len(r[7] or b"") if with_payload else 0))

    kinds = "record_id string, target_uri string, stated_digest string, copies long, payload_bytes long, payload_digest string, problem string"
    return decode, kinds + ", payload binary" * with_payload


def responses(segments: DataFrame, with_payload: bool = True) -> DataFrame:
    """Responses put together from their segments and decoded.

    ``record_id, target_uri, stated_digest, copies, payload_bytes, payload_digest,
    problem[, payload]``. Only segmented records are shuffled, by the id of their
    origin, and ordered by segment number; their number must run from 1 without a gap
    and their length must be the one the last segment states. ``problem`` says what is
    wrong ("missing segment", "length differs", "broken framing", "digest differs");
    then, but for the last, there is no payload. A record archived several times under
    one id is one row with ``copies`` above 1; continuations whose first segment is
    absent are a row with the problem.
    """
    piece = F.struct("segment", "total_length", "block")
    whole = segments.filter("warc_type = 'response' and segment is null").select(
        "record_id", "target_uri", "stated_digest", F.lit(1).cast("long").alias("copies"), F.array(piece).alias("segments")
    )
    cut = segments.filter("segment is not null and warc_type in ('response', 'continuation')")
    first = F.col("segment") == 1
    grouped = cut.groupBy(F.col("origin_id").alias("record_id")).agg(
        F.max(F.when(first, F.col("target_uri"))).alias("target_uri"),
        F.max("stated_digest").alias("stated_digest"),
        F.greatest(F.sum(F.when(first, 1).otherwise(0)), F.lit(1)).cast("long").alias("copies"),
        F.sort_array(F.collect_list(piece)).alias("segments"),
    )
    decode, schema = _decoder(with_payload)
    return whole.unionByName(grouped).mapInArrow(decode, schema)


def page_of(record_id) -> F.Column:
    """The page id in a record id that :func:`write_archives` made, null when it had none."""
    return F.try_to_number(F.nullif(F.split_part(record_id, F.lit(":"), F.lit(3)), F.lit("")), F.lit("S9999999999999999999")).cast("long")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page: ``page_id, payload_bytes, payload_digest, record_type, refers_to, problem``.

    Revisits take length and digest from the response they refer to, which must have
    the digest they state.
    """
    segments = read_segments(spark, path)
    decoded = stored(responses(segments, with_payload=False), "responses")
    own = decoded.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
        "problem",
    )
    # several whole records may share an id when a page row is repeated
    origins = stored(
        decoded.groupBy(F.col("record_id").alias("refers_to")).agg(
            F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
        ),
        "origins",
    )
    visits = segments.filter("warc_type = 'revisit'").select("record_id", "refers_to", "stated_digest")
    found = visits.join(origins, "refers_to", "left").select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.lit("revisit").alias("record_type"),
        page_of(F.col("refers_to")).alias("refers_to"),
        F.when(F.col("payload_digest").isNull(), F.lit("origin missing"))
        .when(F.concat(F.lit("sha1:"), "payload_digest") != F.col("stated_digest"), F.lit("digest differs"))
        .alias("problem"),
    )
    return own.unionByName(found)
