"""WARC archives: writing with revisits and segments, reading, and reassembly of segments."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pubweave.llm.common import let, slices, written

END = "\r\n\r\n"
#: Bytes of a block in one record, and of a chunk in a block, unless given.
SEGMENT_BYTES, CHUNK_BYTES = 64 << 10, 16 << 10
RECORDS = "type string, record_id string, page_id long, uri string, refers_to long, payload_bytes long, payload_digest string, segmented boolean, number int, total long, block binary"


def base32(digits: Column) -> Column:
    """Upper-case base 32 of a SHA-1 in hexadecimal: each five digits are four of base 32."""
    fours = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1 of bytes, hashed once."""
    return let(F.sha1(payload), base32)


def find_revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(_page, _hash, _first) of the pages that repeat the payload (of ``min_bytes`` or more) of
    the page _first, the smallest id that has it. Payloads are hashed in one pass into a
    narrow table; nothing else of them is shuffled.
    """
    narrow = written(pages.select("_page", F.unhex("_sha1").alias("_hash"), F.octet_length("_payload").alias("_n")), "payloads")
    several = narrow.filter(F.col("_n") >= min_bytes).groupBy(F.col("_hash").alias("_h")).agg(F.min("_page").alias("_first"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    again = narrow.join(several, (F.col("_hash") == F.col("_h")) & (F.col("_page") > F.col("_first")) & (F.col("_n") >= min_bytes))
    return written(again.select("_page", "_hash", "_first").distinct(), "revisits")


def _text(s: Column | str) -> Column:
    return F.encode(s if isinstance(s, Column) else F.lit(s), "UTF-8")


def _pieces(data: Column, size: int) -> Column:
    last = F.greatest(F.ceil(F.octet_length(data) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _block(chunk_bytes: int) -> Column:
    """The HTTP response, with chunked framing; that of a revisit ends with its header."""
    chunk = lambda x: F.concat(_text(F.concat(F.hex(F.octet_length(x)), F.lit("\r\n"))), x, _text("\r\n"))
    # binary arrays are put together as text that is never decoded
    chunks = F.array_join(F.transform(_pieces(F.col("_payload"), chunk_bytes), lambda x: chunk(x).cast("string")), "").cast("binary")
    body = F.when(F.octet_length("_payload") > 0, chunks).otherwise(_text(""))
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    whole = F.concat(_text(f"{head}Transfer-Encoding: chunked{END}"), body, _text(f"0{END}"))
    return F.when(F.col("_first").isNull(), whole).otherwise(_text(f"{head}{END[:2]}"))


def _record(part: Column, i: Column) -> Column:
    """The i-th record (from 0) of a page: continuations name the record that they continue."""
    several = F.size("_parts") > 1
    kind = F.when(i > 0, "continuation").when(F.col("_first").isNull(), "response").otherwise("revisit")
    own_id = F.when(i > 0, F.concat(F.substring("_id", 1, 46), F.lit("-"), i.cast("string"), F.lit(">"))).otherwise(F.col("_id"))
    profile = F.when(F.col("_first").isNotNull(), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    headers = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", kind), _field("WARC-Record-ID", own_id), _field("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        F.when(i > 0, F.lit("")).otherwise(F.concat(F.col("_about"), _field("WARC-Profile", profile), _field("Refers-To-Page-ID", F.col("_first")))),
        _field("WARC-Segment-Number", F.when(several, i + 1)), _field("WARC-Segment-Origin-ID", F.when(i > 0, F.col("_id"))),
        _field("WARC-Segment-Total-Length", F.when(several & (i == F.size("_parts") - 1), F.octet_length("_block"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")), _field("Content-Length", F.octet_length(part)), F.lit("\r\n"),
    )
    return F.concat(_text(headers), part).cast("string")


def warc_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row (value) per WARC record without its closing line ends, of each page a response
    (in several records if its block is longer than ``segment_bytes``) or a revisit.

    A response's block is an HTTP response whose body has chunks of ``chunk_bytes``. Records
    carry the page's number in Page-ID, and a revisit also that of the page it repeats.
    Page numbers are whole numbers, or text of such; other ids are an error. Null html is an
    empty payload; a null url is left out, as is a null page number, and a page without a
    number is always a response. Rows repeated under one page number are written once each:
    those under the smallest number of their payload are all responses, others all
    revisits. Further columns are ignored; an empty table gives no rows.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("_page"), F.col(url_col).alias("_url"), payload.alias("_payload")).withColumn("_sha1", F.sha1("_payload"))
    again = find_revisits(rows, min_bytes)
    # the list of revisits is narrow: Spark broadcasts it while its files are small, and else shuffles pages once
    rows = rows.withColumn("_hash", F.unhex("_sha1")).join(again, ["_page", "_hash"], "left")
    clean = F.regexp_replace("_url", r"[\r\n]", " ")
    digest = F.concat(F.lit("sha1:"), base32(F.col("_sha1")))
    about = F.concat(_field("WARC-Target-URI", clean), _field("Page-ID", F.col("_page")), _field("WARC-Payload-Digest", digest), _field("Payload-Bytes", F.octet_length("_payload")))
    rows = rows.withColumn("_id", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).withColumn("_about", about).withColumn("_block", _block(chunk_bytes))
    rows = rows.select("_id", "_about", "_first", "_block", _pieces(F.col("_block"), segment_bytes).alias("_parts"))
    return rows.select(F.explode(F.transform(F.col("_parts"), _record)).alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_file: int = 20_000, compression: str = "gzip", **options) -> None:
    """Writes the pages' records as WARC files, one or more per task, by Spark's own writer: a
    task that is run again replaces its files."""
    warc_records(pages, **options).write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


_COLUMNS = [x.split()[0] for x in RECORDS.split(", ")]
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.binary()]


def _row(fields: dict[str, str], block: bytes) -> tuple:
    number = lambda key: int(fields[key]) if key in fields else None
    return (
        fields["warc-type"], fields.get("warc-segment-origin-id", fields["warc-record-id"]), number("page-id"), fields.get("warc-target-uri"), number("refers-to-page-id"),
        number("payload-bytes"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "warc-segment-number" in fields, number("warc-segment-number") or 1,
        number("warc-segment-total-length"), block,
    )


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the parts of files between double line ends, in file order. A block may
    hold double line ends itself, so its length decides. No more than a record is held."""
    end = END.encode()
    file, held, need, fields = None, bytearray(), None, {}
    for batch in slices(batches):
        rows = []
        for name, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != file:
                if held:
                    raise ValueError(f"{file} ends within a record")
                file, need = name, None
            held += part
            held += end
            while held:
                if need is None:
                    cut = held.find(end)
                    if cut < 0:
                        break
                    fields = _fields(bytes(held[:cut]))
                    if not {"warc-type", "warc-record-id", "content-length"} <= set(fields):
                        raise ValueError(f"{file} has no WARC record where one should begin")
                    need = int(fields["content-length"])
                    del held[: cut + len(end)]
                if len(held) < need + len(end):
                    break
                rows.append(_row(fields, bytes(held[:need])))
                del held[: need + len(end)]
                need = None
        yield _batch(rows, _COLUMNS, _KINDS)
    if held:
        raise ValueError(f"{file} ends within a record")


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * len(kinds), kinds, strict=True)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files: gzipped ones (``*.gz``) are streamed record by record; plain
    ones (``*.warc``, ``*.txt``) are read whole by one task each, as a file that is cut
    anywhere can't be read from the cut on, and must fit into its memory. A file that isn't
    made of WARC records, or ends within one, is an error.

    record_id is the origin's for continuation records; block is the record's own part.
    """
    packed = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path).select("_metadata.file_path", F.col("value").cast("binary"))
    plain = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,txt}").load(path)
    closed = F.octet_length("content") - F.when(F.endswith("content", F.encode(F.lit(END), "UTF-8")), 4).otherwise(0)
    whole = plain.filter("length > 0").select(F.col("path").alias("file_path"), F.substring("content", F.lit(1), closed).alias("value"))
    return packed.mapInArrow(_parse, RECORDS).union(whole.mapInArrow(_parse, RECORDS))


def dechunk(body: bytes) -> bytes:
    """The payload of chunked transfer framing; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("a chunk doesn't end where its size says")
        out.append(body[line + 2 : line + 2 + size])
        at = line + 4 + size


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body


_STORED = "type string, page_id long, uri string, refers_to long, payload_bytes long, payload_digest string, segments int, complete boolean, payload binary"
_STORED_COLUMNS = [x.split()[0] for x in _STORED.split(", ")]
_STORED_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.binary()]


def _whole(segments: list[dict]) -> tuple:
    """The record that these segments, in order, make up."""
    first, last = segments[0], segments[-1]
    block = b"".join(s["block"] for s in segments)
    numbers = [s["number"] for s in segments]
    closed = last["total"] == len(block) if len(numbers) > 1 or first["segmented"] else last["total"] in (None, len(block))
    complete = numbers == list(range(1, len(numbers) + 1)) and closed
    payload = None
    if complete and first["type"] == "response":
        try:
            payload = http_payload(block)
        except ValueError:
            complete = False
    return (first["type"], first["page_id"], first["uri"], first["refers_to"], first["payload_bytes"], first["payload_digest"], len(segments), complete, payload)


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield _batch([_whole([r]) for r in batch.to_pylist()], _STORED_COLUMNS, _STORED_KINDS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments arrive in order of their record and number; one record is held."""
    held: list[dict] = []
    for batch in slices(batches):
        rows = []
        for r in batch.to_pylist():
            if held and held[0]["record_id"] != r["record_id"]:
                rows.append(_whole(held))
                held = []
            held.append(r)
        yield _batch(rows, _STORED_COLUMNS, _STORED_KINDS)
    if held:
        yield _batch([_whole(held)], _STORED_COLUMNS, _STORED_KINDS)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit: type, page_id, uri, refers_to, declared payload_bytes
    and payload_digest, number of segments, complete, payload.

    Continuation records come to the record that they continue by its identifier, are put
    in the order of their numbers, and their lengths must add up to the total that the last
    one states. A record with a missing or repeated segment, a gap in the numbers, a wrong
    total or broken chunks isn't complete and has a null payload; so has a revisit.
    Continuations of a record that isn't there are one incomplete row of type continuation.
    Only segments are shuffled: records that say they are whole are decoded where they are
    read, in a pass of their own. No records give no rows.
    """
    alone = records.filter("not segmented").mapInArrow(_alone, _STORED)
    parts = records.filter("segmented").repartition("record_id").sortWithinPartitions("record_id", "number").mapInArrow(_joined, _STORED)
    return alone.unionByName(parts)


def page_records(stored: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, segments, complete) of
    reassembled records. A response's length and digest are those of the payload read back,
    null where it isn't complete; a revisit's are those it states of the payload that it
    repeats."""
    read = F.col("type") == "response"
    return stored.select(
        "page_id", F.when(read, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(read, base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to", "segments", "complete",
    )
