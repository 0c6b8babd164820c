"""WARC archives with segmented records: writing them, and putting the segments together again.

A record larger than a segment is written as a first segment and continuation records that name it
(``WARC-Segment-Origin-ID``) and count on from it; the last one states the total length. Response
blocks are HTTP messages with chunked framing. Records with a payload already archived are revisits
that name the response holding it.

Archives are gzipped WARC files of bounded size in a folder of any file system Spark writes to, one
record after the other; segments of a record may be in different files. Reading them back, whole
records stay in the task that parsed them; only segments travel, grouped by origin.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regista.llm.shipping import ship
from regista.workspace import run_folder

#: bytes of a block beyond which a record is segmented
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: records in one archive file: with the segment size this bounds a file to 64 MB
FILE_RECORDS = 4096
REVISIT_BYTES = 1000
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: records carry no clock time, so the same pages always give the same archive
_DATE = "1970-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP/1.1 chunked framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped. Broken framing raises."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size line is not ended")
        size = int(body[at:line].split(b";")[0].strip(), 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or at + size + 2 > len(body) or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is shorter than its size")
        parts.append(body[at:at + size])
        at += size + 2


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written densely to the shared folder and read from there; pages weigh most of what is kept."""
    path = run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _record(kind: str, record: str, block: bytes, **fields: object) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record}>", f"WARC-Date: {_DATE}"]
    head += [f"WARC-{name.replace('_', '-')}: {value}" for name, value in fields.items() if value is not None]
    lines = "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}"])
    # the two line ends after a block are written between records
    return lines.encode() + _END + block


def _uri(page: int | None, row: int) -> str:
    return f"urn:page:{'' if page is None else page}:{row}"


def _write_batches(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, row, url, text, digest, size, refers, refers_row = (c.to_pylist() for c in batch.columns)
            out = []
            for i, own in enumerate(page):
                name = _uri(own, row[i])
                target = (url[i] or "").replace("\r", "%0D").replace("\n", "%0A") or None
                if refers_row[i] is not None:
                    out.append(_record("revisit", name, b"", Target_URI=target, Payload_Digest=f"sha1:{digest[i]}",
                                       Refers_To=f"<{_uri(refers[i], refers_row[i])}>", Profile=_PROFILE))
                    continue
                block = _HTTP + chunked(text[i].encode())
                fields = dict(Target_URI=target, Payload_Digest=f"sha1:{digest[i]}")
                if len(block) <= segment:
                    out.append(_record("response", name, block, **fields))
                    continue
                cuts = range(0, len(block), segment)
                out.append(_record("response", name, block[:segment], Segment_Number=1, **fields))
                for number, at in enumerate(cuts[1:], 2):
                    out.append(_record("continuation", f"{name}:{number}", block[at:at + segment], Segment_Number=number,
                                       Segment_Origin_ID=f"<{name}>",
                                       Segment_Total_Length=len(block) if number == len(cuts) else None))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def write_archives(pages: DataFrame, folder: str, segment: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Writes a record for each row of ``pages`` (page_id, url, html) as WARC files in ``folder``.

    Payloads of :data:`REVISIT_BYTES` or more that are equal are archived once, with the largest
    page_id; the other rows are revisits. Rows of one page_id are told apart by a row number, of
    which the largest holds the payload. Null html is an empty payload, null page_ids come before
    all others.
    """
    if segment < 1:
        raise ValueError("segments need at least one byte")
    ship(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), F.monotonically_increasing_id().alias("row"),
                        F.col("url").cast("string"), payload.alias("html"), F.sha1(F.encode(payload, "UTF-8")).alias("digest"),
                        F.octet_length(payload).cast("bigint").alias("size"))
    rows = _kept(rows, "pages")
    # the narrow key of each large payload is aggregated before it travels; a payload of very many
    # rows is one row of the result, and the join back may split it
    last = F.max(F.struct(F.col("page_id"), F.col("row"))).alias("last")
    holders = (rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(last, F.count("*").alias("n"))
               .where("n > 1").select("digest", "size", F.col("last.page_id").alias("refers_to"), F.col("last.row").alias("refers_row")))
    revisits = (rows.where(F.col("size") >= REVISIT_BYTES).select("row", "digest", "size")
                .join(holders, ["digest", "size"]).where("row <> refers_row").select("row", "refers_to", "refers_row"))
    texts = F.when(F.col("refers_row").isNull(), F.col("html"))
    records = rows.join(revisits, "row", "left").select(
        "page_id", "row", "url", texts.alias("html"), "digest", "size", "refers_to", "refers_row").mapInArrow(
        _write_batches(segment), "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", _END.decode()).option(
        "maxRecordsPerFile", file_records).option("compression", "gzip").text(folder)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(header fields by lower-case name, block) of each record of a file."""
    view, at = memoryview(data), 0
    while at < len(data):
        if data[at:at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(_END, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields: dict[str, str] = {}
        for line in bytes(view[at:end]).decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        if end + 4 + length > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, view[end + 4:end + 4 + length]
        at = end + 4 + length


_PARSED = ("record string, origin string, type string, refers_to string, digest string, segment int, total bigint, block binary, "
           "payload_bytes bigint, payload_digest string")


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(_END)
    framed = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n"))
    return dechunked(body) if framed else body


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for fields, block in parse_records(gzip.decompress(content.as_py())):
                name = fields["warc-record-id"].strip("<>")
                number = int(fields.get("warc-segment-number", 0))
                total = fields.get("warc-segment-total-length")
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                refers = fields.get("warc-refers-to", "").strip("<>") or None
                kind = fields["warc-type"]
                size = found = None
                if not number and kind == "response":
                    payload = _payload(bytes(block))
                    size, found = len(payload), hashlib.sha1(payload).hexdigest()
                rows.append((name, fields.get("warc-segment-origin-id", name).strip("<>"), kind, refers, digest, number,
                             int(total) if total else None, bytes(block) if number else None, size, found))
            columns = list(zip(*rows)) if rows else [[]] * 10
            types = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             [f.split()[0] for f in _PARSED.split(", ")])


def _reassemble_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, faults = [], [], []
        for total, segments in zip(batch.column("total").to_pylist(), batch.column("segments")):
            size = digest = fault = None
            numbers = [s["segment"].as_py() for s in segments]
            blocks = [s["block"].as_py() for s in segments]
            if numbers != list(range(1, len(numbers) + 1)):
                fault = "segments are missing or repeated with different blocks"
            elif total is None:
                fault = "the last segment is missing"
            elif sum(map(len, blocks)) != total:
                fault = "segments do not add up to the total length"
            else:
                try:
                    payload = _payload(b"".join(blocks))
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                except ValueError as error:
                    fault = str(error)
            sizes.append(size)
            digests.append(digest)
            faults.append(fault)
        yield pa.RecordBatch.from_arrays(
            [batch.column("origin"), batch.column("digest"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
             pa.array(faults, pa.string())], ["record", "digest", "payload_bytes", "payload_digest", "fault"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(record, type, refers_to, payload_bytes, payload_digest, fault) of each record in a folder.

    Segmented records are one row. A response whose segments are incomplete, do not add up to the
    total length or are badly framed, or whose payload has another digest than the header says, has
    a ``fault`` and nothing else; equal copies of a segment count once. A revisit has size and digest
    of the response it refers to, if that is here and whole. An empty folder gives no rows.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    parsed = _kept(files.mapInArrow(_parse_batches, _PARSED), "records")
    pieces = parsed.where("segment > 0").groupBy("origin").agg(
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("segments"),
        F.max("total").alias("total"), F.max("digest").alias("digest"))
    joined = pieces.select("origin", "digest", "total", "segments").mapInArrow(
        _reassemble_batches, "record string, digest string, payload_bytes bigint, payload_digest string, fault string")
    whole = parsed.where("segment = 0 and type = 'response'").select(
        "record", "digest", "payload_bytes", "payload_digest", F.lit(None).cast("string").alias("fault"))
    wrong = F.when(F.col("payload_digest") != F.col("digest"), "the payload has another digest")
    responses = whole.unionAll(joined).select(
        "record", F.lit("response").alias("type"), F.lit(None).cast("string").alias("refers_to"), "payload_bytes",
        "payload_digest", F.coalesce("fault", wrong).alias("fault"))
    held = responses.where("fault is null").select(F.col("record").alias("held"), "payload_bytes", "payload_digest")
    revisits = parsed.where("type = 'revisit'").select("record", "refers_to", "digest").join(
        held, F.col("refers_to") == F.col("held"), "left").select(
        "record", F.lit("revisit").alias("type"), "refers_to", "payload_bytes", "payload_digest",
        F.when(F.col("held").isNull(), "the response is not here").when(
            F.col("payload_digest") != F.col("digest"), "the response has another digest").alias("fault"))
    return responses.unionAll(revisits)


def round_trip(pages: DataFrame, segment: int = SEGMENT_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) for each row of ``pages``.

    Writes the pages as archives in the shared folder and reads them back; an unreadable record is
    an error. An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = run_folder(spark, "warc")
    write_archives(pages, folder, segment)
    records = read_archives(spark, folder)
    page = lambda c: F.nullif(F.split_part(F.col(c), F.lit(":"), F.lit(3)), F.lit("")).cast("bigint")
    return records.select(
        page("record").alias("page_id"),
        F.when(F.col("fault").isNull(), F.col("payload_bytes")).otherwise(
            F.raise_error(F.concat("record", F.lit(": "), "fault"))).alias("payload_bytes"),
        "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))
