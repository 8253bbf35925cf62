"""WARC archives: records in segments, chunked transfer framing, revisits; reassembled by origin."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, slices, table, work_folder, written
from dimweave.llm.token_files import shared_file

#: Bytes of a record's block beyond which it continues in another record, and of an HTTP chunk.
SEGMENT_BYTES, CHUNK_BYTES = 32 << 10, 8 << 10

#: Payloads shorter than this are stored again each time.
REVISIT_BYTES = 0

DATE = "2024-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), CHUNK_BYTES):
        piece = payload[at : at + CHUNK_BYTES]
        parts += b"%x\r\n" % len(piece), piece, b"\r\n"
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is not as long as it says")
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _record(headers: dict[str, str | int | None], block: bytes) -> bytes:
    """One record, a gzip member of its own."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    raw = head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(1, wbits=31)
    return squeeze.compress(raw) + squeeze.flush()


def page_records(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> list[bytes]:
    """The records of a page: a revisit, or a response in as many segments as it takes."""
    origin = f"<urn:uuid:{uuid.uuid4()}>"
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": origin,
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page": page,
    }
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        headers |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "X-Refers-To-Page": refers_to,
        }
        return [_record(headers, http + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= SEGMENT_BYTES:
        return [_record(headers, block)]
    pieces = [block[at : at + SEGMENT_BYTES] for at in range(0, len(block), SEGMENT_BYTES)]
    records = [_record(headers | {"WARC-Segment-Number": 1}, pieces[0])]
    for number, piece in enumerate(pieces[1:], 2):
        records.append(_record({
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": DATE,
            "WARC-Segment-Origin-ID": origin,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if number == len(pieces) else None,
        }, piece))
    return records


def revisits(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """`pages` with refers_to: the smallest page_id that has the same payload, null for that page itself.

    Rows with null page_id revisit the smallest one, or are stored again if there is none; a page that
    is repeated whole is stored each time. Groups of equal payloads are reduced to their smallest page
    within each task before they are shuffled, and only groups of several rows take part in the join.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", "html", F.sha1(payload).alias("_sha1"), F.octet_length(payload).alias("_bytes"))
    first = (
        hashed.where(F.col("_bytes") >= revisit_bytes)
        .groupBy("_sha1")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = hashed.join(written(first, f"{folder}/first"), "_sha1", "left")
    same = F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", F.when(~same, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html, refers_to) to archives; returns their manifest (path, n_records).

    Continuations go to archives of their own, so segments of a record lie in different files. Names
    are unique to an attempt and the manifest is written when all are done: files of lost tasks are in
    no manifest. A task holds one page at a time; null html is an empty payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/archives/{uuid.uuid4().hex}"
        paths, files, counts = [f"{name}.warc.gz", f"{name}-more.warc.gz"], [None, None], [0, 0]
        for batch in slices(batches, "html"):
            rows = zip(*(column_of(batch, c).to_pylist() for c in ("page_id", "url", "html", "refers_to")))
            for page, url, html, refers_to in rows:
                payload = (html or "").encode("utf-8", "replace")
                for i, record in enumerate(page_records(page, url, payload, refers_to)):
                    at = min(i, 1)
                    files[at] = files[at] or shared_file(paths[at], "w")
                    files[at].write(record)
                    counts[at] += 1
        for file in filter(None, files):
            file.close()
        made = [(p, n) for p, n in zip(paths, counts) if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], ["path", "n_records"]
        )

    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/archives")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return written(pages.mapInArrow(run, "path string, n_records long"), f"{folder}/manifest")


def members(file) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    unzip, parts, raw = zlib.decompressobj(wbits=31), [], file.read(1 << 16)
    while raw:
        parts.append(unzip.decompress(raw))
        raw = unzip.unused_data
        if unzip.eof:
            yield b"".join(parts)
            unzip, parts = zlib.decompressobj(wbits=31), []
        raw = raw or file.read(1 << 16)
    if parts:
        raise ValueError("the last record is cut off")


def parse_headers(head: bytes) -> dict[str, str]:
    """Header lines after the first, names in lower case."""
    pairs = (line.split(":", 1) for line in head.decode("utf-8").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    end = raw.index(b"\r\n\r\n")
    headers = parse_headers(raw[:end])
    block = raw[end + 4 : end + 4 + int(headers["content-length"])]
    if raw[end + 4 + len(block) :] != b"\r\n\r\n" or not raw.startswith(b"WARC/"):
        raise ValueError("not one record")
    return headers, block


def _number(headers: dict[str, str], name: str) -> int | None:
    return int(headers[name]) if name in headers else None


def payload_of(block: bytes, stated: str | None, revisit: bool) -> tuple[int | None, str | None, str | None]:
    """(payload bytes, digest, what is wrong) of a record's HTTP message."""
    try:
        head, body = block.split(b"\r\n\r\n", 1)
        http = parse_headers(head)
        if revisit:
            return int(http["content-length"]), stated, None
        payload = unchunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
    except (ValueError, KeyError) as error:
        return None, None, f"{type(error).__name__}: {error}"
    found = digest(payload)
    return len(payload), found, None if found == stated else "payload differs from its digest"


FIELDS = (
    "page_id long, record_type string, refers_to long, stated string, payload_bytes long, payload_digest string,"
    " error string, origin string, segment long, total long, block binary"
)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per record: whole ones decoded, segments with their block, origin and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in FIELDS.split(","))])
        for batch in batches:
            for path in column_of(batch, "path").to_pylist():
                rows, held = [], 0
                with shared_file(path, "r") as file:
                    for raw in members(file):
                        headers, block = parse_record(raw)
                        kind, number = headers["warc-type"], _number(headers, "warc-segment-number")
                        stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        row = (_number(headers, "x-page"), kind, _number(headers, "x-refers-to-page"), stated)
                        if number is None:
                            row += (*payload_of(block, stated, kind == "revisit"), None, None, None, None)
                        else:
                            origin = headers.get("warc-segment-origin-id", headers["warc-record-id"])
                            total = _number(headers, "warc-segment-total-length")
                            row += (None, None, None, origin, number, total, block)
                            held += len(block)
                        rows.append(row)
                        if len(rows) == 5000 or held > 4 << 20:
                            yield batch_of(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows, schema)

    return manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(run, FIELDS)


def reassemble(segments: DataFrame) -> DataFrame:
    """Records from segments: grouped by origin, in order of number, checked against the total length.

    A gap, a repeated number, a missing last segment or another total is told in `error`, and such a
    record has no payload. Segments of one record meet in a row; a record is a page, which was a row too.
    """
    first = F.col("segment") == 1
    whole = segments.groupBy("origin").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("page_id", "record_type", "refers_to", "stated")],
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    named = ["page_id", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                rows = []
                for stated, total, parts in zip(*(column_of(part, c).to_pylist() for c in ("stated", "total", "parts"))):
                    block = b"".join(p["block"] for p in parts)
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                        rows.append((None, None, "segments are missing or repeated"))
                    elif total != len(block):
                        rows.append((None, None, "segments differ from their total length"))
                    else:
                        rows.append(payload_of(block, stated, False))
                done = zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*(column_of(part, c) for c in named), *(pa.array(c, k) for c, k in done)],
                    [*named, "payload_bytes", "payload_digest", "error"],
                )

    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, error string"
    return whole.select(*named, "stated", "total", "parts").mapInArrow(run, schema)


def read_pages(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest, error) of every record of the archives."""
    records = written(read_archives(manifest), f"{folder}/records")
    columns = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "error"]
    whole = records.where("origin IS NULL").select(columns)
    return whole.unionByName(reassemble(records.where("origin IS NOT NULL")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    folder = work_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest = write_archives(revisits(pages, folder), folder)
    return read_pages(manifest, folder)
