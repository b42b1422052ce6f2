"""WARC archives: written record by record with an index, read back through it.

Each task writes its records to archives of its own (one gzip member per record, a new file
beyond ARCHIVE_BYTES) and emits an index row per record: archive, offset, length, url, digest.
File names are unique to the attempt and the index is committed as a table, so an archive of
a lost or repeated attempt is never referred to. Readers select rows of the index first; the
ranges of an archive are sorted and neighbours merged into one read before any byte is read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.text import map_batches
from tallymark.session import scratch
from tallymark.sources.tables import materialize

ARCHIVE_BYTES = 64 << 20

#: Ranges closer than this are read together, up to so many bytes in one read.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20

#: Archive bytes a reading task gets on average.
TASK_BYTES = 64 << 20

DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "archive string, offset long, length long, page_id long, url string, digest string,"
    " record_type string, refers_to long, payload_bytes long"
)
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}').urn}>"


def _target(url: str) -> list[str]:
    """The target line holds the URL as it is. One with line ends cannot stand on a line: there it
    has them escaped, and a line of our own says how to get it back."""
    if "\r" not in url and "\n" not in url:
        return [f"WARC-Target-URI: {url}"]
    line = url.replace("\r", "%0D").replace("\n", "%0A")
    exact = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    return [f"WARC-Target-URI: {line}", f"X-Exact-URI: {exact}"]


def _url(fields: dict[str, str]) -> str | None:
    if "X-Exact-URI" in fields:
        return fields["X-Exact-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return fields.get("WARC-Target-URI")


def encode(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP head only."""
    revisit = refers_to is not None
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url is not None:
        lines += _target(url)
    if revisit:
        lines += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode(record: bytes) -> tuple:
    """The columns of RECORD. A payload's size and digest are taken from its bytes; a revisit
    has none, so they are what its head says."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if name in fields else None
    url = _url(fields)
    said = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    size, digest = int(said["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if (len(payload), sha1_base32(payload)) != (size, digest):
            raise ValueError(f"record of page {fields.get('X-Page-Id')} is damaged")
        return number("X-Page-Id"), url, "response", None, len(payload), sha1_base32(payload), payload
    return number("X-Page-Id"), url, "revisit", number("X-Refers-To-Page"), size, digest, None


def _zip(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _open_store(folder: str):
    return arrow_fs.FileSystem.from_uri(folder)


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(folder)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))
                for page_id, url, html, refers_to in zip(*columns):
                    payload = (html or "").encode()
                    packed = _zip(encode(page_id, url, payload, refers_to))
                    if out is None or offset + len(packed) > archive_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(packed)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append(
                        (name, offset, len(packed), page_id, url, sha1_base32(payload), kind, refers_to, len(payload))
                    )
                    offset += len(packed)
                if rows:
                    yield _table(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    return run


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(",")]
    columns = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def merge_ranges(ranges: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) as (start, end, members): one read each."""
    merged: list[tuple[int, int, list[int]]] = []
    for at, (offset, length) in enumerate(ranges):
        end = offset + length
        if merged and offset - merged[-1][1] <= gap and end - merged[-1][0] <= most:
            start, old, members = merged[-1]
            merged[-1] = (start, max(old, end), [*members, at])
        else:
            merged.append((offset, end, [at]))
    return merged


def _read(folder: str, gap: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
            start = 0
            while start < len(rows):  # the rows of one archive stand together
                end = start
                while end < len(rows) and rows[end][0] == rows[start][0]:
                    end += 1
                if rows[start][0] != name:
                    if source is not None:
                        source.close()
                    name = rows[start][0]
                    source = store.open_input_file(f"{root}/{name}")
                for low, high, members in merge_ranges([r[1:] for r in rows[start:end]], gap, most):
                    source.seek(low)
                    data = source.read(high - low)
                    found = []
                    for member in members:
                        _, offset, length = rows[start + member]
                        found.append(decode(zlib.decompress(data[offset - low : offset - low + length], 31)))
                    yield _table(found, RECORD)
                start = end
        if source is not None:
            source.close()

    return run


def revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Pages with refers_to: of pages with equal payloads of at least min_payload bytes, all
    but those of the least page_id refer to it. Rows that repeat the least page_id are all
    responses. A null page_id never is the one referred to; a payload that only such pages
    have makes them all responses."""
    raw = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", "html").withColumn("sha", F.sha1(raw))
    keyed = keyed.withColumn("bytes", F.octet_length(raw))
    heads = keyed.filter(F.col("bytes") >= min_payload).groupBy("sha", "bytes").agg(
        F.min("page_id").alias("head"), F.count("*").alias("n")
    )
    heads = heads.filter(F.col("n") > 1).select("sha", "bytes", "head")
    joined = keyed.join(heads, ["sha", "bytes"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, min_payload: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes every page as a record into archives under `folder` and returns the index, as
    a written table. The folder must be one that all executors share."""
    store, root = _open_store(folder)
    store.create_dir(root, recursive=True)
    index = map_batches(revisits(pages, min_payload), _write(folder, archive_bytes), INDEX)
    return materialize(index, "warc-index")


def read_records(
    index: DataFrame, folder: str, gap: int = GAP_BYTES, most: int = READ_BYTES
) -> DataFrame:
    """The records of the given rows of an index, columns as in RECORD."""
    wanted = index.select("archive", "offset", "length")
    # an index row is small, what it stands for is not: tasks are sized by the bytes they read
    total = wanted.agg(F.sum("length")).first()[0] or 0
    least = index.sparkSession.sparkContext.defaultParallelism
    ranges = wanted.repartition(max(least, -(-total // TASK_BYTES)), "archive")
    ranges = ranges.sortWithinPartitions("archive", "offset")
    return map_batches(ranges, _read(folder, gap, most), RECORD)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages, reads all records back: page_id, payload_bytes, payload_digest,
    record_type, refers_to. A null html is an empty payload; a null url has no target line;
    repeated rows are records of their own; an empty table gives no rows."""
    folder = folder or scratch(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
