"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The writer turns every task's rows into one archive file in the shared folder. Of records with
equal payloads the one with the largest id holds the payload, the others are revisits of it.

The reader gives each task a byte range of a file. The task looks for the gzip magic, and takes
a position for the start of a record if decoding it yields a WARC header whose length fits and
whose checksum holds. It owns the records that start inside its range, also when they end
beyond, so every record is read once, wherever the ranges are cut. After a record the next one
is expected where it ends.

Files are reached through `pyarrow.fs`, by the scheme of the shared folder. A file is written
under a name of the attempt and then moved, so a lost or repeated task leaves one whole file.

Defined results: a null html is an empty payload. Rows of equal payload that share the largest
id are all responses. A row without id is a revisit if the payload occurs with an id, else a
response. Urls may be null and may hold any characters but line breaks, which become spaces.
Other columns play no part; an empty table writes no files and reads no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.common import scratch_dir, stored

MAGIC = b"\x1f\x8b\x08"
_NAMESPACE = uuid.UUID("5d0c2f5e-54b1-4c7a-9a7e-0d7c1c7f2a11")
_READ = 1 << 18


@dataclass(frozen=True)
class WarcOptions:
    """Payloads of fewer than `min_payload` bytes are never revisits."""

    min_payload: int = 0
    range_bytes: int = 8 << 20
    max_tasks: int = 20_000
    date: str = "2024-01-01T00:00:00Z"
    # A record's header must end within so many bytes of its start.
    max_header: int = 1 << 16


# ---------------------------------------------------------------- records


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}')}>"


def _clean(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """One gzip member. A revisit keeps the HTTP header, which tells the payload's length."""
    digest = payload_digest(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"WARC-Refers-To-Page-ID: {refers_to}",
        ]
    text = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(text + block + b"\r\n\r\n") + pack.flush()


def parse(data: bytes) -> dict | None:
    """What a decoded member says, or None if it is no whole WARC record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    length = fields.get("Content-Length", "")
    if not gap or not lines[0].startswith("WARC/") or not length.isdigit():
        return None
    if len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        return None
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    known = [x for x in http.decode("latin-1").split("\r\n") if x.startswith("Content-Length: ")]
    return {"fields": fields, "payload": payload, "payload_bytes": int(known[0][16:]) if known else 0}


# ---------------------------------------------------------------- writing


def revisits(pages: DataFrame, o: WarcOptions) -> DataFrame:
    """(page_id, url, html, refers_to) of every row; refers_to is null for responses."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"), F.sha1(body).alias("key"),
        F.octet_length(body).alias("size"),
    )
    # One small row per payload that occurs more than once; the rest needs no partner.
    holders = stored(
        rows.where(F.col("size") >= o.min_payload)
        .groupBy("key", "size").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1 AND holder IS NOT NULL").select("key", "size", "holder"),
        "holders",
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    return rows.join(holders, ["key", "size"], "left").select(
        "page_id", "url", "html", refers.alias("refers_to")
    )


def write(rows: DataFrame, folder: str, o: WarcOptions) -> DataFrame:
    """Archives of the rows of `revisits`; (path, bytes) per file."""

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"{root}/part-{task.partitionId():06d}.warc.gz"
        attempt = f"{name}.{task.taskAttemptId()}"
        out, size = None, 0
        for pdf in batches:
            for page, url, html, refers in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["refers_to"]):
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(attempt, compression=None)
                member = record(
                    None if pd.isna(page) else int(page), url,
                    (html or "").encode("utf-8", "surrogatepass"),
                    None if pd.isna(refers) else int(refers), o.date,
                )
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            files.move(attempt, name)
            yield pd.DataFrame({"path": [name], "bytes": [size]})

    nullable = rows.withColumn("refers_to", F.col("refers_to").cast("string")).withColumn(
        "page_id", F.col("page_id").cast("string")  # text keeps large ids exact beside nulls
    )
    return stored(nullable.mapInPandas(archive, "path string, bytes long"), "archives")


# ---------------------------------------------------------------- reading


class _Window:
    """Bytes of a file from any position on, read forward in blocks."""

    def __init__(self, source, size: int):
        self.source, self.size, self.start, self.data = source, size, 0, b""

    def at(self, position: int, length: int) -> bytes:
        """Up to `length` bytes; fewer only at the end of the file."""
        length = max(0, min(length, self.size - position))
        if not self.start <= position <= position + length <= self.start + len(self.data):
            want = max(length, min(_READ, self.size - position))
            self.start, self.data = position, self.source.read_at(want, position)
        return self.data[position - self.start : position - self.start + length]

    def find(self, position: int, end: int) -> int | None:
        """The first magic that starts in [position, end)."""
        while position < end:
            block = self.at(position, min(_READ, end - position + len(MAGIC) - 1))
            hit = block.find(MAGIC)
            if hit >= 0:
                return position + hit if position + hit < end else None
            position += max(1, len(block) - len(MAGIC) + 1)
        return None


def _member(window: _Window, position: int, o: WarcOptions) -> tuple[dict, int] | None:
    """The record that starts here and where it ends, or None if none does."""
    decode, parts, seen, at = zlib.decompressobj(31), [], 0, position
    try:
        while not decode.eof:
            block = window.at(at, 1 << 14 if at == position else _READ)
            if not block:
                return None
            parts.append(decode.decompress(block))
            at += len(block)
            seen += len(parts[-1])
            head = parts[0] if len(parts) == 1 else b"".join(parts) if seen < o.max_header else None
            if head is not None and not head.startswith(b"WARC/"[: len(head)]):
                return None
    except zlib.error:
        return None
    found = parse(b"".join(parts))
    return None if found is None else (found, at - len(decode.unused_data))


def records_in_range(source, size: int, start: int, end: int, o: WarcOptions) -> Iterator[dict]:
    """Records that start in [start, end) of a file of `size` bytes."""
    window, position = _Window(source, size), start
    while True:
        position = window.find(position, min(end, size))
        if position is None:
            return
        found = _member(window, position, o)
        if found is None:
            position += 1
        else:
            yield found[0]
            position = found[1]


def read(archives: DataFrame, folder: str, o: WarcOptions) -> DataFrame:
    """The records of (path, bytes), read in ranges by as many tasks."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            for path, size, start, end in zip(pdf["path"], pdf["bytes"], pdf["start"], pdf["end"]):
                rows = []
                with files.open_input_file(path) as source:
                    for r in records_in_range(source, size, start, end, o):
                        f = r["fields"]
                        rows.append(
                            (f.get("WARC-Page-ID"), f.get("WARC-Target-URI"), r["payload_bytes"],
                             f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"],
                             f.get("WARC-Refers-To-Page-ID"), r["payload"])
                        )
                        if len(rows) == 256:
                            yield pd.DataFrame(rows, columns=_COLUMNS)
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=_COLUMNS)

    ranges = archives.withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(o.range_bytes)))
    ).withColumn("end", F.least(F.col("start") + o.range_bytes, F.col("bytes")))
    # A given number of partitions is not coalesced; these rows are small, the ranges are not.
    spread = ranges.repartition(min(o.max_tasks, max(1, ranges.count())), "path", "start")
    texts = ", ".join(
        f"{c} {'long' if c == 'payload_bytes' else 'binary' if c == 'payload' else 'string'}"
        for c in _COLUMNS
    )
    read = spread.mapInPandas(scan, texts)
    return read.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


_COLUMNS = [
    "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload",
]


def round_trip(pages: DataFrame, o: WarcOptions = WarcOptions()) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads their records back."""
    folder = f"{scratch_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    if ":/" not in folder:
        folder = f"file://{folder}"  # pyarrow wants a scheme
    archives = write(revisits(pages, o), folder, o)
    return read(archives, folder, o)


def digest(pages: DataFrame) -> DataFrame:
    return round_trip(pages).drop("url", "payload")
