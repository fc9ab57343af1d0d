"""WARC archives as a chunked record table: payloads stream in pieces that carry running digests.

Writing. Each page becomes one record, or a chain of segments (WARC 1.1 continuation records) if its payload is longer than a chunk. Rows of the
chunk table are single segments, made one after the other by an iterator, so a task never holds a second copy of a whole payload. Segments of a record
follow each other in one file. Spark's own text writer puts them into files of any file system it knows: a row is a segment's header and
block, the line separator is the blank line that ends a record.

Reading. The text reader gives the same files back in order, cut at blank lines wherever they stand; a state machine joins the pieces into records by
``Content-Length``. It yields (record, chunk number, chunk, running SHA-1) rows and checks the digest of every record. A piece is at
most a chunk in archives written here; foreign records without blank lines come in one piece. Archives are gzip files, read whole by one task each
as usual for WARC; their size follows the input partitions.

Payloads of at least ``least_bytes`` that are equal (length and SHA-1) are stored once: the record with the largest page id is the response, others
revisit it. Digests are taken by built-in functions in the scan and combined on the map side; only verdicts are joined to the pages.

Edge cases: a null html is an empty payload; a null url leaves the target out; line ends in urls are escaped. Rows with a null id are records without an id
(they revisit others, or are responses if no id is known). Rows that repeat the largest id are responses each. Empty tables give an archive without records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.session import written

from .text import map_rows

CHUNK_BYTES = 1 << 20
BREAK = "\r\n\r\n"
DATE = "2024-01-31T00:00:00Z"  # the capture time; a parameter of write_archive


def verdicts(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Pages with payload size, digest, record type and, for revisits, the id of the response."""
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).select("*", F.octet_length("html").cast("long").alias("size"), F.sha1(F.col("html").cast("binary")).alias("digest"))
    large = named.where(F.col("size") >= least_bytes).groupBy("size", "digest").agg(
        F.max("page_id").alias("kept"), F.count("*").alias("n")
    )
    # Written first: a payload that very many pages share is then split between tasks when it is joined.
    shared = written(large.where("n > 1 and kept is not null").drop("n"), "shared")
    joined = named.join(shared, ["size", "digest"], "left")
    revisit = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", "size", "digest", F.when(revisit, F.col("kept")).alias("refers_to"))


def _record_id(page_id: int | None, digest: str, segment: int = 1) -> str:
    name = hashlib.md5(f"{page_id}/{digest}/{segment}".encode(), usedforsecurity=False).hexdigest()
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>"


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + BREAK).encode()


def segments(page_id, url, payload: memoryview, digest: str, refers_to, date: str, chunk: int) -> Iterator[bytes]:
    """The records of one page, without the blank line at their end."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{BREAK}".encode()
    first = _record_id(page_id, digest)
    common = [
        ("WARC-Record-ID", first),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url is not None else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", page_id),
        ("X-Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        links = [("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page-ID", refers_to)]
        fields = [("WARC-Type", "revisit"), ("WARC-Profile", profile), *links, *common, ("Content-Length", len(http))]
        yield _head(fields) + http
        return
    many = len(payload) > chunk
    running = hashlib.sha1(usedforsecurity=False)
    for number, at in enumerate(range(0, max(1, len(payload)), chunk), start=1):
        piece = payload[at : at + chunk]
        running.update(piece)
        block = http + bytes(piece) if number == 1 else bytes(piece)
        carried = [("WARC-Segment-Number", number), ("X-Running-Digest", f"sha1:{running.hexdigest()}")] if many else []
        if number == 1:
            fields = [("WARC-Type", "response"), *common]
        else:
            fields = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", _record_id(page_id, digest, number)),
                ("WARC-Segment-Origin-ID", first),
                ("WARC-Date", date),
            ]
            if at + chunk >= len(payload):
                fields.append(("WARC-Segment-Total-Length", len(http) + len(payload)))
        yield _head([*fields, *carried, ("Content-Length", len(block))]) + block


def write_archive(pages: DataFrame, path: str, least_bytes: int = 1000, chunk: int = CHUNK_BYTES, date: str = DATE) -> None:
    """One record a page of (page_id, url, html) into gzip archives at ``path``."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for page_id, url, html, _, digest, refers_to in source:
            payload = memoryview((html or b""))
            for record in segments(page_id, url, payload, digest, refers_to, date, chunk):
                yield (record,)

    judged = verdicts(pages, least_bytes).withColumn("html", F.col("html").cast("binary"))
    records = map_rows(judged, rows, "record binary", flush=16)
    # The bytes go out as they are: a cast from binary to string changes nothing.
    text = records.select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", BREAK).option("compression", "gzip").text(path)


class Parser:
    """Joins pieces of an archive into records; one chunk at a time leaves it."""

    def __init__(self) -> None:
        self.held = b""
        self.fields: dict[str, str] | None = None
        self.left = 0

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
        """(header, block piece, whether the block ends here)."""
        self.held = self.held + data if self.held else data
        while self.held:
            if self.fields is None:
                self.held = self.held.lstrip(b"\r\n")
                end = self.held.find(b"\r\n\r\n")
                if end < 0:
                    return
                lines = self.held[:end].decode("utf-8", "surrogateescape").split("\r\n")
                self.held = self.held[end + 4 :]
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record starts with {lines[0][:60]!r}")
                named = [re.split(r":[ \t]*", line, maxsplit=1) for line in lines[1:]]
                if any(len(pair) < 2 for pair in named) or "Content-Length" not in dict(named):
                    raise ValueError(f"the archive is damaged or ends inside a record: header {lines[:4]}")
                self.fields = dict(named)
                self.left = int(self.fields["Content-Length"]) + 4  # the blank line belongs to the record
            take = self.held[: self.left]
            # A piece may stop inside the blank line, which is not part of the block.
            body = take[: max(0, self.left - 4)]
            self.left -= len(take)
            self.held = self.held[len(take) :]
            fields, done = self.fields, self.left == 0
            if done:
                self.fields = None
            if body or done:
                yield fields, body, done


RECORD = (
    "file string, record string, page_id long, record_type string, refers_to long, chunk_no long, chunk binary, "
    "payload_bytes long, running_sha1 string, last boolean"
)


def _record_rows(source: Iterator[tuple], keep: bool) -> Iterator[tuple]:
    parser, at = Parser(), None
    running, size, number, of, header_left = hashlib.sha1(usedforsecurity=False), 0, 0, None, b""

    def ended() -> None:
        """An archive may not stop inside a record or before the last segment of one."""
        open_chain = of is not None and of["WARC-Type"] == "response" and (of["_head"] == "open" or size < int(of["X-Payload-Length"]))
        if parser.held.strip(b"\r\n") or parser.fields or open_chain:
            raise ValueError(f"archive {at} ends inside a record")

    for file, piece in source:
        if file != at:
            ended()
            parser, at, of = Parser(), file, None
        for fields, body, done in parser.feed(piece + b"\r\n\r\n"):
            kind = fields["WARC-Type"]
            if kind not in ("response", "revisit", "continuation"):
                continue
            if kind != "continuation" and of is not fields:
                of, header_left = fields, b""
                running, size, number = hashlib.sha1(usedforsecurity=False), 0, 0
                of["_head"] = "open"
            if of.get("_head") == "open":
                header_left += body
                end = header_left.find(b"\r\n\r\n")
                if end < 0:
                    continue
                body, of["_head"] = header_left[end + 4 :], "read"
            running.update(body)
            size += len(body)
            stated = int(of["X-Payload-Length"])
            whole = of["WARC-Payload-Digest"].removeprefix("sha1:")
            last = done and (kind == "revisit" or size >= stated)
            digest = running.hexdigest()
            if last and of["WARC-Type"] == "response" and digest != whole:
                raise ValueError(f"payload of {of['WARC-Record-ID']} does not match its digest")
            if body or last:
                page = int(of["X-Page-ID"]) if "X-Page-ID" in of else None
                refers = int(of["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in of else None
                revisit = of["WARC-Type"] == "revisit"
                yield (
                    file, of["WARC-Record-ID"], page, of["WARC-Type"], refers, number, body if keep else None,
                    stated if revisit else size, whole if revisit else digest, last,
                )
                number += 1
    ended()


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The chunk table of archives at ``path``: rows of a record in order, ``last`` on the final one.

    ``running_sha1`` covers the payload up to the end of the row's chunk; revisits carry the stated digest and length of what they refer to.
    Without ``payloads`` the chunks themselves are left out, digests are still checked.
    """
    raw = spark.read.option("lineSep", BREAK).text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    return map_rows(pieces, lambda source: _record_rows(source, payloads), RECORD, flush=16 if payloads else 4096)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record."""
    return (
        read_archive(spark, path, payloads=False)
        .where("last")
        .select("page_id", "payload_bytes", F.col("running_sha1").alias("payload_digest"), "record_type", "refers_to")
    )
