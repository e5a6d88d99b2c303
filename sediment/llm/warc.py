"""Web archives: a writer of gzipped WARC records, and a splittable reader of them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.llm.common import written

# The start of every gzip member, and one whole member without content.
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = MAGIC + bytes(5) + b"\x00\xff" + b"\x03\x00" + bytes(8)
# Payloads smaller than this are never written as revisits.
LEAST_REVISIT = 100
# Compressed members that one written row gathers.
CHUNK_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(head: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in head), f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _clean(value) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def with_originals(pages: DataFrame, page_id: str, payload: Column) -> DataFrame:
    """Add ``payload_digest`` (hex SHA-256) and ``first_id``: for a revisit the identifier of the record
    it refers to, else NULL.

    Only identifiers and digests are grouped; the payloads are shuffled once, by identifier and digest,
    whatever their copies."""
    marked = pages.withColumn("payload_digest", F.sha2(payload, 256))
    large = marked.filter(F.octet_length(payload) >= LEAST_REVISIT).select(F.col(page_id).alias("id"), "payload_digest")
    narrow = written(large, "digests")
    groups = narrow.groupBy("payload_digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    groups = written(groups.filter("n > 1").drop("n"), "groups")
    revisits = written(
        narrow.join(groups, "payload_digest")
        .filter(F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id")))
        .distinct(),
        "revisits",
    )
    left, right = marked.alias("l"), revisits.alias("r")
    same = F.col(f"l.{page_id}").eqNullSafe(F.col("r.id")) & (F.col("l.payload_digest") == F.col("r.payload_digest"))
    return left.join(right, same, "left").select("l.*", "first_id")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one record per row below ``path``: a response with its payload, or a revisit without.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, those with the least identifier are
    responses, and the others refer to it (a NULL identifier counts as largest; where all are NULL all
    are responses; rows that repeat identifier and payload are written alike). A NULL payload is
    empty; a NULL URL is left out. Files are whole gzip members, with an empty one after each chunk and at
    the end. They are written by Spark's own text writer, whose rows are the bytes and whose line
    separator is the empty member, so any file system that Spark reaches will do."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = with_originals(pages.select(page_id, url, payload.alias("payload")), page_id, F.col("payload"))
    rows = rows.select(F.col(page_id).cast("string").alias("id"), F.col(url).alias("url"), "payload", "payload_digest", F.col("first_id").cast("string").alias("first"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            chunk, size = [], 0
            for number, target, payload, digest, first in frame.itertuples(index=False):
                revisit = first is not None and first == first
                head = [
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", f"<urn:page:{'' if number is None else number}>"),
                    ("WARC-Date", "1970-01-01T00:00:00Z"),
                    ("Content-Type", "application/http;msgtype=response"),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                ]
                if target is not None:
                    head.append(("WARC-Target-URI", _clean(target)))
                if revisit:
                    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{first}>")]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                data = _member(head, http.encode() + (b"" if revisit else payload))
                chunk.append(data)
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield pd.DataFrame({"chunk": [b"".join(chunk)]})
                    chunk, size = [], 0
            if chunk:
                yield pd.DataFrame({"chunk": [b"".join(chunk)]})

    members = rows.mapInPandas(run, "chunk binary").select(F.col("chunk").cast("string").alias("value"))
    members.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class _Members:
    """Puts the members of one byte range together from the pieces between magic bytes."""

    def __init__(self):
        self.open, self.parts, self.raw, self.lost = None, [], [], []

    @staticmethod
    def _starts(data: bytes) -> bool:
        return not data or data.startswith(b"WARC/") or b"WARC/".startswith(data)

    def feed(self, piece: bytes) -> bytes | None:
        """The content of a member that ends with this piece, if one does."""
        if self.open is not None:
            try:
                self.parts.append(self.open.decompress(piece))
                self.raw.append(piece)
                return self._ended()
            except zlib.error:
                self.lost.append(b"".join(self.raw))
                self.open = None
        start = zlib.decompressobj(31)
        try:
            content = start.decompress(piece)
        except zlib.error:
            content = None
        if content is None or not self._starts(content[:5]):
            self.lost.append(piece)
            return None
        self.open, self.parts, self.raw = start, [content], [piece]
        return self._ended()

    def _ended(self) -> bytes | None:
        if not self.open.eof:
            return None
        content = b"".join(self.parts)
        self.open, self.parts, self.raw = None, [], []
        return content


RECORD = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("range_start", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("block", T.BinaryType()),
    ]
)


def _record(content: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = content.partition(b"\r\n\r\n")
    headers: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    return headers, rest[: int(size)] if size.isdigit() else rest.removesuffix(b"\r\n\r\n")


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    members, place = _Members(), None

    def rest() -> list[tuple]:
        out = [(*place, "piece", None, data) for data in members.lost]
        if members.open is not None:
            out.append((*place, "head", None, b"".join(members.raw)))
        return out

    for frame in batches:
        out = []
        for file, start, piece in frame.itertuples(index=False):
            if (file, start) != place:
                out += rest() if place else []
                members, place = _Members(), (file, start)
            if not piece and not members.open:
                continue
            content = members.feed(MAGIC + piece)
            if content:
                out.append((*place, "record", *_record(content)))
        yield pd.DataFrame(out, columns=RECORD.names)
    if place:
        yield pd.DataFrame(rest(), columns=RECORD.names)


def _join_ranges(frame: pd.DataFrame) -> pd.DataFrame:
    """Members cut where false magic bytes stand at the end of a range: a head and the pieces after it."""
    order = frame["state"].map({"piece": 0, "head": 1})
    ordered = frame.assign(order=order).sort_values(["range_start", "order"], kind="stable")
    members, out = _Members(), []
    for file, start, state, _, data in ordered[RECORD.names].itertuples(index=False):
        if state == "head" and members.open is not None:
            members = _Members()
        content = members.feed(data)
        if content:
            out.append((file, start, "record", *_record(content)))
    return pd.DataFrame(out, columns=RECORD.names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``headers`` (lower-case names) and ``block`` of every record of the gzipped archives below ``path``.

    Spark's line reader cuts each byte range at gzip's magic bytes, so files are split like any text. A
    piece is a candidate member: its gzip header must decode, and its content begin as a record. Magic
    bytes inside a member make it continue with the next piece. A range owns the members that start in
    it; those whose end falls to the next range behind false magic bytes are put together afterwards.
    Empty members are skipped, truncated ones left out, and an empty folder gives no rows."""
    pieces = (
        spark.read.option("encoding", "ISO-8859-1")
        .option("lineSep", MAGIC.decode("latin-1"))
        .schema("value string")
        .text(path)
        .select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("piece"))
    )
    scanned = written(pieces.mapInPandas(_scan, RECORD), "records")
    whole = scanned.filter("state = 'record'")
    torn = scanned.filter("state <> 'record'").groupBy("file").applyInPandas(_join_ranges, RECORD)
    return whole.unionByName(torn).select("headers", "block")


def _head_end(block: Column) -> Column:
    """Where the blank line after the HTTP head begins, from 1, or 0; the whole block is decoded only for long heads."""
    at = lambda part: F.instr(F.decode(part, "ISO-8859-1"), "\r\n\r\n")
    near = at(F.substring(block, 1, 65536))
    return F.when(near > 0, near).otherwise(at(block))


def payload_of(block: Column) -> Column:
    """The block after its HTTP head."""
    at = _head_end(block)
    return F.when(at > 0, F.substring(block, at + 4, F.lit(2147483647)))


def page_records(records: DataFrame) -> DataFrame:
    """``page_id`` (text), ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to`` (text) and ``intact``
    (whether a response's payload has the digest and length that its headers name).

    A response's size and digest are those of the payload read; a revisit's are those its headers carry."""
    head = F.col("headers")
    named = lambda field: F.nullif(F.regexp_extract(head[field], "^<urn:page:(.*)>$", 1), F.lit(""))
    full = head["warc-type"] == "response"
    at = _head_end(F.col("block"))
    http = F.when(at > 0, F.substring(F.col("block"), F.lit(1), at + 3)).otherwise(F.col("block"))
    size = F.regexp_extract(F.decode(http, "ISO-8859-1"), r"(?i)\r\nContent-Length: *([0-9]+)", 1)
    parsed = records.withColumns({"_payload": payload_of(F.col("block")), "_size": size.try_cast("long")})
    said = F.substring_index(head["warc-payload-digest"], ":", -1)
    read = F.sha2("_payload", 256)
    length = F.octet_length("_payload").cast("long")
    return parsed.select(
        named("warc-record-id").alias("page_id"),
        head["warc-type"].alias("record_type"),
        F.when(full, length).otherwise(F.col("_size")).alias("payload_bytes"),
        F.when(full, read).otherwise(said).alias("payload_digest"),
        named("warc-refers-to").alias("refers_to"),
        (~full | ((read == said) & (length == F.col("_size")))).alias("intact"),
    )
