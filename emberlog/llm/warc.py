"""WARC archives: write them as whole-file gzip streams, rewrite them member by member with an offset index, read back.

``write_archives`` lets Spark write one gzip stream per task. ``normalise`` inflates each of these files once from
front to end and copies every record into a gzip member of its own; beside each new archive it writes an index of
offset, length and record id per line. ``read_records`` fetches members by that index.

Archives must lie where both Spark and pyarrow can reach them (a shared file system, HDFS, S3 and the like).
Files are written under a temporary name and moved into place, so a repeated task replaces its own file.

A null payload is empty. Payloads of at least ``least`` bytes that occur more than once become one response, that of the
smallest id, and revisits; rows without an id are always responses. Repeated rows with equal ids are all responses if they
hold the smallest id. A stream that ends within a gzip member, a header or a record fails the job, as does a response whose
payload has another digest than it declares. Line ends in URLs become spaces, a null URL is left out. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.shared import checkpointed, small_enough

LINE = "\r\n"
RECORD_END = LINE * 2
CHUNK = 1 << 20
#: So many digests of recurring payloads, of about a hundred bytes each, are broadcast at most.
KNOWN_DIGESTS = 200_000
INDEX = "archive string, offset bigint, length bigint, record_id string"
RECORDS = (
    "record_id string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)


def with_revisits(df: DataFrame, id_col: str, payload_col: str, least: int = 100) -> DataFrame:
    """The rows with ``payload``, ``payload_bytes``, ``payload_digest`` and ``refers_to`` (null for responses)."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    known = df.withColumns({"payload": payload, "payload_bytes": F.octet_length(payload).cast("bigint")})
    known = known.withColumn("payload_digest", F.sha2(F.col("payload").cast("binary"), 256))
    large = F.col("payload_bytes") >= least
    first = checkpointed(
        known.filter(large)
        .groupBy("payload_digest")
        .agg(F.min(id_col).alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    # A narrow row for each payload that recurs. As a table of its own it leaves Spark free to split a digest with many copies.
    first = F.broadcast(first) if small_enough(first, KNOWN_DIGESTS) else first
    joined = known.filter(large).join(first, "payload_digest", "left")
    refers = F.when(F.col(id_col) != F.col("first_id"), F.col("first_id"))
    # Short payloads take no part in the join, however often one occurs.
    short = known.filter(~large).withColumn("refers_to", F.lit(None).cast(known.schema[id_col].dataType))
    return joined.withColumn("refers_to", refers).drop("first_id").unionByName(short)


def write_archives(rows: DataFrame, folder: str, id_col: str, url_col: str, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write rows of ``with_revisits`` as WARC records, one gzip stream per file."""

    def field(name: str, value) -> F.Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(LINE))).otherwise("")

    def named(column) -> F.Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(RECORD_END),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    record = F.concat(
        F.lit(f"WARC/1.1{LINE}"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", named(F.col(id_col))),
        field("WARC-Target-URI", F.regexp_replace(F.col(url_col), "[\\r\\n]", " ")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        field("WARC-Profile", profile),
        field("WARC-Refers-To", F.when(revisit, named(F.col("refers_to")))),
        F.lit(f"Content-Type: application/http; msgtype=response{LINE}Content-Length: "),
        F.octet_length("http").cast("string"),
        F.lit(RECORD_END),
        F.col("http"),
    )
    # The separator of the text writer is what ends a record.
    writer = rows.withColumn("http", http).select(record.alias("value")).write.mode("overwrite")
    writer.option("compression", "gzip").option("lineSep", RECORD_END).text(folder)


class Inflated:
    """A gzip file, of one member or many, read as one stream in bounded pieces."""

    def __init__(self, stream):
        self.stream, self.buffer = stream, bytearray()
        self.inflater, self.rest, self.within = zlib.decompressobj(31), b"", False

    def more(self) -> bool:
        while True:
            raw = self.rest or self.stream.read(CHUNK)
            if not raw and self.within:
                raise ValueError("the archive ends within a gzip member")
            if not raw:
                return False
            if not self.within:
                raw = raw.lstrip(b"\0")  # padding between and after members
                if not raw:
                    self.rest = b""
                    continue
                self.inflater, self.within = zlib.decompressobj(31), True
            found = self.inflater.decompress(raw, CHUNK)
            self.within = not self.inflater.eof
            self.rest = self.inflater.unconsumed_tail if self.within else self.inflater.unused_data
            if found:
                self.buffer += found
                return True

    def head(self) -> bytes | None:
        """The header of the next record with its empty line; None at the end."""
        start = 0
        while (end := self.buffer.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(self.buffer) - 3)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a header")
                return None
        return self.take(end + 4)

    def take(self, size: int) -> bytes:
        found = bytes(self.buffer[:size])
        del self.buffer[:size]
        return found

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends within a record")
            piece = self.take(min(size, CHUNK))
            size -= len(piece)
            yield piece


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(LINE)[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines if x)}


def located(uri: str):
    """The file system of a path as pyarrow knows it, and the path inside."""
    from pyarrow import fs

    scheme, _, inside = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{inside}"
    elif scheme == "file" and not inside.startswith("//"):
        uri = f"file://{inside}"
    return fs.FileSystem.from_uri(uri)


def agrees(payload: bytes, declared: str) -> bool:
    """Whether a payload has the digest that its record declares, in hexadecimal or Base32; unknown kinds are not looked at."""
    kind, _, value = declared.partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha1", "sha256", "sha512", "md5"):
        return True
    found = hashlib.new(kind, payload, usedforsecurity=False).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def read_member(record: bytes) -> tuple[str | None, str | None, str | None, int | None, str | None, bytes]:
    """A record as a row of ``RECORDS``. What is no HTTP message is its own payload, as it is."""
    end = record.index(b"\r\n\r\n") + 4
    head = fields(record[:end])
    block = record[end : end + int(head["content-length"])]
    if len(block) != int(head["content-length"]):
        raise ValueError(f"{head.get('warc-record-id')} is cut")
    inner, payload = {}, block
    if head.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        start = block.find(b"\r\n\r\n") + 4
        start = start if start > 3 else len(block)
        inner, payload = fields(block[:start]), block[start:]
    declared, kind = head.get("warc-payload-digest", ""), head.get("warc-type")
    if kind == "revisit":  # what it refers to is told by its headers alone
        size = inner.get("content-length", "")
        digest = declared.removeprefix("sha256:") or None
        return head.get("warc-record-id"), kind, head.get("warc-refers-to"), int(size) if size.isdecimal() else None, digest, payload
    # A segment holds a part of the payload that the digest is about.
    if kind == "response" and "warc-segment-number" not in head and not agrees(payload, declared):
        raise ValueError(f"{head.get('warc-record-id')} is damaged")
    digest = hashlib.sha256(payload).hexdigest()
    return head.get("warc-record-id"), kind, head.get("warc-refers-to"), len(payload), digest, payload


def normalise(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Rewrite the archives of ``folder`` to ``out`` with a gzip member per record; the offset index of all of them."""

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, inside = located(path)
                target, base = located(out)
                target.create_dir(base, recursive=True)
                name = inside.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt")
                final = f"{base}/{name}.warc.gz"
                temporary = f"{base}/.{name}-{uuid.uuid4().hex}"
                entries = []
                with source.open_input_stream(inside, compression=None) as stream:
                    with target.open_output_stream(temporary, compression=None) as sink:
                        inflated = Inflated(stream)
                        while (head := inflated.head()) is not None:
                            head = head.lstrip(b"\r\n")
                            named = fields(head)
                            start = sink.tell()
                            deflater = zlib.compressobj(6, zlib.DEFLATED, 31)
                            sink.write(deflater.compress(head))
                            for piece in inflated.pieces(int(named["content-length"])):
                                sink.write(deflater.compress(piece))
                            if b"".join(inflated.pieces(4)) != RECORD_END.encode():
                                raise ValueError(f"a record of {path} is longer than it declares")
                            sink.write(deflater.compress(RECORD_END.encode()) + deflater.flush())
                            entries.append((start, sink.tell() - start, named.get("warc-record-id", "")))
                with target.open_output_stream(f"{temporary}.index", compression=None) as sink:
                    sink.write("".join(f"{a} {b} {c}\n" for a, b, c in entries).encode())
                target.move(temporary, final)
                target.move(f"{temporary}.index", f"{base}/{name}.index")
                columns = list(zip(*entries, strict=True)) or [(), (), ()]
                uri = out.rstrip("/") + f"/{name}.warc.gz"
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri] * len(entries), pa.string()),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.string()),
                    ],
                    ["archive", "offset", "length", "record_id"],
                )

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    return checkpointed(listed.mapInArrow(rewrite, INDEX))


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index names, fetched member by member.

    The SHA-256 digest is taken from the payload; that of a response must have the declared digest, of whatever kind. Length and
    digest of a revisit are those it declares, a digest of another kind with its name in front; null where it tells none. Records
    of other types (``warcinfo``, ``request``, ``metadata``) come out alike. ``payloads`` false leaves the payload column null.
    """

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [(n, t) for n, t in zip(
                ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"],
                [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()],
                strict=True,
            )]
        )
        name, file, rows, size = None, None, [], 0
        for batch in batches:
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if archive != name:
                    if file is not None:
                        file.close()
                    system, inside = located(archive)
                    name, file = archive, system.open_input_file(inside)
                record = gzip.decompress(file.read_at(length, offset))
                row = read_member(record)
                rows.append(row if payloads else (*row[:-1], None))
                size += len(row[-1]) if payloads else 200
                if size > CHUNK * 8:
                    yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, row, strict=True)) for row in rows], kinds)
                    rows, size = [], 0
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, row, strict=True)) for row in rows], kinds)

    return index.select("archive", "offset", "length").mapInArrow(fetch, RECORDS)


def page_number(record_id) -> F.Column:
    """The id within ``<urn:page:...>``; null where the row had none."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1), F.lit("")).cast("bigint")
