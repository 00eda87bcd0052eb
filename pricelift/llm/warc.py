"""WARC archives as a Spark data source, with a writer of response and revisit records.

Reading: each archive, or each stretch of whole members of a large one, is a partition.  Predicates on the record type
and on header fields are taken over by the reader; headers are parsed first, and the payload of a record
that is not wanted, or not asked for, is skipped, neither copied nor decoded.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, refers_to string, content_length long, payload binary"

#: Column -> header it is read from.  Fixed values of the format.
HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_length": "content-length",
}
SPLIT_BYTES = 64 << 20
MEMBER = b"\x1f\x8b\x08"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, or the local one of a plain path."""
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


@dataclass
class Stretch(InputPartition):
    """Members of one archive that begin in [start, end)."""

    path: str
    start: int
    end: int


def header_fields(block: bytes) -> dict[str, str]:
    """Named fields of a header block, names lower-cased, a folded line joined to the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


class Member:
    """A gzip member read piece by piece, so that its headers are known before its payload is inflated."""

    def __init__(self, source: io.RawIOBase, ahead: bytes):
        self.source, self.ahead, self.inflate = source, ahead, zlib.decompressobj(31)
        self.used = 0

    def read(self, least: int) -> bytes:
        out = bytearray()
        while len(out) < least and not self.inflate.eof:
            if not self.ahead:
                self.ahead = self.source.read(1 << 16)
                if not self.ahead:
                    raise EOFError("the archive ends inside a record")
            before = len(self.ahead)
            out += self.inflate.decompress(self.ahead, 1 << 16)
            self.ahead = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.used += before - len(self.ahead)
        return bytes(out)

    def skip(self) -> None:
        """Find the end of the member; what is inflated on the way is thrown away."""
        while not self.inflate.eof:
            self.read(1)


def records(source, start: int, end: int, wanted, payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(header fields, payload or None) of the wanted records whose members begin in [start, end).

    The payload of any other record is inflated only to find the end of its member, and thrown away.
    """
    source.seek(start)
    at, ahead = start, b""
    while at < end:
        member = Member(source, ahead)
        head = bytearray()
        while b"\r\n\r\n" not in head:
            more = member.read(1)
            if not more and member.inflate.eof:
                break
            head += more
        if not head:
            return
        block, _, body = bytes(head).partition(b"\r\n\r\n")
        fields = header_fields(block)
        if wanted(fields):
            content = None
            if payload:
                length = int(fields.get("content-length", 0))
                parts = [body]
                have = len(body)
                while have < length and not member.inflate.eof:
                    parts.append(member.read(1))
                    have += len(parts[-1])
                content = b"".join(parts)[:length]
                if fields.get("content-type", "").startswith("application/http"):
                    content = content.partition(b"\r\n\r\n")[2]
            yield fields, content
        member.skip()
        at += member.used
        ahead = member.ahead


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.columns = [c.strip() for c in options.get("columns", "").split(",") if c.strip()]
        self.tests: list[tuple[str, frozenset[str]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for item in filters:
            column = item.attribute[0] if len(item.attribute) == 1 else ""
            if column in HEADERS and column != "content_length" and isinstance(item, EqualTo):
                self.tests.append((HEADERS[column], frozenset([str(item.value)])))
            elif column in HEADERS and column != "content_length" and isinstance(item, In):
                self.tests.append((HEADERS[column], frozenset(map(str, item.value))))
            elif column == "record_type" and isinstance(item, IsNotNull):
                continue  # every record has a type
            else:
                yield item

    def partitions(self) -> list[InputPartition]:
        fs, root = filesystem(self.path)
        out: list[InputPartition] = []
        for info in sorted(fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)), key=lambda i: i.path):
            if info.type == pafs.FileType.File and info.path.endswith(".warc.gz"):
                out += [Stretch(info.path, at, min(info.size, at + self.split)) for at in range(0, info.size, self.split)]
        return out

    def first_member(self, source, start: int, size: int) -> int:
        """Where the first member at or behind start begins: a gzip head that inflates to a WARC head."""
        if start == 0:
            return 0
        at, window = start, b""
        while at < size:
            source.seek(at)
            window = source.read(1 << 20)
            place = window.find(MEMBER)
            while place >= 0:
                try:
                    if zlib.decompressobj(31).decompress(window[place : place + 4096], 8).startswith(b"WARC/"):
                        return at + place
                except zlib.error:
                    pass
                place = window.find(MEMBER, place + 1)
            at += max(1, len(window) - 4096) if len(window) > 4096 else len(window) or 1
        return size

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # without archives Spark asks for one empty partition
            return
        fs, _ = filesystem(self.path)
        names = self.schema.fieldNames()
        payload = "payload" in names and (not self.columns or "payload" in self.columns)
        wanted = lambda fields: all(fields.get(name) in values for name, values in self.tests)
        arrow = pa.schema([(f.name, pa.binary() if f.name == "payload" else pa.int64() if f.name == "content_length" else pa.string()) for f in self.schema.fields])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

        with fs.open_input_file(partition.path) as source:
            start = self.first_member(source, partition.start, fs.get_file_info(partition.path).size)
            rows, held = [], 0
            for fields, content in records(source, start, partition.end, wanted, payload):
                values = {c: fields.get(h) for c, h in HEADERS.items()}
                values["content_length"] = int(values["content_length"]) if values["content_length"] else None
                values["payload"] = content
                rows.append(tuple(values[n] for n in names))
                held += len(content or b"")
                if len(rows) >= 1000 or held >= 8 << 20:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class WarcWriter(DataSourceWriter):
    """One archive to a task, named by the attempt; of a task's attempts only the committed one stays."""

    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        self.path, self.level = options["path"], int(options.get("level", "3"))

    def write(self, rows: Iterator[Row]) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        out, target = None, f"{root}/part-{uuid.uuid4().hex}.warc.gz.open"
        for row in rows:
            if out is None:
                out = fs.open_output_stream(target, compression=None)
            packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
            out.write(packer.compress(record_head(row)) + packer.compress(bytes(row["payload"] or b"")) + packer.compress(b"\r\n\r\n") + packer.flush())
        if out is not None:
            out.close()
        return Written(target if out is not None else None)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = filesystem(self.path)
        for message in messages:
            if message and message.path:
                fs.move(message.path, message.path.removesuffix(".open"))

    def abort(self, messages: list[Written | None]) -> None:
        """Archives of a failed write keep a name that readers pass over."""


def record_head(row: Row) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Target-URI: {row['target_uri'] or ''}",
        f"WARC-Date: {row['warc_date']}", f"WARC-Payload-Digest: {row['payload_digest']}",
    ]
    if row["refers_to"]:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {row['refers_to']}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(row['payload'] or b'')}"]
    # a line break in a value would end its field
    return ("\r\n".join(line.replace("\r", " ").replace("\n", " ") for line in lines) + "\r\n\r\n").encode("utf-8")


class WarcSource(DataSource):
    """``format("warc")``: option path; on reading splitBytes; on writing level."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(schema, dict(self.options), overwrite)


#: Payloads shorter than this are stored each time.
LEAST_PAYLOAD = 1000


def record_uri(page_id):
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def archive_rows(pages: DataFrame, least: int = LEAST_PAYLOAD, date: str | None = None) -> DataFrame:
    """A record per page: of equal payloads the page with the largest id is the response, others revisit it.

    Digests are aggregated map-side before they are exchanged, so a payload with very many copies is no
    hot key there.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    base = base.select("*", F.sha1("body").alias("sha1"), F.octet_length("body").alias("bytes"))
    largest = base.filter(F.col("bytes") >= least).groupBy("sha1").agg(F.max("page_id").alias("original"))
    joined = base.join(largest, "sha1", "left")
    # a page without an id cannot be referred to, nor refer by its id: it is stored
    revisit = F.coalesce((F.col("bytes") >= least) & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("original")), F.lit(False))
    when = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return joined.select(
        F.when(F.col("page_id").isNotNull(), record_uri(F.col("page_id"))).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(when).alias("warc_date"), F.concat(F.lit("sha1:"), F.col("sha1")).alias("payload_digest"),
        F.when(revisit, record_uri(F.col("original"))).alias("refers_to"), F.col("bytes").cast("long").alias("content_length"),
        F.when(~revisit, F.col("body")).alias("payload"),
    )


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_archives(spark: SparkSession, path: str, columns: str = "") -> DataFrame:
    """Records of all archives below path; ``columns`` names those wanted, so that payloads can be skipped."""
    register(spark)
    reader = spark.read.format("warc").option("columns", columns)
    found = reader.load(path)
    return found.select(*columns.split(",")) if columns else found


def page_of(uri):
    return F.regexp_extract(uri, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, path: str, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write a record per page to archives below path, read them back, and describe the full payload of each.

    Length and digest of a response come from the payload read back; a revisit has those of the response
    it refers to, found by its id.  A null html is an empty payload; a null page_id is stored under a
    made-up id and comes back null; repeated rows are stored each time; an empty table writes nothing and gives
    no rows; further columns are not stored.
    """
    spark = pages.sparkSession
    register(spark)
    archive_rows(pages, least).write.format("warc").mode("append").save(path)
    stored = (
        read_archives(spark, path).filter("record_type = 'response'")
        .select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    )
    referring = read_archives(spark, path, "record_id,record_type,payload_digest,refers_to").filter("record_type = 'revisit'").select("record_id", "refers_to")
    known = stored.dropDuplicates(["record_id"]).withColumnRenamed("record_id", "refers_to")
    revisits = referring.join(known, "refers_to", "left").select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))
    responses = stored.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
