"""WARC archives: writing, normalising monolithic gzip files, and reading them back.

1. Pages become WARC records (built by Spark's own functions) and are written as monolithic gzip files:
   one gzip stream over many records, closed at ``most`` bytes. Payloads of at least ``least`` bytes that occur again are
   revisits of the record with the smallest id.
2. The normaliser inflates each file's stream once, from front to back, and rewrites every record as a gzip
   member of its own, in archives of ``most`` bytes. Each task writes its archives and, beside each, its sidecar index (a
   JSON object per record: offset, length, id, type), through Spark's writer, which commits both or neither.
3. ``read`` takes whole archives, member by member, without a shuffle; ``fetch`` finds some records by the index.

Compressed bytes are written as text rows that end in a zero byte. A stream is cut into rows where it holds one; the end
of a stream of less than 16 MiB is one anyway (the last byte of its size field), which is left off the row, so members
are adjacent. A larger one is followed by one byte of zero padding, which gzip readers skip; the index's lengths do
not count it. Files are ``archive=<n>/kind=warc/part-*`` and ``kind=index``: names that Spark's writer gives.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import cut, exists, new_path, remove

#: Rows of 40 bytes that may be broadcast; beyond that the join is shuffled.
BROADCAST_ROWS = 1_000_000
#: Bytes of a monolithic file's records and of an archive, above which the next one begins.
MOST = 64 << 20
END = b"\r\n\r\n"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 100, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the WARC record of each page, without the blank lines that close it."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    page = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), text.alias("text"))
    page = page.select("*", F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("digest"))
    again = page.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    again = cut(again.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "repeated")
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    page = page.join(again, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("text")))
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20]", "%20")),  # a null URL gives no line
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return page.select(F.concat(header, block).alias("value"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def write_monolithic(recs: DataFrame, path: str, most: int = MOST, level: int = 6, piece: int = 1 << 20) -> None:
    """Write records as gzip files, each file one gzip stream over at most ``most`` bytes of records (or one larger record)."""

    def run(batches):
        stream, z, size, seq, held = -1, None, 0, 0, b""

        def out(row: bytes) -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            return _batch([(stream, seq, row)], ["stream", "seq", "value"])

        for b in batches:
            for value in b.column(0):
                record = value.as_py().encode() + END
                if z and size + len(record) > most:
                    held += z.flush()
                    yield out(held.removesuffix(b"\0"))
                    z = None
                if not z:
                    stream, z, size, held = stream + 1, zlib.compressobj(level, zlib.DEFLATED, 31), 0, b""
                held += z.compress(record)
                size += len(record)
                if len(held) > piece and (at := held.rfind(b"\0")) >= 0:
                    yield out(held[:at])
                    held = held[at + 1 :]
        if z:
            held += z.flush()
            yield out(held.removesuffix(b"\0"))

    made = recs.select("value").mapInArrow(run, "stream long, seq long, value binary")
    _write(made, ["stream"], ["stream", "seq"], path)


def _write(rows: DataFrame, folders: list[str], order: list[str], path: str) -> None:
    """Rows of bytes in order, each followed by a zero byte, to one file per task and folder whatever the session says."""
    rows = rows.sortWithinPartitions(*order).select(F.col("value").cast("string").alias("value"), *folders)
    rows.write.partitionBy(*folders).option("lineSep", "\0").option("maxRecordsPerFile", 0).option("compression", "none").text(path)


def inflated(data, step: int = 1 << 20):
    """The content of a gzip file (bytes or a buffer; of any number of members) in pieces, each byte inflated once."""
    data, at = memoryview(data), 0
    while at < len(data):
        z = zlib.decompressobj(31)
        while not z.eof and at < len(data):
            yield z.decompress(data[at : at + step])
            at += step
        if not z.eof:
            raise ValueError("the gzip stream ends early")
        at = min(at, len(data)) - len(z.unused_data)
        while at < len(data) and data[at] == 0:  # padding between members
            at += 1


def split_records(pieces):
    """Each record's bytes (header, blank line, block) out of an inflated stream."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                at = held.find(END)
                if at < 0:
                    break
                size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", bytes(held[: at + 2]))
                if not held.startswith(b"WARC/") or not size:
                    raise ValueError("not a WARC record")
                need = at + 4 + int(size[1])
            if len(held) < need + 4:
                break
            if held[need : need + 4] != END:
                raise ValueError("a record's length is wrong")
            yield bytes(held[:need])
            del held[: need + 4]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, block = record.partition(END)
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, block


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def normalise(spark: SparkSession, source: str, target: str, most: int = MOST, level: int = 6) -> None:
    """Rewrite the gzip files below ``source`` as archives with their indexes. A file gives one archive, or several of ``most`` bytes."""

    def run(batches):
        archive = -1
        for b in batches:
            for data in b.column("content"):
                archive, offset, rows, held = archive + 1, 0, [], 0
                for record in split_records(inflated(data.as_buffer())):
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = z.compress(record + END) + z.flush()
                    row = member.removesuffix(b"\0")
                    if offset and offset + len(row) >= most:
                        archive, offset = archive + 1, 0
                    fields, _ = parse(record)
                    entry = {"offset": offset, "length": len(member), "id": _page(fields["warc-record-id"]), "type": fields["warc-type"]}
                    rows += [(archive, "warc", offset, row), (archive, "index", offset, json.dumps(entry).encode())]
                    offset, held = offset + len(row) + 1, held + len(row)
                    if held > 1 << 20:
                        yield _batch(rows, ["archive", "kind", "offset", "value"])
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, ["archive", "kind", "offset", "value"])

    made = spark.read.format("binaryFile").load(source).select("content").mapInArrow(run, "archive long, kind string, offset long, value binary")
    _write(made, ["archive", "kind"], ["archive", "kind", "offset"], target)


def _name(path: Column) -> Column:
    """The name that an archive and its index share: the folder's number and the task's."""
    return F.regexp_replace(path, r"^.*/archive=(\d+)/kind=\w+/part-(\d+)[^/]*$", "$1/$2")


def index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar indexes of a normalised archive: ``archive, offset, length, id, type``."""
    lines = spark.read.option("lineSep", "\0").text(path).where("kind = 'index'").select("value", _name(F.col("_metadata.file_path")).alias("archive"))
    return lines.select("archive", F.from_json("value", "offset long, length long, id long, type string").alias("e")).select("archive", "e.*")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``archive, content``: a row for each archive file."""
    return spark.read.format("binaryFile").load(path).where("kind = 'warc'").select(_name(F.col("path")).alias("archive"), "content")


def members(data, step: int = 1 << 14):
    """Each record (header, blank line, block) of an archive whose members are one record each, from front to back."""
    data, at = memoryview(data), 0
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        while not z.eof and at < len(data):
            parts.append(z.decompress(data[at : at + step]))
            at += step
        if not z.eof:
            raise ValueError("a member ends early")
        at = min(at, len(data)) - len(z.unused_data)
        while at < len(data) and data[at] == 0:
            at += 1
        yield b"".join(parts)[: -len(END)]


def read_member(data, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header fields and block of the record whose member starts at offset."""
    return parse(zlib.decompress(memoryview(data)[offset : offset + length], 31)[: -len(END)])


SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _told(fields: dict[str, str], block: bytes) -> tuple:
    """A record's row of SCHEMA. A response's size and digest are those of its payload and must agree with its header."""
    head, _, payload = block.partition(END)
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError("a payload differs from its digest")
    return _page(fields["warc-record-id"]), size, digest, fields["warc-type"], _page(fields.get("warc-refers-to")), fields.get("warc-target-uri")


def _rows(told, most: int = 4000):
    """Batches of SCHEMA out of the rows of _told."""
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    held = []
    for row in told:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of a normalised archive: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url``.

    Whole archives are read where they lie, member by member; a revisit's size and digest are those that its header states.
    """
    if not exists(spark, f"{path}/archive=0"):  # the archive of an empty table
        return spark.createDataFrame([], SCHEMA)

    def run(batches):
        for b in batches:
            for data in b.column(0):
                yield from _rows(_told(*parse(r)) for r in members(data.as_buffer()))

    return archives(spark, path).select("content").mapInArrow(run, SCHEMA)


def fetch(spark: SparkSession, path: str, ids: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records of some pages, as read() gives them, by the sidecar indexes: only members that are asked for are
    inflated. Index rows are joined to their archive; null ids find nothing.
    """
    if not exists(spark, f"{path}/archive=0"):
        return spark.createDataFrame([], SCHEMA)
    found = index(spark, path).join(ids.select(F.col(id_col).cast("long").alias("id")), "id", "left_semi")
    entries = found.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("entries"))  # of one archive

    def run(batches):
        for b in batches:
            for data, some in zip(b.column("content"), b.column("entries"), strict=True):
                data = data.as_buffer()
                yield from _rows(_told(*read_member(data, e["offset"], e["length"])) for e in some.as_py())

    return archives(spark, path).join(entries, "archive").select("content", "entries").mapInArrow(run, SCHEMA)


def archive(pages: DataFrame, target: str, most: int = MOST, **how) -> None:
    """Write pages as monolithic files, normalise them to ``target``, and drop the monolithic ones.

    Null payloads are empty; null ids and URLs are allowed. Of payloads that occur again, pages that share the smallest
    id are all responses, and a page without id revisits the smallest id if its group has one. An empty
    table gives an empty archive.
    """
    spark, raw = pages.sparkSession, new_path(pages.sparkSession, "monolithic")
    write_monolithic(records(pages, **how), raw, most)
    if exists(spark, f"{raw}/stream=0"):
        normalise(spark, raw, target, most)
    remove(spark, raw)


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """archive() to the shared folder, then read()."""
    target = new_path(pages.sparkSession, "warc")
    archive(pages, target, **how)
    return read(pages.sparkSession, target)
