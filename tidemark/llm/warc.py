"""WARC archives: a writer with revisit records and a splittable reader.

Writer: a page whose payload equals that of a page with a larger id becomes a revisit of the page with the largest id;
every record is a gzip member of its own. Equal payloads are found by SHA-1 and length; the groups are aggregated before
they meet the pages, and Spark's skew join splits a group that holds a third of all pages.

Reader: the files are cut into byte ranges, whatever the records are. A task scans its range for the gzip magic, and a
candidate counts as a member if its decoded start is a WARC header and if it is followed by another member or the end
of the file. A record belongs to the range in which it starts and is read beyond the range's end. From a valid member on
the next one starts where it ends, so no bytes are scanned twice.

Defined cases: a null html is the empty payload; a null url leaves out the target; a page id of null is kept and is never
referred to; repeated rows of the page with the largest id are all responses; an empty table writes nothing and reads as
no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import open_store, put_file, settled

MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a file before the next one is begun, of a range of the reader, and of one read.
FILE_BYTES, RANGE_BYTES, READ_BYTES = 64 << 20, 16 << 20, 1 << 20
#: Tasks of the reader at most; each reads one range after the other.
READERS = 10_000


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``html`` and ``refers_to`` (null for a response)."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(pages["page_id"], pages["url"], html.alias("html"), F.sha1(html).alias("__d"), F.octet_length(html).alias("__n"))
    large = rows.where(F.col("__n") >= least_bytes) if least_bytes else rows
    groups = large.groupBy("__d", "__n").agg(F.max("page_id").alias("__to"), F.count(F.lit(1)).alias("__c")) \
        .where("__c > 1 AND __to IS NOT NULL").drop("__c")
    return rows.join(groups, ["__d", "__n"], "left").select(
        "page_id", "url", "html",
        F.when(F.col("__to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__to")), F.col("__to")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes one record for each page below ``folder``; an action on the result (file, records) does the work."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            path = put_file(folder, f"part-{part:06d}-{number:06d}.warc.gz", held)
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(held)]})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                held.append(record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "replace"), refers_to.as_py()))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield close()
                    number, held, size = number + 1, [], 0
        if held:
            yield close()

    folder = settled(pages.sparkSession, folder)
    rows = with_revisits(pages, least_bytes)
    return rows.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", F.col("refers_to").cast("bigint").alias("refers_to")) \
        .mapInArrow(run, "path string, records bigint")


class Members:
    """The gzip members that start in one byte range of a file."""

    def __init__(self, path: str, read_bytes: int = READ_BYTES):
        store, name = open_store(path)
        self.source, self.step = store.open_input_file(name), read_bytes
        self.size = self.source.size()

    def inflate(self, at: int) -> tuple[bytes, int] | None:
        """Content and end of a whole member at ``at`` that holds a WARC record; None if there is none."""
        machine, out, place = zlib.decompressobj(31), io.BytesIO(), at
        try:
            while not machine.eof:
                data = self.source.read_at(min(self.step, self.size - place), place)
                if not data:
                    return None
                place += len(data)
                out.write(machine.decompress(data))
                if out.tell() >= 6 and out.getbuffer()[:6] != b"WARC/1":
                    return None
        except zlib.error:
            return None
        end = place - len(machine.unused_data)
        return (out.getvalue(), end) if out.tell() >= 6 else None

    def starts_member(self, at: int) -> bool:
        return at == self.size or self.source.read_at(min(3, self.size - at), at) == MAGIC

    def within(self, first: int, last: int) -> Iterator[bytes]:
        at = first
        while at < last:
            data = self.source.read_at(min(self.step + 2, self.size - at), at)  # two more bytes: a magic across two reads
            found = data.find(MAGIC)
            if found < 0 or found >= self.step:
                at += self.step
                continue
            at += found
            if at >= last:
                return
            member = self.inflate(at)
            if member is None or not self.starts_member(member[1]):
                at += 1
                continue
            while member is not None:
                content, at = member
                yield content
                if at >= last:
                    return
                member = self.inflate(at)


def parse(content: bytes) -> dict:
    """Fields of a record; a response's digest and length are taken from its payload anew."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda name: (v := fields.get(name, "").removeprefix("<urn:page:").rstrip(">")) and int(v) or (0 if v == "0" else None)
    kind = fields["WARC-Type"]
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != told):
        raise ValueError(f"damaged record of page {fields['WARC-Record-ID']}")
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": length,
        "payload_digest": told, "refers_to": number("WARC-Refers-To"), "html": payload.decode("utf-8", "replace") if kind == "response" else None,
    }


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")


def require_shared(files: DataFrame, folder: str) -> None:
    """An error if Spark does not see all that ``write_archives`` told of: tasks then wrote to disks of their own."""
    told, seen = files.select("path").distinct().count(), _archives(files.sparkSession, folder).count()
    if seen < told:
        raise RuntimeError(f"{folder} is not shared: {told} archives were written there, {seen} are seen")


def read_archives(spark: SparkSession, folder: str, html: bool = True, range_bytes: int = RANGE_BYTES, read_bytes: int = READ_BYTES) -> DataFrame:
    """One row for each record of all ``*.warc.gz`` below ``folder``; tasks get byte ranges, not files."""
    kinds = {"page_id": "bigint", "url": "string", "record_type": "string", "payload_bytes": "bigint", "payload_digest": "string", "refers_to": "bigint"}
    kinds |= {"html": "string"} if html else {}
    files = _archives(spark, folder)
    ranges = files.where("length > 0").select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("first"))
    arrow = pa.schema([(n, pa.int64() if k == "bigint" else pa.string()) for n, k in kinds.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
                members, held, size = Members(path, read_bytes), [], 0
                for content in members.within(first, min(first + range_bytes, members.size)):
                    held.append({n: v for n, v in parse(content).items() if n in kinds})
                    size += len(content)
                    if size >= 4 << 20 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    tasks = max(1, min(ranges.count(), READERS))  # a number: not to be drawn together again
    return ranges.repartition(tasks, "path", "first").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in kinds.items()))
