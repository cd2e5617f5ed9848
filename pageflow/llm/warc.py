"""WARC archives: a writer with one gzip member per record, and a reader that splits archives anywhere.

Writing: equal payloads are found by SHA-256 and length; the record with the smallest id holds the
payload, the others are ``revisit`` records that name it. Every task writes files of its own below
the given folder and reports them in a manifest table; a retried task writes new files, and files
that the manifest does not name are never read.

Reading: the archives are cut into byte ranges. A task looks for the gzip magic in its range, takes a
place for a member if its first bytes inflate to a WARC header and what follows its end is another
member or the end of the file, and owns the records that start inside the range, reading past its
end to finish the last one. Files are reached through ``pyarrow.fs``, from executors only.

Results: a NULL payload is empty; payloads below ``least`` bytes are never revisits; repeated rows of
the smallest id all are responses; NULL ids are written as an empty field and never referred to unless
the group has no other id; an empty table gives an empty manifest and no records; other columns are
not read.
"""

from __future__ import annotations

import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.llm.common import stored

MAGIC = b"\x1f\x8b\x08"
PROBE = 1 << 10
BLOCK = 1 << 20
MANIFEST = "file string, bytes long, records long"
RECORDS = (
    "file string, start long, record_type string, id long, url string, payload binary,"
    " digest string, length long, refers_to long"
)


def typed_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = 100) -> DataFrame:
    """Per page: id, url, payload, its digest and length, record type and the id a revisit refers to."""
    payload = F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    keyed = rows.withColumns({"digest": F.sha2("payload", 256), "length": F.octet_length("payload").cast("long")})
    repeated = (
        keyed.where(F.col("length") >= least)
        .groupBy("digest", "length")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return keyed.join(repeated, ["digest", "length"], "left").select(
        "id",
        "url",
        F.when(again, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        "digest",
        "length",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _member(row: dict, level: int) -> bytes:
    name = lambda n: "" if n is None else str(n)
    payload = row["payload"] or b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:page:{name(row['id'])}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        "WARC-Target-URI: " + ("" if row["url"] is None else quote(row["url"], safe=":/?&=#%+,;@!$'()*~[]-._")),
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"X-Payload-Length: {row['length']}",
        "Content-Type: text/html",
        f"Content-Length: {len(payload)}",
    ]
    if row["record_type"] == "revisit":
        head.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(3, f"WARC-Refers-To: <urn:page:{name(row['refers_to'])}>")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join(
        [packer.compress("\r\n".join(head).encode() + b"\r\n\r\n"), packer.compress(payload), packer.compress(b"\r\n\r\n"), packer.flush()]
    )


def write_archives(records: DataFrame, folder: str, file_bytes: int = 1 << 28, level: int = 5) -> DataFrame:
    """Writes the records (as of ``typed_records``) to ``.warc.gz`` files; returns the stored manifest."""

    def write(batches):
        from pyarrow import fs as files

        system, root = files.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, done, path, size, count = None, [], None, 0, 0
        task = TaskContext.get()
        for batch in batches:
            for at in range(batch.num_rows):
                member = _member({k: v[0].as_py() for k, v in zip(batch.schema.names, batch.slice(at, 1).columns)}, level)
                if out is None:
                    path = f"{root}/{task.partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = system.open_output_stream(path, compression=None), 0, 0
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["file", "bytes", "records"])

    return stored(records.mapInArrow(write, MANIFEST), "warc-manifest")


def _starts_member(data: bytes, at: int) -> bool:
    """Whether a gzip member at this place inflates to the start of a WARC record."""
    try:
        return zlib.decompressobj(31).decompress(data[at : at + PROBE], 5) == b"WARC/"
    except zlib.error:
        return False


class Range:
    """Records that start in [start, stop) of a file that can seek."""

    def __init__(self, file, size: int, start: int, stop: int):
        self.file, self.size, self.start, self.stop = file, size, start, stop

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(max(0, min(n, self.size - at)))

    def inflate(self, at: int) -> tuple[bytes, int] | None:
        """Content of the member at this place and where it ends; None if it is no whole member."""
        unpack, parts, place = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof:
                block = self.read(place, BLOCK)
                if not block:
                    return None
                place += len(block)
                parts.append(unpack.decompress(block))
        except zlib.error:
            return None
        return b"".join(parts), place - len(unpack.unused_data)

    def members(self):
        at = self.start
        while at < self.stop:
            block = self.read(at, min(BLOCK, self.stop - at) + len(MAGIC) - 1)
            found = block.find(MAGIC)
            if found < 0 or at + found >= self.stop:
                at += max(1, len(block) - len(MAGIC) + 1)
                continue
            at += found
            if not _starts_member(self.read(at, PROBE), 0) or (member := self.inflate(at)) is None:
                at += 1
                continue
            content, end = member
            if end < self.size and not _starts_member(self.read(end, PROBE), 0):
                at += 1
                continue
            yield at, content
            at = end


def _parsed(content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    number = lambda v: int(v) if v and v.lstrip("-").isdigit() else None
    page = lambda v: number(v.removeprefix("<urn:page:").removesuffix(">"))
    length = int(fields.get("content-length") or 0)
    return {
        "record_type": fields.get("warc-type"),
        "id": page(fields.get("warc-record-id", "")),
        "url": unquote(fields["warc-target-uri"]) if fields.get("warc-target-uri") else None,
        "payload": rest[:length],
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "length": number(fields.get("x-payload-length")),
        "refers_to": page(fields.get("warc-refers-to", "")),
    }


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, split_bytes: int = 1 << 26) -> DataFrame:
    """The records of all archives in a manifest, each read by the task in whose range it starts."""
    ends = F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {split_bytes}L)")
    ranges = manifest.where("bytes > 0").select("file", "bytes", F.explode(ends).alias("start"))
    counted = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0]
    tasks = max(1, min(int(counted or 1), 100_000))

    def read(batches):
        from pyarrow import fs as files

        system, _ = files.FileSystem.from_uri(folder)
        names = ["record_type", "id", "url", "payload", "digest", "length", "refers_to"]
        types = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), *zip(names, types)])
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(row["file"]) as file:
                    held, weight = [], 0
                    part = Range(file, row["bytes"], row["start"], min(row["bytes"], row["start"] + split_bytes))
                    for at, content in part.members():
                        held.append({"file": row["file"], "start": at, **_parsed(content)})
                        weight += len(content)
                        if weight > BLOCK:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, weight = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return ranges.repartition(tasks, "file", "start").mapInArrow(read, RECORDS)


def digests(records: DataFrame) -> DataFrame:
    """Per record read: id, bytes and SHA-256 of the full payload, record type, id referred to."""
    revisit = F.col("record_type") == "revisit"
    return records.select(
        F.col("id").alias("page_id"),
        F.when(revisit, F.col("length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
