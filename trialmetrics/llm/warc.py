"""WARC archives: a deterministic sharded writer and a reader.

Shards are ranges of (id, payload digest), so an id that many records share is spread like any others. Splitters are drawn by a
hash of the two, so the same records give the same shards, files and bytes whatever
their order, partitioning and number of tasks. A task sorts one shard and writes it file by file under
temporary names that carry the attempt; files roll by compressed size. Only the attempts whose manifest rows
come back through Spark count: their files get their final names, and the manifest, written last, commits.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trialmetrics.llm.common import fresh, numbered, stored

MANIFEST = "shard int, number int, file string, temporary string, records long, bytes long, sha256 string"
RECORDS = "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_SHARDS, DRAWN = 10_000, 100
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-records")


def _place() -> Column:
    """Text that sorts as id, null first, and the beginning of the digest."""
    shifted = F.lpad(F.hex(F.col("key").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.coalesce(F.concat(F.lit("1"), shifted), F.lit("0")), F.substring("digest", 1, 16))


def _splitters(rows: DataFrame, shard_bytes: int) -> list[str]:
    """First places of all shards but the first. At most MAX_SHARDS * DRAWN places, in expectation, reach the driver."""
    found = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    shards = min(MAX_SHARDS, -(-found["bytes"] // shard_bytes) or 1)
    if shards < 2:
        return []
    every = max(1, found["rows"] // (shards * DRAWN))
    drawn = rows.filter(F.pmod(F.xxhash64("place"), F.lit(every)) == 0)
    # A drawn place stands for itself, however many rows share it.
    found = drawn.groupBy("place").agg(F.sum("bytes").alias("bytes")).toPandas().sort_values("place")
    upto = found["bytes"].cumsum().to_numpy()
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards) if len(found) else []
    return sorted({found["place"].iloc[i] for i in cuts})


def write_warc(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", revisit_from: int = 100,
    shard_bytes: int = 32 << 20, file_bytes: int = 256 << 20, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for each row and return the manifest of the committed files.

    Of the records with equal payloads of at least ``revisit_from`` bytes the one with the smallest id (null last, then
    the smallest url) is a response and the others revisit it; all smaller ones are responses. Of repeated rows one is the response.
    A null payload is empty, a null url is written as about:blank, a record without id has no id line.
    Rows of equal id and payload are in one shard, which rolls into as many files as they need and holds one payload at a time. An empty
    table gives an empty manifest; other columns are not looked at. ``date`` is the date of all records, since
    a clock would make the bytes differ. ``folder`` has to be new and open to all executors.
    """
    row = fresh(pages, "row")
    content = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    records = numbered(pages, row).select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), content.alias("payload"),
        F.octet_length(content).cast("long").alias("bytes"), F.sha2(content, 256).alias("digest"), F.col(row).alias("row"))
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "url", "row")
    light = records.filter(F.col("bytes") >= revisit_from).drop("payload")
    copies = light.groupBy("digest").agg(F.min(order).alias("of"), F.count("*").alias("n")).filter("n > 1")
    cuts = _splitters(records.select(_place().alias("place"), "bytes"), shard_bytes)

    @F.pandas_udf("int")
    def shard_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, object), places.to_numpy(object), "right").astype(np.int32))

    # A copy is marked by a row of its own, which the sort puts right before the record: the join is of ids and
    # digests, and a payload is shuffled once.
    marks = light.join(copies, "digest").filter(F.col("row") != F.col("of.row")).select(
        "key", "url", "digest", "row", F.col("of.key").alias("refers_to"), F.col("of.url").alias("refers_url"),
        F.lit(True).alias("mark"))
    both = records.withColumn("mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    dealt = both.withColumn("shard", shard_of(_place())).repartitionById(
        len(cuts) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_last("key"), "digest", "url", "row", F.desc("mark"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, marked, context = None, {"row": None}, TaskContext.get()
        for batch in batches:
            for values in _rows(batch):
                if values["mark"]:
                    marked = values
                    continue
                if writer is None or writer.shard != values["shard"]:
                    yield from writer.close() if writer else ()
                    writer = _Writer(folder, values["shard"], f"{context.stageId()}-{context.taskAttemptId()}", file_bytes, date)
                yield from writer.add(values, marked if marked["row"] == values["row"] else None)
        yield from writer.close() if writer else ()

    manifest = stored(dealt.mapInArrow(write, MANIFEST), "warc-written")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.to_pylist():
                if system.get_file_info(f"{root}/{file['temporary']}").type == fs.FileType.File:
                    system.move(f"{root}/{file['temporary']}", f"{root}/{file['file']}")
                if system.get_file_info(f"{root}/{file['file']}").size != file["bytes"]:
                    raise OSError(f"{file['file']} is not what was written")
            yield batch

    # Names are moved by tasks; a task that runs again finds its moves done. The manifest commits.
    manifest.mapInArrow(rename, MANIFEST).drop("temporary").write.parquet(f"{folder}/_manifest")
    system, root = fs.FileSystem.from_uri(folder)
    if system.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
        system.delete_dir(f"{root}/_temporary")
    return pages.sparkSession.read.parquet(f"{folder}/_manifest")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time, so that one payload is held besides the batch."""
    names = batch.schema.names
    for i in range(len(batch)):
        yield {name: column[i].as_py() for name, column in zip(names, batch.columns)}


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{key}:{digest}')}>"


def _header(version: bytes, fields: list[tuple[str, str | None]]) -> bytes:
    lines = [f"{name}: {value}".encode() for name, value in fields if value is not None]
    return b"\r\n".join([version, *lines, b"", b""])


def _address(url: str | None) -> str:
    """An address fit for a header line: white space and control characters are escaped."""
    return re.sub(r"[\x00-\x20\x7f-\x9f\u2028\u2029]", lambda m: quote(m[0]), url) if url else "about:blank"


class _Writer:
    def __init__(self, folder: str, shard: int, attempt: str, file_bytes: int, date: str):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.limit, self.date = shard, attempt, file_bytes, date
        self.number, self.out = 0, None
        self.system.create_dir(f"{self.root}/_temporary", recursive=True)

    def add(self, row: dict, revisit: dict | None) -> Iterator[pa.RecordBatch]:
        """Write a record, or if it is a copy only what it revisits."""
        if self.out is not None and self.size >= self.limit:
            yield from self.close()
        if self.out is None:
            self._open()
        payload, digest = row["payload"] or b"", row["digest"]
        http = _header(b"HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(row["bytes"]))])
        block = http if revisit else http + payload
        fields = [
            ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(row["key"], digest)),
            ("WARC-Date", self.date), ("WARC-Target-URI", _address(row["url"])), ("X-Record-Key", _text(row["key"])),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
        if revisit:
            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(revisit["refers_to"], digest)),
                       ("WARC-Refers-To-Target-URI", _address(revisit["refers_url"])), ("WARC-Refers-To-Date", self.date),
                       ("X-Refers-To-Key", _text(revisit["refers_to"]))]
        self._put([*fields, ("Content-Type", "application/http;msgtype=response")], block)
        self.records += 1

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([self.shard], pa.int32()), "number": pa.array([self.number], pa.int32()), "file": [self.file],
                "temporary": [self.temporary], "records": [self.records], "bytes": [self.size], "sha256": [self.sum.hexdigest()]})
            self.number += 1

    def _open(self) -> None:
        self.file = f"shard-{self.shard:05d}-{self.number:05d}.warc.gz"
        self.temporary = f"_temporary/{self.file}.{self.attempt}"
        self.out, self.size, self.records = self.system.open_output_stream(f"{self.root}/{self.temporary}", compression=None), 0, 0
        self.sum = hashlib.sha256()
        self._put([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.file)), ("WARC-Date", self.date),
                   ("WARC-Filename", self.file), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    def _put(self, fields: list, block: bytes) -> None:
        """A record as a gzip member of its own, with no time in it."""
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        head = _header(b"WARC/1.1", [*fields, ("Content-Length", str(len(block)))])
        member = squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)


def _text(value) -> str | None:
    return None if value is None else str(value)


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the committed files: key, url, record_type, payload_bytes, payload_digest, refers_to and, if asked
    for, payload (null for revisits). Lengths and digests are checked against the contents; a record that
    fails stops the job. Files are read in pieces, records one at a time."""
    manifest = spark.read.parquet(f"{folder}/_manifest").select("file")
    schema = T.StructType.fromDDL(RECORDS + (", payload binary" if payloads else ""))
    names = [f.name for f in schema]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for record in _records(stream):
                        rows.append(record[:len(names)])
                        held += len(record[-1] or b"") if payloads else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, schema)


def _members(stream) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one after the other."""
    data, unzip, parts = b"", None, []
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                if unzip is not None:
                    raise EOFError("the last record is cut short")
                return
        unzip = unzip or zlib.decompressobj(31)
        parts.append(unzip.decompress(data))
        data = unzip.unused_data
        if unzip.eof:
            yield b"".join(parts)
            unzip, parts = None, []


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines if line)}


def _records(stream) -> Iterator[tuple]:
    for member in _members(stream):
        head, _, rest = member.partition(b"\r\n\r\n")
        fields = _fields(head)
        block = rest[:int(fields["content-length"])]
        if rest[len(block):] != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
            raise ValueError(f"record {fields['warc-record-id']} has another length")
        if fields["warc-type"] == "warcinfo":
            continue
        if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"record {fields['warc-record-id']} has another digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
        whole = fields["warc-type"] == "response"
        if whole and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
        key, to = fields.get("x-record-key"), fields.get("x-refers-to-key")
        yield (key and int(key), fields["warc-target-uri"], fields["warc-type"], size, digest, to and int(to),
               payload if whole else None)
