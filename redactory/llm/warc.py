"""Dictionary-compressed WARC archives (.warc.zst).

An archive is a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary built from the archive's own
records, and then one Zstandard frame a record, so that each record can be read by itself. Archives are rows of a
Parquet table (name, content): Spark's writers and readers reach every store; export() hands each out in the task
that reads it. An archive opens with a warcinfo record.

Equal payloads of at least 100 bytes are stored once: the record with the smallest id is the response, others are
revisit records that refer to it. Dictionaries are trained on the first 128 KB of records, which bounds the memory of
training; records are stored whole.

Cases: a null payload is empty; a null URL leaves WARC-Target-URI out; a null id is kept as null: its record revisits
an equal payload that has an id, and is a response where none has. Payloads may be of any length (one record is one
frame, streamed through memory). Each row is one record: an id may come with several payloads, which are linked
each by itself; rows of one id and one payload cannot be told apart and are responses or revisits together. An empty
table gives no archives. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import kept, shared_path, skew_join

MAGIC = b"\x5d\x2a\x4d\x18"
DATE = "2024-01-01T00:00:00Z"
ARCHIVES = "name string, content binary"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; revisit where refers_to is given, its block then is the HTTP head alone."""
    kind = "response" if refers_to is None else "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}:{digest}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info() -> bytes:
    """The record that opens an archive."""
    block = b"software: redactory\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:info:none:{hashlib.sha256(block).hexdigest()}>", f"WARC-Date: {DATE}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The fields of RECORDS from one record's bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: None if name not in fields or (at := fields[name].split(":")[2]) == "none" else int(at)
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "payload_bytes": length, "payload_digest": fields["WARC-Payload-Digest"].partition(":")[2], "payload": payload if fields["WARC-Type"] == "response" else None}


def pack(records: list[bytes], level: int = 3, dict_bytes: int = 64 << 10, sample_bytes: int = 4 << 20) -> bytes:
    """An archive of these records. The dictionary is built from evenly spaced records of sample_bytes in all,
    and left out where there are too few to build one from."""
    step = max(1, -(-sum(map(len, records)) // sample_bytes))
    lead, extra = b"", {}
    try:
        shared = zstd.train_dictionary(dict_bytes, [r[: 128 << 10] for r in records[::step]])
    except zstd.ZstdError:
        pass
    else:
        body = zstd.ZstdCompressor(level=19).compress(shared.as_bytes())  # the frame may hold it compressed
        lead, extra = MAGIC + struct.pack("<I", len(body)) + body, {"dict_data": shared}
    if extra:
        extra["dict_data"].precompute_compress(level=level)
    one = zstd.ZstdCompressor(level=level, write_checksum=True, **extra)
    return lead + b"".join(one.compress(r) for r in records)


def unpack(content: bytes) -> Iterator[bytes]:
    """The records of an archive."""
    at, extra = 0, {}
    if content[:4] == MAGIC:
        (n,) = struct.unpack("<I", content[4:8])
        body, at = content[8 : 8 + n], 8 + n
        if body[:4] == b"\x28\xb5\x2f\xfd":
            body = zstd.ZstdDecompressor().decompress(body)
        extra = {"dict_data": zstd.ZstdCompressionDict(body)}
    one = zstd.ZstdDecompressor(**extra)
    view = memoryview(content)
    while at < len(content):
        step = one.decompressobj()
        parts = []
        while not step.eof:  # in pieces, so that a frame's end is found without reading the whole rest
            part = view[at : at + (64 << 10)]
            if not len(part):
                raise ValueError("the archive ends within a frame")
            parts.append(step.decompress(part))
            at += len(part)
        at -= len(step.unused_data)
        yield b"".join(parts)


def linked(pages: DataFrame, id_col: str, url_col: str, body_col: str, least: int) -> DataFrame:
    """page_id, url, payload, digest, refers_to: the smallest page_id of an equal payload, null for a response. Each row
    is one record: links go by digest and page_id together, as a page_id may come with several payloads."""
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    df = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"))
    keys = kept(df.select("page_id", F.unhex(F.sha2("payload", 256)).alias("digest"), F.octet_length("payload").alias("n")).filter(F.col("n") >= least))
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("size")).filter("size > 1 AND first_id IS NOT NULL")
    again = skew_join(keys.select("page_id", "digest"), kept(firsts), "digest", "size").filter("page_id > first_id OR page_id IS NULL")
    again = kept(again.select("page_id", "digest", F.col("first_id").alias("refers_to")).distinct())
    # of a null page_id there is one row here a digest, so both parts of the key spread the rows
    df = df.withColumn("_digest", F.unhex(F.sha2("payload", 256)))
    out = df.join(again.select(F.col("page_id").alias("_id"), F.col("digest").alias("_key"), "refers_to").hint("merge"), F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_key")), "left")
    return out.select("page_id", "url", "payload", F.lower(F.hex("_digest")).alias("digest"), "refers_to")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 100, archive_bytes: int = 8 << 20) -> str:
    """Writes every row of pages into archives of about archive_bytes (before compression) in the table at path."""

    def archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            content = pack([info(), *held])
            name = hashlib.sha256(content).hexdigest()[:32] + ".warc.zst"
            held.clear()
            return pa.RecordBatch.from_pydict({"name": [name], "content": [content]}, pa.schema([("name", pa.string()), ("content", pa.binary())]))

        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                held.append(record(*(c[i].as_py() for c in cols)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    linked(pages, id_col, url_col, body_col, least).mapInArrow(archives, ARCHIVES).write.parquet(path)
    return path


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS of a table of archives. Without payloads, payload is null; digests of stored ones are still verified."""

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                for raw in unpack(content.as_py()):
                    if raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n"):
                        continue
                    row = parsed(raw)
                    if row["payload"] is not None and (hashlib.sha256(row["payload"]).hexdigest() != row["payload_digest"] or len(row["payload"]) != row["payload_bytes"]):
                        raise ValueError(f"record of page {row['page_id']}: the payload does not match its digest")
                    size += len(raw)
                    out.append(row if payloads else row | {"payload": None})
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return archives.mapInArrow(records, RECORDS)


def export(archives: DataFrame, write) -> None:
    """Hands each archive to write(name, content) in the task that reads it; write must reach the store by itself and
    may be called again with the same name and content where a task is repeated."""

    def out(rows) -> None:
        for row in rows:
            write(row["name"], bytes(row["content"]))

    archives.select("name", "content").foreachPartition(out)


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Archives pages and reads the archives back: RECORDS without the payloads."""
    spark = pages.sparkSession
    path = write_archives(pages, shared_path(spark, "warc"), id_col, url_col, body_col)
    return read_archives(spark.read.schema(ARCHIVES).parquet(path), payloads=False)
