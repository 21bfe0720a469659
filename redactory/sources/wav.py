"""WAV files by blocks of frames: a source that reads parts of files, and a sink that writes whole ones block by block.

A block is what lies in a stretch of block_bytes of a file's samples, so which frames a block has follows from its number
and the file's header. Partitions are planned from the listing alone; headers are read by the tasks. No task holds more than
a block of a file, however long the file is."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition

from ..functions.text import stem
from .trees import Written, opened

BLOCK_BYTES = 1 << 20
#: Bytes of files that a partition reads.
PARTITION_BYTES = 64 << 20
BLOCKS = "key string, block long, first_frame long, frames long, rate int, channels int, width int, pcm binary, error string"
KIND = pa.schema([("key", pa.string()), ("block", pa.int64()), ("first_frame", pa.int64()), ("frames", pa.int64()), ("rate", pa.int32()), ("channels", pa.int32()), ("width", pa.int32()), ("pcm", pa.binary()), ("error", pa.string())])


@dataclass
class Header:
    rate: int
    channels: int
    width: int
    start: int
    frames: int

    @property
    def frame_bytes(self) -> int:
        return self.channels * self.width


def header(f, size: int) -> Header:
    """The header of an open file of that size; ValueError where it is no WAV file of whole samples."""
    if f.read(4) != b"RIFF" or len(f.read(4)) < 4 or f.read(4) != b"WAVE":
        raise ValueError("not a WAV file")
    kind = None
    while len(head := f.read(8)) == 8:
        name, length = struct.unpack("<4sL", head)
        if name == b"fmt ":
            body = f.read(length + length % 2)
            if len(body) < 16:
                raise ValueError("broken WAV header")
            kind = struct.unpack("<HHLLHH", body[:16])
        elif name == b"data":
            if kind is None or kind[0] not in (1, 0xFFFE) or not kind[1] or kind[5] not in (8, 16, 24, 32):
                raise ValueError("only WAV of 8, 16, 24 or 32 bit samples can be read")
            start, each = f.tell(), kind[1] * (kind[5] // 8)
            return Header(kind[2], kind[1], kind[5] // 8, start, min(length, size - start) // each)
        else:
            f.seek(f.tell() + length + length % 2)
    raise ValueError("WAV file without samples")


def first_frame(block: int, block_bytes: int, frame_bytes: int) -> int:
    return -(-block * block_bytes // frame_bytes)


@dataclass
class Part(InputPartition):
    """(path, size, first block, last block + 1) of what a task reads."""

    pieces: list


class WavReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.block_bytes = options["path"], int(options.get("block_bytes", BLOCK_BYTES))
        self.heads = options.get("heads", "false").lower() == "true"

    def partitions(self) -> list[Part]:
        from pyarrow import fs as pafs

        fs, base = opened(self.path)
        found = fs.get_file_info(base)
        if found.type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"not found: {self.path}")
        files = [found] if found.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(base, recursive=True))
        files = sorted((i.path, i.size) for i in files if i.type == pafs.FileType.File and i.path.lower().endswith(".wav"))
        parts, held, bytes_ = [], [], 0
        each = max(1, PARTITION_BYTES // self.block_bytes)
        for path, size in files:
            blocks = 1 if self.heads else max(1, -(-size // self.block_bytes))
            for lo in range(0, blocks, each):
                hi = min(blocks, lo + each)
                held.append((path, size, lo, hi))
                bytes_ += 4096 if self.heads else min(size, (hi - lo) * self.block_bytes)
                if bytes_ >= PARTITION_BYTES:
                    parts.append(Part(held))
                    held, bytes_ = [], 0
        return [*parts, Part(held)] if held or not parts else parts

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        for path, size, lo, hi in part.pieces:
            try:
                with fs.open_input_file(path) as f:
                    h = header(f, size)
                    for k in range(lo, hi):
                        a, b = (min(h.frames, first_frame(x, self.block_bytes, h.frame_bytes)) for x in (k, k + 1))
                        if self.heads or k == 0 or b > a:
                            pcm = None
                            if not self.heads:
                                f.seek(h.start + a * h.frame_bytes)
                                pcm = f.read((b - a) * h.frame_bytes)
                            yield self.row(path, k, a, h.frames, h.rate, h.channels, h.width, pcm, None)
            except (OSError, ValueError, struct.error) as e:  # a bad file is a row with an error, not a failed job
                if lo == 0:
                    yield self.row(path, 0, 0, None, None, None, None, None, str(e) or type(e).__name__)

    @staticmethod
    def row(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, KIND, strict=True)], schema=KIND)


class WavBlocks(DataSource):
    """Options: path (a file, or a folder that is searched to its depth), block_bytes, and heads, for one row a file
    without its samples."""

    @classmethod
    def name(cls) -> str:
        return "wav_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> WavReader:
        return WavReader(dict(self.options))


class WavFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Blocks (name, rate, frames, block, pcm) of one file follow one another in a partition."""
        fs, base = opened(self.path)
        fs.create_dir(base, recursive=True)
        now, out, draft, n = None, None, None, 0

        def close() -> None:
            nonlocal out, n
            if out is not None:
                out.close()
                fs.move(draft, f"{base}/{now}")
                out, n = None, n + 1

        try:
            for b in batches:
                for name, rate, frames, pcm in zip(b["name"].to_pylist(), b["rate"].to_pylist(), b["frames"].to_pylist(), b["pcm"], strict=True):
                    if name != now:
                        close()
                        now, draft = name, f"{base}/.{name}-{uuid.uuid4().hex}"
                        out = fs.open_output_stream(draft)
                        out.write(wav_header(rate, frames))
                    out.write(pcm.as_buffer())
            close()
        finally:
            if out is not None:
                out.close()
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = opened(self.path)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/_SUCCESS") as out:
            out.write(str(sum(m.files for m in messages if m)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files that were moved to their names are whole and stay."""


class WavFiles(DataSource):
    """Writes blocks as mono WAV files of 16 bits below the option path."""

    @classmethod
    def name(cls) -> str:
        return "wav_files"

    def writer(self, schema, overwrite: bool) -> WavFilesWriter:
        return WavFilesWriter(self.options["path"])


def wav_header(rate: int, frames: int) -> bytes:
    size = 2 * frames
    if size + 36 >= 1 << 32:
        raise ValueError("a WAV file holds less than 4 GiB of samples")
    return struct.pack("<4sL4s4sLHHLLHH4sL", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, 1, 1, rate, rate * 2, 2, 16, b"data", size)


def wav_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, heads: bool = False) -> DataFrame:
    """BLOCKS and id, the file's stem, of the WAV files of a folder, or of one file."""
    spark.dataSource.register(WavBlocks)
    df = spark.read.format("wav_blocks").option("path", path).option("block_bytes", block_bytes).option("heads", heads).load()
    return df.withColumn("id", stem(F.col("key")))


def write_wav(masked: DataFrame, path: str) -> None:
    """Writes masked blocks (operators.audio.mask_blocks) as files below path."""
    masked.sparkSession.dataSource.register(WavFiles)
    masked.select("name", "rate", "frames", "pcm").write.format("wav_files").option("path", path).mode("append").save()
