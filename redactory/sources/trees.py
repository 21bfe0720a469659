"""Files for other tools: one a row, named by the row, and large JSON files put together from ordered parts.

A file a row is written by the task that has the row, under another name first, and moved to its own when it is whole. So a
reader sees whole files only, and a task that is repeated after a lost executor replaces its files with the same ones.
What reaches the driver is a number a task."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators import report
from ..operators.verify import STATUSES

CHUNK = 1 << 16


def opened(path: str):
    """(file system, path on it) of a path or URI that pyarrow knows."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    files: int


class KeyedFiles(DataSource):
    """Writes rows (name, body) as files below the option path; a name may hold folders. Files of other names stay, and
    _SUCCESS tells that all of a job's files are there, and how many."""

    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def writer(self, schema, overwrite: bool) -> KeyedFilesWriter:
        return KeyedFilesWriter(self.options["path"])


class KeyedFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, base = opened(self.path)
        made, n = set(), 0
        for b in batches:
            for name, body in zip(b["name"].to_pylist(), b["body"], strict=True):
                body = body.as_py()
                target = f"{base}/{name}"
                folder = target.rpartition("/")[0]
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                # a name that begins with a dot is no file of the tree to readers
                draft = f"{folder}/.{target.rpartition('/')[2]}-{uuid.uuid4().hex}"
                with fs.open_output_stream(draft) as out:
                    out.write(body.encode() if isinstance(body, str) else bytes(body or b""))
                fs.move(draft, target)
                n += 1
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = opened(self.path)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/_SUCCESS") as out:
            out.write(str(sum(m.files for m in messages if m)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """What was moved to its name is whole and stays until it is written again."""


def write_files(files: DataFrame, path: str) -> None:
    """One file a row of files (name, body string or binary) below path."""
    files.sparkSession.dataSource.register(KeyedFiles)
    files.select("name", "body").write.format("keyed_files").option("path", path).mode("append").save()


def file_names(rows: DataFrame, suffix: str) -> DataFrame:
    """rows (key, conversation_id, ...) with name: the conversation's id; where several keys share it, or there is
    none, with a tag of the key."""
    plain = F.regexp_replace("conversation_id", r"[/\\\x00]|^\.", "_")
    rows = rows.withColumn("_plain", F.when(plain != "", plain))
    shared = rows.groupBy("_plain").agg(F.count("*").alias("_n")).filter("_n > 1 AND _plain IS NOT NULL")
    tag = F.substring(F.sha2("key", 256), 1, 12)
    name = F.when(F.col("_plain").isNull(), F.concat(F.lit("conversation-"), tag)).when(F.col("_n") > 1, F.concat_ws("~", "_plain", tag)).otherwise(F.col("_plain"))
    return rows.join(shared, "_plain", "left").withColumn("name", F.concat(name, F.lit(suffix))).drop("_plain", "_n")


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_objects(rows: DataFrame, path: str) -> None:
    """One JSON object a row of rows (key, conversation_id, ...), without the key, below path."""
    fields = [c for c in rows.columns if c != "key"]
    write_files(file_names(rows.withColumn("body", as_json(*fields)).select("key", "conversation_id", "body"), ".json"), path)


def lines(rows: DataFrame, value: Column, order: list[str], path: str) -> Iterator[bytes]:
    """The values of rows in order, separated by commas, read back in pieces from parts below path that tasks wrote. Rows are
    sorted by ranges, so parts follow one another; no task and no driver holds more than its part or a piece."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(value.alias("value")).write.text(path)
    from pyarrow import fs as pafs

    fs, base = opened(path)
    parts = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.path.rpartition("/")[2].startswith("part-") and i.size)
    held = b""  # the last line's end is held back until it is known whether another follows
    for part in parts:
        with fs.open_input_stream(part) as f:
            while piece := f.read(CHUNK):
                piece = held + bytes(piece)
                held = b"\n" if piece.endswith(b"\n") else b""
                yield piece[: len(piece) - len(held)].replace(b"\n", b",\n")


def _put(path: str, pieces: Iterable[bytes | Iterator[bytes]]) -> None:
    """Writes a file under another name and moves it when it is whole."""
    fs, target = opened(path)
    folder, _, name = target.rpartition("/")
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        for piece in pieces:
            for x in [piece] if isinstance(piece, bytes) else piece:
                out.write(x)
    fs.move(draft, target)


def _dropped(path: str) -> None:
    fs, base = opened(path)
    fs.delete_dir(base)


def write_array(rows: DataFrame, path: str, order: list[str]) -> None:
    """rows as one JSON array in a file."""
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    _put(path, [b"[\n", lines(rows, as_json(*rows.columns), order, parts), b"\n]\n"])
    _dropped(parts)


def write_with_totals(totals: dict, name: str, rows: DataFrame, path: str, order: list[str]) -> None:
    """totals as one JSON object in a file, with all rows in a list of that name."""
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    _put(path, [json.dumps(totals)[:-1].encode(), f',\n"{name}": [\n'.encode(), lines(rows, as_json(*rows.columns), order, parts), b"\n]}\n"])
    _dropped(parts)


def write_report(results: DataFrame, path: str, timestamp: str) -> None:
    """The report of a batch as one JSON object: totals, statuses, every failure, and every processing time by id, of rows
    that share an id the last one's by key. The lists are streamed from ordered parts."""
    if "key" not in results.columns:
        results = results.withColumn("key", F.lit(None).cast("string"))
    status = [F.count_if(F.col("success") & (F.col("status") == s)).alias(s) for s in STATUSES]
    head = {"timestamp": timestamp, "summary": report.summary(results).first().asDict(), "verification_status": results.agg(*status).first().asDict()}
    last = F.max_by("processing_time_s", F.struct("key", "processing_time_s")).alias("s")
    times = results.groupBy(F.coalesce("conversation_id", F.lit("")).alias("id")).agg(last)
    entry = F.concat(F.expr("substring(to_json(array(id)), 2, length(to_json(array(id))) - 2)"), F.lit(": "), F.coalesce(F.col("s").cast("string"), F.lit("null")))
    tag = uuid.uuid4().hex
    failed, spent = f"{path}.failures-{tag}", f"{path}.times-{tag}"
    _put(path, [json.dumps(head)[:-1].encode(), b',\n"failures": [\n', lines(report.failures(results), as_json("conversation_id", "stage", "error"), ["conversation_id", "stage", "error"], failed),
                b'\n],\n"processing_times": {\n', lines(times, entry, ["id"], spent), b"\n}}\n"])
    _dropped(failed), _dropped(spent)
