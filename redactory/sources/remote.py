"""Files of a remote listing: listed by pages, fetched with retries, failures as rows.

A store is given as "module:function", which makes an object with pages() -> list of page tokens, page(token) -> names in
order, and fetch(name) -> bytes. Tasks make it for themselves, so nothing of it is sent around."""

from __future__ import annotations

import importlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import to_fetch
from .trees import opened

LISTED = pa.schema([("page", pa.int64()), ("place", pa.int64()), ("name", pa.string()), ("error", pa.string())])


def store(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)()


def tried(act: Callable, retries: int, wait: float) -> tuple:
    """(result, error, attempts): act is tried again after a pause that doubles, retries times at most."""
    for k in range(retries + 1):
        try:
            return act(), None, k + 1
        except Exception as e:  # a page or a file that fails is a row
            error = str(e) or type(e).__name__
            if k < retries:
                time.sleep(wait * 2**k)
    return None, error, retries + 1


@dataclass
class Page(InputPartition):
    number: int
    token: object


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.store, self.retries, self.wait = options["store"], int(options.get("retries", 3)), float(options.get("wait", 0.5))

    def partitions(self) -> list[Page]:
        return [Page(k, t) for k, t in enumerate(store(self.store).pages())] or [Page(-1, None)]

    def read(self, page: Page) -> Iterator[pa.RecordBatch]:
        if page.number < 0:
            return
        names, error, _ = tried(lambda: list(store(self.store).page(page.token)), self.retries, self.wait)
        rows = [(page.number, 0, None, error)] if error is not None else [(page.number, k, n, None) for k, n in enumerate(names)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, LISTED, strict=True)], schema=LISTED)


class Listing(DataSource):
    """Options: store, retries, wait (seconds before the first retry). A page a partition."""

    @classmethod
    def name(cls) -> str:
        return "remote_listing"

    def schema(self) -> str:
        return "page long, place long, name string, error string"

    def reader(self, schema) -> ListingReader:
        return ListingReader(dict(self.options))


def listing(spark: SparkSession, store_name: str, retries: int = 3, wait: float = 0.5) -> DataFrame:
    """(ordinal, name, error): the names in the listing's order; a page that could not be read is a row with an error."""
    spark.dataSource.register(Listing)
    df = spark.read.format("remote_listing").option("store", store_name).option("retries", retries).option("wait", wait).load()
    return df.select(F.struct("page", "place").alias("ordinal"), "name", "error")


def present(spark: SparkSession, path: str) -> DataFrame:
    """(file): the names of files directly below path; none where there is no such folder. Their content is not read."""
    try:
        found = spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"))


def fetched(files: DataFrame, store_name: str, path: str, retries: int = 3, wait: float = 0.5) -> DataFrame:
    """(name, file, bytes, attempts, error) of files (name), each written below path under its last part when it is whole.
    Fetching happens where the rows are computed: write or persist them."""

    def run(batches: Iterator) -> Iterator:
        remote, (fs, base) = store(store_name), opened(path)
        fs.create_dir(base, recursive=True)

        def one(name: str, file: str) -> int:
            body = remote.fetch(name)
            draft = f"{base}/.{file}-{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as out:
                out.write(body)
            fs.move(draft, f"{base}/{file}")
            return len(body)

        for b in batches:
            rows = [(n, f, *tried(lambda n=n, f=f: one(n, f), retries, wait)) for n, f in zip(b["name"].to_pylist(), b["file"].to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32())
            name, file, size, error, attempts = (pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))
            yield pa.RecordBatch.from_arrays([name, file, size, attempts, error], ["name", "file", "bytes", "attempts", "error"])

    return files.select("name", F.element_at(F.split("name", "/"), -1).alias("file")).mapInArrow(run, "name string, file string, bytes long, attempts int, error string")


def fetch_missing(spark: SparkSession, store_name: str, path: str, suffix: str = ".wav", contains: str = "", most: int = 50, skip_present: bool = True, retries: int = 3, wait: float = 0.5) -> DataFrame:
    """fetched() of the first `most` names of the listing that fit, less those whose file is below path already, and a row
    with an error for each page that could not be listed; computed once."""
    listed = listing(spark, store_name, retries, wait).persist()
    names = listed.filter("error IS NULL").select("ordinal", "name", F.element_at(F.split("name", "/"), -1).alias("file"))
    have = present(spark, path) if skip_present else spark.createDataFrame([], "file string")
    have = names.join(have, "file", "left_semi").select("name")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = fetched(to_fetch(names.select("ordinal", "name"), have, suffix, contains, most).repartition(n, "name"), store_name, path, retries, wait)
    none = lambda kind: F.lit(None).cast(kind)
    lost = listed.filter("error IS NOT NULL").select(none("string").alias("name"), none("string").alias("file"), none("long").alias("bytes"), none("int").alias("attempts"), "error")
    return got.unionByName(lost).persist()
