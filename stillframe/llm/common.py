"""Shared plumbing: tables, the shared scratch folder, Arrow mapping and the workers' memory."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text handed to Python at a time are cut into pieces of about so many characters.
PIECE_CHARS = 2_000_000
#: Rows of a batch that are made Python objects at a time.
ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset (tests in
    local mode) a temporary folder of the driver is set in its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stillframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


class Scratch:
    """Tables written to the shared folder, to cut lineage and to be read more than once."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}
        atexit.register(self.drop)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a table and return it as read back."""
        path, self.count = f"{self.root}/{self.count}", self.count + 1
        df.write.parquet(path)
        # lets Spark's cleaner drop the shuffle files that only this table needed
        self.spark.sparkContext._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def forget(self, kept: DataFrame) -> None:
        """Delete a table that nothing needs any more."""
        self._delete(self.paths.pop(id(kept)))

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter
            pass


_remembered: dict[str, Any] = {}


def remembered(name: str, make: Callable[[], Any], fits: Callable[[Any], bool] = lambda _: True) -> Any:
    """What this Python worker remembers from task to task under a name, made anew where that does not fit.

    Workers go on from one operator to the next, so what was remembered under
    other names, or does not fit, is dropped first.
    """
    if name not in _remembered or not fits(_remembered[name]):
        _remembered.clear()
        _remembered[name] = make()
    return _remembered[name]


def give_back() -> None:
    """Return memory that is free to the system; else it stays with the worker, idle or not."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives back what is free."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def map_rows(df: DataFrame, columns: list[str], schema: str, rows: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """Apply a generator over tuples of ``columns`` to each partition, through Arrow, in bounded batches."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    yield from zip(*(c.to_pylist() for c in whole.slice(at, ROWS).columns))

        held: list[tuple] = []
        size = 0
        for row in rows(source()):
            held.append(row)
            size += 64 + sum(len(x) for x in row if hasattr(x, "__len__"))
            if len(held) >= 20_000 or size >= PIECE_CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)

    return df.select(*columns).mapInArrow(tidied(run), schema)


def with_rows(docs: DataFrame, id_col: str, name: str, scratch: Scratch) -> DataFrame:
    """``docs`` with a column ``name`` that numbers its rows: the id where that is a whole number, given and unique.

    Else the table is written with numbers first, so that they stay the same.
    """
    if docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        if docs.groupBy(id_col).count().where(F.col("count") > 1).isEmpty() and docs.where(F.col(id_col).isNull()).isEmpty():
            return docs.withColumn(name, F.col(id_col).cast("long"))
    return scratch.keep(docs.withColumn(name, F.monotonically_increasing_id()))
