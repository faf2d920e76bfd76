"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"

#: Rows and bytes that go to a Python worker at once: rows of short texts, bytes of long ones.
ARROW_ROWS = 512
ARROW_BYTES = 16 << 20


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Small Arrow batches bound the memory of Python workers; a batch of long texts ends sooner, a text of its own size at the latest."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def map_texts(rows: DataFrame, added: str, begin: Callable[[], Callable[[list[str]], dict]]) -> DataFrame:
    """`rows` with its column `text` replaced by the columns `added` (as DDL).

    Each task calls `begin` once; what it returns takes the texts of a batch to
    the values of the new columns (Arrow arrays or what makes them). Other
    columns pass through Arrow untouched, so that nulls don't turn ids into floats.
    """
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType([*kept, *StructType.fromDDL(added).fields])
    types = to_arrow_schema(schema)
    new = types.names[len(kept) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = begin()
        for batch in batches:
            found = work(batch.column("text").to_pylist())
            made = [x if isinstance(x := found[n], pa.Array) else pa.array(x, types.field(n).type) for n in new]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *made], names=types.names)

    return rows.mapInArrow(run, schema)


HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
HASH_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Items that are hashed or gathered at once.
GATHERED = 1 << 20
#: Bytes whose running sums are taken at once: they stay in a core's cache.
SUMMED = 1 << 15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of HASH_BASE and of its inverse."""
    up, down = np.full(n, HASH_BASE), np.full(n, np.uint64(pow(int(HASH_BASE), -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up, out=up), np.multiply.accumulate(down, out=down)


@functools.cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(SUMMED)


def span_keys(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of codes[begin:end] of ascending spans: differences of running sums, taken over parts, moved to a common power."""
    keys = np.empty(len(begins), np.uint64)
    first = 0
    up, down = _usual_powers()
    while first < len(begins):
        low = begins[first]
        last = max(first + 1, int(np.searchsorted(ends, low + SUMMED, side="right")))
        part = codes[low : ends[last - 1]].astype(np.uint64) + np.uint64(1)
        if len(up) < len(part):
            up, down = _powers(len(part))
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=run[1:])
        s, e = begins[first:last] - low, ends[first:last] - low
        keys[first:last] = (run[e] - run[s]) * down[s] + (e - s).astype(np.uint64)
        first = last
    keys ^= keys >> np.uint64(32)
    keys *= HASH_MIX
    keys ^= keys >> np.uint64(29)
    return keys


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, even where lambdas use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    Only one machine (local mode, tests) may take a temporary folder of its own instead.
    """
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="provgraph-"))
    return _OWN[0]


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Paths of the tables stored since the outermost `scratch` began.
_STORED: list[str] = []


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`stored`, and the table's path for `removed`."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage is cut, and a lost executor costs nothing."""
    return stored_at(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if path in _STORED:
        _STORED.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end; results that read them must be written by then."""
    known = len(_STORED)
    try:
        yield
    finally:
        while len(_STORED) > known:
            removed(spark, _STORED[-1])
