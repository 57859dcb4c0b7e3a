"""What the training-data operators share: scratch tables and reading."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almagest.sources.store import hadoop, shared_dir, spread  # noqa: F401


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/almagest/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    It cuts the lineage, survives the loss of any executor, and stops Spark
    from computing an expensive input once per consumer. The files go when the
    session's JVM ends, or before that by ``discard``.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.options(**options).parquet(path)
    forget_at_end(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


#: Scratch folders of this process, in the order in which they were written.
_MADE: list[str] = []


def forget_at_end(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder when the JVM ends."""
    p, fs = hadoop(spark, path)
    fs.deleteOnExit(p)
    _MADE.append(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete the scratch folders that are written inside, but those of the frames put into the list."""
    keep: list[DataFrame] = []
    start = len(_MADE)
    try:
        yield keep
    finally:
        kept = {df._scratch for df in keep}
        for path in _MADE[start:]:
            if path not in kept:
                p, fs = hadoop(spark, path)
                fs.delete(p, True)
        _MADE[start:] = [path for path in _MADE[start:] if path in kept]


def discard(df: DataFrame) -> None:
    """Delete the files behind a materialized frame that has no more readers."""
    path = getattr(df, "_scratch", None)
    if path:
        p, fs = hadoop(df.sparkSession, path)
        fs.delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; keeps the session's Arrow batches small (``text_batches``)."""
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col, n: int):
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(col.cast("string").cast("binary")) % n


#: Rows of an Arrow batch that carries whole texts to Python.
BATCH_ROWS = "500"


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, unless the session asks for smaller ones.

    Spark's 10,000 rows a batch are 34 MB of ordinary documents, several times
    over in the JVM and in Python; an executor has a few hundred MB to spare.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= int(BATCH_ROWS):
        spark.conf.set(key, BATCH_ROWS)


_HELD: dict = {}


def give_back() -> None:
    """Return freed memory of this process to the system; an executor's workers share little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def held(key, make: Callable = lambda: None):
    """What ``make`` gives, kept by a Python worker for its next tasks until an operator asks for another key.

    Spark reuses workers, so without this each would hold the state of every operator that it ever ran.
    """
    if key not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[key] = make()
    return _HELD[key]


def tidy(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives memory back when its task ends."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, in any case."""
    taken, end = {c.lower() for c in df.columns}, ""
    while any(f"_al_{n}{end}" in taken for n in names):
        end += "_"
    return [f"_al_{n}{end}" for n in names]
