"""JSON pages, immutable dataset versions with a pointer, and the partitioned export package."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from almagest.functions import exact_json


def hadoop(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is on."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` of the session names it.

    Only a local session without that setting (a test) gets a folder of this
    process, which is removed when the process ends. On a cluster the setting
    must be there: executors could not read such a folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="almagest-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new folder under ``shared_dir``, deleted when the JVM ends."""
    path = f"{shared_dir(spark)}/almagest/{tag}-{uuid.uuid4().hex}"
    p, fs = hadoop(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def spread(df: DataFrame) -> DataFrame:
    """Deal a table out if it is read in fewer splits than there are cores.

    A file of one row group is one task, however many cores wait. Tables of
    any size worth a cluster have more splits and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is not there."""
    p, fs = hadoop(spark, path)
    if not fs.exists(p):
        return None
    s = fs.open(p)
    try:
        return bytes(s.readAllBytes()).decode()
    finally:
        s.close()


def _renamed(spark: SparkSession, old, new, overwrite: bool) -> None:
    jvm = spark.sparkContext._jvm
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if overwrite else kind.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new, options)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file, written aside and moved into place in one step; readers see the old or the new one.

    Without ``overwrite`` it fails if the file is there already.
    """
    new, fs = hadoop(spark, path)
    aside, _ = hadoop(spark, f"{path}.{uuid.uuid4().hex}.new")
    fs.mkdirs(new.getParent())
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        _renamed(spark, aside, new, overwrite)
    except Exception:
        fs.delete(aside, False)
        raise


_PAGE_ROWS = 2000


def read_pages(spark: SparkSession, path: str | list[str], fields: list[str], errors: bool = False) -> DataFrame:
    """Rows of JSON array pages as text columns with page and ordinal; absent fields are null.

    Values keep the spelling of the page: ``1.10`` and ``1e2`` stay as they
    are, also inside objects and in ``payload_json``; objects and arrays are
    compact JSON. A page that cannot be read (no JSON, no array, an element
    that is no object, a repeated key) fails the query with PAGE_ERROR; with
    ``errors`` it gives a row with ``page_error`` and no ordinal instead. An
    empty array has no rows. A page is one value, so it should fit a task.
    """
    names = [f"f{i}" for i in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string()] * len(names) + [pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*names, "page_path", "row_ordinal", "payload_json", "page_error"])

        for b in batches:
            for page, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    rows = exact_json.loads(content.as_py())
                    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
                        raise ValueError("NO_ARRAY_OF_OBJECTS")
                    out = [(*[exact_json.cell(r.get(f)) for f in fields], page, i, exact_json.dumps(r), None) for i, r in enumerate(rows)]
                except (ValueError, RecursionError) as error:  # also a text that is no UTF-8
                    out = [(*[None] * len(names), page, None, None, str(error) or type(error).__name__)]
                for i in range(0, len(out), _PAGE_ROWS):
                    yield batch(out[i : i + _PAGE_ROWS])

    schema = ", ".join([*[f"{n} string" for n in names], "page_path string, row_ordinal bigint, payload_json string, page_error string"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).where(~F.col("path").endswith("/manifest.json"))
    rows = files.select("path", "content").mapInArrow(run, schema)
    cells = [F.col(n).alias(f) for n, f in zip(names, fields, strict=True)]
    if errors:
        return rows.select(*cells, "page_path", "row_ordinal", "payload_json", "page_error")
    failed = F.raise_error(F.concat(F.lit("PAGE_ERROR "), "page_path", F.lit(": "), "page_error"))
    return rows.select(*cells, "page_path", F.when(F.col("page_error").isNotNull(), failed.cast("bigint")).otherwise(F.col("row_ordinal")).alias("row_ordinal"), "payload_json").where("row_ordinal is not null")


def text_schema(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


class VersionStore:
    """Version folders under one root and numbered pointers, of which the highest names the current version.

    All file operations go through Hadoop's file system, so any store works. A
    pointer is moved into place in one step under the next number, which fails
    if another writer took that number: readers always see one version whole,
    and of two writers that expect the same one, one is refused.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = lambda p: hadoop(spark, p)[0]
        self.fs = hadoop(spark, self.root)[1]

    def publish(self, df: DataFrame, partition_by: list[str] | None = None, expect: str | None = None) -> str:
        """Write a version, check what can be read back, then move the pointer; a failed write leaves the pointer alone."""
        version = uuid.uuid4().hex
        path = f"{self.root}/versions/{version}"
        counted = Observation()
        keys = partition_by or []
        w = df.observe(counted, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*keys).bitwiseAND(F.lit(0xFFFFFFFF))).alias("keys") if keys else F.lit(None).cast("bigint").alias("keys"))
        w = w.write.mode("errorifexists").option("compression", "snappy")
        (w.partitionBy(*keys) if keys else w).parquet(path)
        self._check(path, df.schema, counted.get, keys)
        self.activate(version, expect)
        return version

    def _check(self, path: str, schema: StructType, counted: dict, keys: list[str]) -> None:
        """The files have the columns and types that were written, as many rows, and the same partition values."""
        kinds = {f.name: f.dataType for f in schema}
        files = self.spark.read.option("partitionOverwriteMode", "static").parquet(path)
        if {n: t for n, t in kinds.items() if n not in keys} != {f.name: f.dataType for f in files.schema if f.name not in keys} or set(files.columns) != set(kinds):
            raise ValueError("READ_BACK_SCHEMA")
        back = self.spark.read.schema(schema).parquet(path)
        total = F.sum(F.xxhash64(*keys).bitwiseAND(F.lit(0xFFFFFFFF))) if keys else F.lit(None).cast("bigint")
        got = back.agg(F.count(F.lit(1)).alias("n"), total.alias("keys")).first()
        if got.n != counted["n"]:
            raise ValueError("READ_BACK_COUNT")
        if got["keys"] != counted["keys"]:
            raise ValueError("READ_BACK_PARTITIONS")

    def _pointer(self) -> tuple[int, str | None]:
        p = self._path(f"{self.root}/pointers")
        numbers = [int(n[:-5]) for s in (self.fs.listStatus(p) if self.fs.exists(p) else []) if (n := s.getPath().getName()).endswith(".json")]
        if not numbers:
            return 0, None
        return max(numbers), json.loads(read_text(self.spark, f"{self.root}/pointers/{max(numbers):012d}.json"))["version"]

    def current(self) -> str | None:
        return self._pointer()[1]

    def activate(self, version: str, expect: str | None = None) -> None:
        """Point to a version; with ``expect``, only if that one is current."""
        number, now = self._pointer()
        if expect is not None and now != expect:
            raise ValueError("CURRENT_CHANGED")
        if not self.fs.exists(self._path(f"{self.root}/versions/{version}")):
            raise ValueError("UNKNOWN_VERSION")
        try:
            write_text(self.spark, f"{self.root}/pointers/{number + 1:012d}.json", json.dumps({"version": version}), overwrite=False)
        except Exception as error:
            raise ValueError("CURRENT_CHANGED") from error

    def reload(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Replace all that the current version holds; readers see the old rows until the new ones are whole."""
        return self.publish(df, partition_by, self.current())

    def read(self, version: str | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/versions/{version or self.current()}")

    def versions(self) -> list[str]:
        p = self._path(f"{self.root}/versions")
        if not self.fs.exists(p):
            return []
        found = sorted(self.fs.listStatus(p), key=lambda s: (s.getModificationTime(), s.getPath().getName()))
        return [s.getPath().getName() for s in found]

    def retain(self, most: int = 3, hours: float = 0.0) -> list[str]:
        """Delete the oldest versions beyond ``most``, never the current one nor one written in the last ``hours``; returns what went.

        ``hours`` leaves those who read an older version the time to finish.
        """
        keep = set(self.versions()[-most:]) | {self.current()}
        p = self._path(f"{self.root}/versions")
        young = {s.getPath().getName() for s in (self.fs.listStatus(p) if self.fs.exists(p) else []) if s.getModificationTime() > (time.time() - 3600 * hours) * 1000}
        gone = [v for v in self.versions() if v not in keep | young]
        for v in gone:
            self.fs.delete(self._path(f"{self.root}/versions/{v}"), True)
        return gone


def export_months(df: DataFrame, path: str, date: str = "signing_date", rows_per_file: int = 1_000_000) -> None:
    """Partitions by year and month, ``unknown`` for a missing date; large months may be several files."""
    part = df.withColumns({"signing_year_partition": F.coalesce(F.date_format(date, "yyyy"), F.lit("unknown")), "signing_month_partition": F.coalesce(F.date_format(date, "MM"), F.lit("unknown"))})
    part.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).partitionBy("signing_year_partition", "signing_month_partition").parquet(path)


def ddl(name: str, schema: StructType, partitions: list[str], location: str) -> str:
    """A CREATE TABLE statement for the package."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in partitions)
    parts = ", ".join(f"`{p}` string" for p in partitions)
    return f"CREATE EXTERNAL TABLE `{name}` (\n  {cols}\n)" + (f"\nPARTITIONED BY ({parts})" if parts else "") + f"\nSTORED AS PARQUET\nLOCATION '{location}'"


def digest_sql(relation: str, columns: list[str]) -> str:
    """The statement that gives ``multiset_digest`` of a relation where only SQL is at hand."""
    cells = ", ".join(f"coalesce(concat('V', octet_length(cast(`{c}` as string)), ':', cast(`{c}` as string), ';'), 'N;')" for c in columns)
    level = lambda source, n: f"select substring(b, 1, {n}) as b, sum(n) as n, sha2(array_join(transform(array_sort(collect_list(struct(b, d))), x -> concat(x.b, x.d)), ''), 256) as d from {source} group by substring(b, 1, {n})"
    return f"""with hashed as (select sha2(concat({cells}), 256) as h, count(*) as n from {relation} group by 1),
rows as (select substring(h, 1, 6) as b, n, concat(h, 'x', n, ';') as d from hashed),
six as ({level('rows', 6)}), three as ({level('six', 3)})
select coalesce(sum(n), 0) as rows, sha2(array_join(transform(array_sort(collect_list(struct(b, d))), x -> concat(x.b, x.d)), ''), 256) as digest from three"""
