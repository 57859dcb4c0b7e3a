"""Export packages: Parquet files under one root, and a manifest from which every claim can be derived again."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almagest.functions import codecs, exact_json
from almagest.operators.digest import multiset_digest
from almagest.sources.store import hadoop, read_text, write_text

#: Rows of a file, and of the batches a stream is handed on in.
ROWS_A_FILE = 1_000_000


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``path, row_group, column, codec, rows`` of every column chunk under ``path``, from the files' ends alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for frame in frames:
            for name in frame["path"]:
                system, inner = (fs.LocalFileSystem(), "/" + name.removeprefix("file:").lstrip("/")) if name.startswith("file:") else fs.FileSystem.from_uri(name)
                with system.open_input_file(inner) as f:
                    meta = pq.ParquetFile(f).metadata
                    rows = [(name, g, c.path_in_schema, c.compression, meta.row_group(g).num_rows) for g in range(meta.num_row_groups) for c in (meta.row_group(g).column(i) for i in range(meta.num_columns))]
                yield pd.DataFrame(rows, columns=["path", "row_group", "column", "codec", "rows"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path").mapInPandas(run, "path string, row_group int, column string, codec string, rows bigint")


def codec_problems(spark: SparkSession, path: str, codec: str = "SNAPPY") -> DataFrame:
    """Column chunks that are compressed in another way."""
    return footers(spark, path).where(F.col("codec") != codec)


def read_files(spark: SparkSession, files: list[str], like: DataFrame, base: str) -> DataFrame:
    """A scan of listed files only, with the columns and types of ``like``; partition columns come from folder names under ``base``."""
    return spark.read.option("basePath", base).schema(like.schema).parquet(*files)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """``path, bytes, sha256`` of the package's files, the manifest aside; hidden files are in no package."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = hadoop(spark, root)[0].toUri().getPath().rstrip("/")
    name = F.regexp_replace(F.col("path"), f"^.*?{base}/", "")
    return files.select(name.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).where("path <> 'manifest.json'")


def write_package(spark: SparkSession, root: str, relations: dict[str, DataFrame], partitions: dict[str, list[str]] | None = None) -> dict:
    """Write relations as Parquet, every cell as its codec's text, and a manifest of files, schemas, rows and digests."""
    said = {}
    for name, df in sorted(relations.items()):
        keys = (partitions or {}).get(name, [])
        text = codecs.encode_all(df)
        w = text.write.mode("errorifexists").option("compression", "snappy").option("maxRecordsPerFile", ROWS_A_FILE)
        (w.partitionBy(*keys) if keys else w).parquet(f"{root}/{name}")
        one = multiset_digest(text, text.columns).first()
        said[name] = {"schema": df.schema.simpleString(), "partitions": keys, "rows": str(one.rows), "digest": one.digest}
    files = [{"path": r.path, "bytes": str(r.bytes), "sha256": r.sha256} for r in inventory(spark, root).where(~F.col("path").rlike(r"(^|/)[_.][^/]*$")).orderBy("path").toLocalIterator()]
    manifest = {"relations": said, "files": files}
    write_text(spark, f"{root}/manifest.json", exact_json.dumps(manifest))
    return manifest


def package_faults(spark: SparkSession, root: str, identity: dict[str, str] | None = None) -> DataFrame:
    """``subject, fault`` of a package whose files are not what its manifest says.

    NO_MANIFEST; of files FILE_MISSING, FILE_ADDED, FILE_CHANGED, OTHER_CODEC;
    of relations OTHER_SCHEMA, OTHER_ROWS, OTHER_DIGEST, CELL_NOT_LOSSLESS, and
    KEY_NOT_UNIQUE for the key columns that ``identity`` names.
    """
    shape = "subject string, fault string"
    text = read_text(spark, f"{root}/manifest.json")
    if text is None:
        return spark.createDataFrame([("manifest.json", "NO_MANIFEST")], shape)
    m = exact_json.loads(text)
    want = spark.createDataFrame([(f["path"], f["sha256"]) for f in m["files"]], "path string, want string")
    have = inventory(spark, root).where(~F.col("path").rlike(r"(^|/)[_.][^/]*$"))
    both = want.join(have, "path", "full_outer")
    fault = F.when(F.col("sha256").isNull(), "FILE_MISSING").when(F.col("want").isNull(), "FILE_ADDED").when(F.col("want") != F.col("sha256"), "FILE_CHANGED")
    out = both.select(F.col("path").alias("subject"), fault.alias("fault")).where("fault is not null")
    gone = {r.subject for r in out.where("fault in ('FILE_MISSING', 'FILE_CHANGED')").limit(len(m["files"])).toLocalIterator()}  # names in the manifest
    found = []
    for name, said in m["relations"].items():
        if any(g.startswith(f"{name}/") for g in gone):
            continue
        out = out.unionByName(codec_problems(spark, f"{root}/{name}").select("path").distinct().select(F.regexp_replace("path", f"^.*/{name}/", f"{name}/").alias("subject"), F.lit("OTHER_CODEC").alias("fault")))
        like = spark.createDataFrame([], said["schema"])
        cells = spark.read.schema(codecs.encode_all(like).schema).parquet(f"{root}/{name}")
        if set(spark.read.parquet(f"{root}/{name}").columns) != set(like.columns):
            found.append((name, "OTHER_SCHEMA"))
            continue
        one = multiset_digest(cells, like.columns).first()
        if str(one.rows) != said["rows"]:
            found.append((name, "OTHER_ROWS"))
        elif one.digest != said["digest"]:
            found.append((name, "OTHER_DIGEST"))
        back = codecs.decode_all(cells, like)
        decoded = [(F.col(f"`{f.name}`"), codecs.codec(f.dataType)[2](F.col(f"`{f.name}`"))) for f in like.schema]
        if not cells.where(functools.reduce(lambda x, y: x | y, [text.isNotNull() & value.isNull() for text, value in decoded])).isEmpty():
            found.append((name, "CELL_NOT_LOSSLESS"))
        key = (identity or {}).get(name)
        if key and not back.groupBy(key).count().where("count > 1 or " + key + " is null").isEmpty():
            found.append((name, "KEY_NOT_UNIQUE"))
    return out.unionByName(spark.createDataFrame(found, shape))


def read_relation(spark: SparkSession, root: str, relation: str, columns: list[str], limit: int | None = None, order: str | None = None) -> DataFrame:
    """Listed columns of a listed relation of a package, in their types; with ``limit`` the first rows by ``order``, which is the feature."""
    m = exact_json.loads(read_text(spark, f"{root}/manifest.json") or "{}")
    if relation not in m.get("relations", {}):
        raise ValueError("UNKNOWN_RELATION")
    like = spark.createDataFrame([], m["relations"][relation]["schema"])
    if set(columns) - set(like.columns):
        raise ValueError("UNKNOWN_COLUMNS")
    cells = spark.read.schema(codecs.encode_all(like).schema).parquet(f"{root}/{relation}")
    out = codecs.decode_all(cells.select(*columns), like.select(*columns))
    if limit is not None:
        if not order:
            raise ValueError("LIMIT_WITHOUT_ORDER")
        out = out.orderBy(order).limit(limit)
    return out


def stream(df: DataFrame, most_bytes: int = 8 << 20) -> Iterator[list]:
    """Rows in lists whose text is ``most_bytes`` at most, one partition after the other; the driver holds two partitions."""
    held, size = [], 0
    for row in df.toLocalIterator(prefetchPartitions=True):
        n = sum(len(str(v)) for v in row if v is not None) + 8 * len(row)
        if held and size + n > most_bytes:
            yield held
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield held


def capture(df: DataFrame, snapshot: dict[str, str], path: str) -> DataFrame:
    """The rows of one snapshot, written once under ``path`` for all that a build reads after it."""
    for column, value in snapshot.items():
        df = df.where(F.col(column) == F.lit(value))
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
