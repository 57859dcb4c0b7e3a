"""Exact duplicates by a log-structured merge index.

Each task fills memtables: digest -> first normalised bytes, best row, count. A
text whose digest is there already is compared with the stored bytes. Full
memtables (``memtable_bytes``) are flushed sorted by digest and merged by
Spark's external sort into one level-0 run a task: a Parquet file in digest
order with a Bloom filter on the digest. Compaction merges the best rows of the
new runs (one per memtable and text, so a text that holds a third of all rows
is a handful of entries) with level 1, keeps the smallest identifier, and
writes level 1 anew as sorted runs with filters; a lookup reads level 1 and
skips the row groups whose range or filter cannot hold a digest. Digests met in
several memtables are hits between runs: their bytes are read again and
compared, and digests that fail are grouped by the bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget_at_end, materialize, scratch_path

SPACE = b" \t\n\x0b\x0c\r"
MEMTABLE_BYTES = 24 << 20
#: Bits of the filter of hits that goes to every task (8 MB).
FILTER_BITS = 26
BLOOM = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": "50000"}


def normalise(text: bytes | None) -> bytes:
    return (text or b"").translate(None, SPACE)


def sha256(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def _better(a: tuple, b: tuple) -> bool:
    """Order of rows of one text: most code points, smallest id, nulls last, first met."""
    return (-a[0], a[1] is None, a[1] if a[1] is not None else 0, a[2]) < (-b[0], b[1] is None, b[1] if b[1] is not None else 0, b[2])


def _tables(batches: Iterator[pa.RecordBatch], digest: Callable[[bytes], bytes], limit: int, ingest: int = 0) -> Iterator[tuple[dict, list]]:
    """Memtables of a task: ``{(digest, variant): [bytes, count, best]}`` and the rows in them."""
    task = TaskContext.get()
    base = (ingest << 56) + ((task.partitionId() if task else 0) << 36)
    entries, rows, held, seq = {}, [], 0, 0
    for b in batches:
        points = pc.fill_null(pc.utf8_length(b.column(1)), 0).to_pylist()
        for key, text, size in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), points, strict=True):
            data = normalise(text.as_py())
            d, variant = digest(data), 0
            while (e := entries.get((d, variant))) is not None and e[0] != data:
                variant += 1
            row = (size, key, base + seq)
            seq += 1
            if e is None:
                entries[d, variant] = [data, 1, row]
                held += len(data) + 200
            else:
                e[1] += 1
                if _better(row, e[2]):
                    e[2] = row
            rows.append((d, variant, row))
            held += 120
            if held >= limit:
                yield entries, rows
                entries, rows, held = {}, [], 0
    if rows:
        yield entries, rows


def _order():
    """Order of rows of one text, as ``_better``."""
    return F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id", "rid")


class MergeIndex:
    """Sorted runs of digests under one folder, in two levels.

    ``ingest`` may be called for several tables with ids of one type (127 at
    most) and ``compact`` after any of them; a compaction reads level 1 and the
    runs that came since, not what is in level 1 already.
    """

    def __init__(self, spark, path: str | None = None, digest: Callable[[bytes], bytes] = sha256, memtable_bytes: int = MEMTABLE_BYTES):
        self.spark, self.path = spark, path or scratch_path(spark, "lsm")
        self.digest, self.limit, self.kind = digest, memtable_bytes, None
        self.runs: list[str] = []
        self.fresh: list[str] = []
        self.level1: str | None = None

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Add the rows of ``docs`` as level-0 runs; null text counts as empty, repeated rows are rows of their own."""
        from pyspark.sql.pandas.types import to_arrow_type

        digest, limit, number = self.digest, self.limit, len(self.runs)
        kind, made = docs.schema[id_col].dataType, {}
        if self.kind not in (None, kind.simpleString()):
            raise ValueError(f"ids are {self.kind}, not {kind.simpleString()}")
        self.kind, made["kind"] = kind.simpleString(), to_arrow_type(kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get()
            for n, (entries, rows) in enumerate(_tables(batches, digest, limit, number)):
                best = {k: (e[2][2], e[1]) for k, e in entries.items()}
                rows.sort(key=lambda r: r[:2])
                count = [best[d, v][1] if best[d, v][0] == r[2] else 0 for d, v, r in rows]
                table = (task.partitionId() << 20) + n
                for i in range(0, len(rows), 20000):
                    part = rows[i : i + 20000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d for d, _, _ in part], pa.binary()), pa.array([v for _, v, _ in part], pa.int32()), pa.array([r[1] for *_, r in part], made["kind"]), pa.array([r[0] for *_, r in part], pa.int64()), pa.array([r[2] for *_, r in part], pa.int64()), pa.array(count[i : i + 20000], pa.int64()), pa.array([table] * len(part), pa.int64())],
                        names=["digest", "variant", "doc_id", "n_points", "rid", "entry", "memtable"],
                    )

        path = f"{self.path}/l0-{number}"
        narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        narrow.mapInArrow(run, self._rows()).sortWithinPartitions("digest", "variant", "memtable").write.options(**BLOOM).parquet(path)
        forget_at_end(self.spark, path)
        self.runs.append(path)
        self.fresh.append(path)

    def _rows(self) -> str:
        return f"digest binary, variant int, doc_id {self.kind}, n_points bigint, rid bigint, entry bigint, memtable bigint"

    def _entries(self) -> str:
        return f"digest binary, variant int, doc_id {self.kind}, n_points bigint, rid bigint, group_size bigint, runs bigint"

    def rows(self) -> DataFrame:
        """The rows of all level-0 runs."""
        return self.spark.read.schema(self._rows()).parquet(*self.runs)

    def compact(self) -> DataFrame:
        """Merge the new runs into level 1 and return it: a row for each text, ``digest, variant, keep_id, keep_rid, group_size, runs``."""
        if self.fresh:
            new = self.spark.read.schema(self._rows()).parquet(*self.fresh).where("entry > 0")
            new = new.select("digest", "variant", "doc_id", "n_points", "rid", F.col("entry").alias("group_size"), F.lit(1).cast("bigint").alias("runs"))
            if self.level1:
                new = new.unionByName(self._level1())
            merged = new.groupBy("digest", "variant").agg(F.min(_order()).alias("best"), F.sum("group_size").alias("group_size"), F.sum("runs").alias("runs"))
            merged = merged.select("digest", "variant", F.col("best.doc_id").alias("doc_id"), (-F.col("best.n")).alias("n_points"), F.col("best.rid").alias("rid"), "group_size", "runs")
            path = f"{self.path}/l1-{len(self.runs)}"
            merged.sortWithinPartitions("digest", "variant").write.options(**BLOOM).parquet(path)
            forget_at_end(self.spark, path)
            self.level1, self.fresh = path, []
        return self._level1().select("digest", "variant", F.col("doc_id").alias("keep_id"), F.col("rid").alias("keep_rid"), "group_size", "runs")

    def _level1(self) -> DataFrame:
        return self.spark.read.schema(self._entries()).parquet(self.level1)

    def lookup(self, digests: list[bytes]) -> DataFrame:
        """Level-1 rows of a few digests, none for those that the index lacks; ranges and filters spare the other row groups."""
        return self.compact().where(F.col("digest").isin([F.lit(bytearray(d)) for d in digests]))


def _hit_filter(hits: DataFrame):
    """A Bloom filter (one hash) of the digests as 64-bit words, of fixed size."""
    import numpy as np

    bit = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint"), F.lit(1 << FILTER_BITS))
    words = hits.select((bit / 64).cast("bigint").alias("w"), (bit % 64).cast("int").alias("b")).groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m"))
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    got = words.toArrow()  # at most 2 ** FILTER_BITS / 64 rows
    out[got.column("w").to_numpy()] = got.column("m").to_numpy()
    return out.view(np.uint64)


def _unequal(docs: DataFrame, hits: DataFrame, digest, limit: int) -> DataFrame:
    """Digests of several runs whose bytes differ, by comparing the bytes."""
    words = docs.sparkSession.sparkContext.broadcast(_hit_filter(hits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words.value
        for entries, _ in _tables(batches, digest, limit):
            out = []
            for (d, _v), e in entries.items():
                at = int.from_bytes(d[:7], "big") % (1 << FILTER_BITS)
                if int(table[at >> 6]) >> (at & 63) & 1:
                    out.append((d, e[0]))
            for i in range(0, len(out), 500):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out[i : i + 500]], pa.binary()), pa.array([x[1] for x in out[i : i + 500]], pa.binary())], names=["digest", "data"])

    again = docs.mapInArrow(run, "digest binary, data binary")
    return again.groupBy("digest").agg(F.min("data").alias("x"), F.max("data").alias("y")).where("x <> y").select("digest")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[bytes], bytes] = sha256, memtable_bytes: int = MEMTABLE_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row.

    Null text counts as empty. Of equal texts the row with most code points
    stays, then the smallest id (null last), then, among rows that repeat an
    id, the first met: one row of a group is ``kept``. Extra columns are
    ignored; an empty table gives an empty result.
    """
    index = MergeIndex(docs.sparkSession, digest=digest, memtable_bytes=memtable_bytes)
    index.ingest(docs, id_col, text_col)
    merged = index.compact()
    rows, narrow = index.rows(), docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hits = merged.where("runs > 1 or variant > 0").select("digest").distinct()
    bad = materialize(_unequal(narrow, hits, digest, memtable_bytes), "lsm-unequal")
    hexed = F.lower(F.hex("digest"))
    if bad.isEmpty():
        out = rows.join(merged.drop("runs"), ["digest", "variant"])
        return out.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), hexed.alias("text_sha256"))
    # digests that stand for several texts: the bytes themselves are the key
    good = rows.join(bad, "digest", "left_anti").join(merged.drop("runs"), ["digest", "variant"]).select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), hexed.alias("text_sha256"))

    def spread(batches):
        for entries, held in _tables(batches, digest, memtable_bytes):
            data = {k: e[0] for k, e in entries.items()}
            for i in range(0, len(held), 500):
                part = held[i : i + 500]
                yield pa.RecordBatch.from_pydict({"digest": pa.array([d for d, _, _ in part], pa.binary()), "data": pa.array([data[d, v] for d, v, _ in part], pa.binary()), "doc_id": [r[1] for *_, r in part], "n_points": pa.array([r[0] for *_, r in part], pa.int64()), "rid": pa.array([r[2] for *_, r in part], pa.int64())})

    whole = materialize(narrow.mapInArrow(spread, f"digest binary, data binary, doc_id {index.kind}, n_points bigint, rid bigint").join(F.broadcast(bad) if bad.count() < 100_000 else bad, "digest", "left_semi"), "lsm-bytes")
    best = whole.groupBy("data").agg(F.min(_order()).alias("best"), F.count("*").alias("group_size")).select("data", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"))
    return good.union(whole.join(best, "data").select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), hexed.alias("text_sha256")))
