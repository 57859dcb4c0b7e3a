"""Content digests that do not depend on row order, and equality of bags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almagest.functions import columns as C

#: Leading hex digits of a row hash that name its bucket, level by level.
LEVELS = (6, 3, 0)


def multiset_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """``rows, digest``: a tree of hashes over the sorted row hashes and how often each occurs.

    Equal rows are counted first, so a row that occurs a billion times is one
    entry. Row hashes are sorted and hashed within 16 million buckets, those
    within 4096, and those into one; no task sorts a list that grows with the
    table by more than its share of a bucket. An empty table has the empty
    digest.
    """
    now = df.groupBy(C.row_digest([F.col(c) for c in columns]).alias("h")).agg(F.count("*").alias("n"))
    now = now.select(F.concat("h", F.lit("x"), F.col("n").cast("string"), F.lit(";")).alias("d"), "n", F.substring("h", 1, LEVELS[0]).alias("b"))
    for level in LEVELS:
        hashed = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda x: F.concat(x["b"], x["d"])), ""), 256)
        if level == 0:
            return now.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), hashed.alias("digest"))
        now = now.groupBy(F.substring("b", 1, level).alias("g")).agg(F.sum("n").alias("n"), hashed.alias("d")).withColumnRenamed("g", "b")
    raise AssertionError


def key_set_digest(df: DataFrame, key: str) -> DataFrame:
    """The same for the distinct keys."""
    return multiset_digest(df.select(key).distinct(), [key])


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that stand more often in one bag, with ``surplus`` (positive: in ``a``)."""
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("_s")).unionByName(b.select(*cols, F.lit(-1).alias("_s")))
    return both.groupBy(*cols).agg(F.sum("_s").alias("surplus")).where("surplus <> 0")
