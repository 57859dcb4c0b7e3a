"""Line dedup by site-relative frequency.

Pages that hold a line are counted by host and divided by the host's pages;
lines of more than a given share are boilerplate and are cut out of every page
of that host. A line must also stand on a few pages (``HELD_BY``), so that in a
host of a handful of pages two pages that share a line do not make it
boilerplate; the ratio decides at every host size. A page adds a line once, counts are combined before the shuffle,
and the boilerplate of a host is a short list: all its lines together can pass
the share at most (lines of a page) / (share) times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialize

#: Share of a host's pages, and pages, that must hold a line: more than the first, the second at least.
RATIO, HELD_BY = 0.1, 3
#: Boilerplate lines of all hosts up to which the lists are broadcast (48 bytes each).
BROADCAST_LINES = 200_000
#: Parts that a host's pages are dealt to when the lists are joined by shuffle.
SALTS = 64


def _key(line):
    return F.substring(F.unhex(F.md5(line.cast("binary"))), 1, 16)


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, held_by: int = HELD_BY) -> DataFrame:
    """``(_al_host, line, pages, total)`` of the lines over ``ratio`` of their host's pages.

    ``line`` is the MD5 of the trimmed line, which ``held_by`` pages hold at
    least. Blank lines are never counted; null and empty texts are pages
    without lines; a null host is a host of its own.
    """
    host = F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("n"))
    lines = F.filter(F.split(F.col(text_col).cast("string"), "\n", -1), lambda x: F.trim(x) != "")
    keys = F.array_distinct(F.transform(lines, lambda x: _key(F.trim(x))))
    # the page itself is counted under a null line, in the same pass
    both = docs.select(host.alias("_al_host"), F.explode(F.concat(F.array(F.lit(None).cast("binary")), F.coalesce(keys, F.array().cast("array<binary>")))).alias("line"))
    counts = materialize(both.groupBy("_al_host", "line").agg(F.count("*").alias("pages")).where(F.col("line").isNull() | (F.col("pages") >= held_by)), "lines")
    totals = counts.where("line is null").select("_al_host", F.col("pages").alias("total"))
    return counts.where("line is not null").join(totals, "_al_host").where(F.col("pages") > F.col("total") * ratio)


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, held_by: int = HELD_BY, marks: tuple[str, ...] = ("_al_lines", "_al_dropped")) -> DataFrame:
    """``docs`` with the text cut, all other columns as they are, and the columns ``marks``: lines and dropped lines.

    Null texts stay null; a page whose lines all go has an empty text. Rows
    that repeat an id are pages of their own. Other lines keep their order,
    spaces and blank lines. A column of ``docs`` that has a name of ``marks``
    gives way to the count; no other name clashes. Empty ``marks``: no counts.
    """
    found = materialize(boilerplate(docs, host_col, text_col, ratio, held_by).select("_al_host", "line"), "boilerplate")
    at, cut, salt, every, kept = free_names(docs, "host", "cut", "salt", "all", "kept")
    lists = found.groupBy(F.col("_al_host").alias(at)).agg(F.collect_set("line").alias(cut))
    host = F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("n"))
    rows = docs.withColumn(at, host)
    if found.count() <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(lists), at, "left")
    else:
        lists = lists.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn(salt, F.pmod(F.xxhash64(text_col), F.lit(SALTS)).cast("int")).join(lists, [at, salt], "left")
    lines, bad = F.split(F.col(text_col).cast("string"), "\n", -1), F.col(cut)
    left = F.when(bad.isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains(bad, _key(F.trim(x)))))
    out = joined.withColumn(every, lines).withColumn(kept, left)
    filled, none = F.coalesce(F.size(every), F.lit(0)), F.col(every).isNull()
    counts = [F.when(none, 0).otherwise(filled), F.when(none, 0).otherwise(filled - F.size(kept))]
    return out.select(
        *[F.array_join(kept, "\n").alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in marks],
        *[c.alias(name) for c, name in zip(counts, marks, strict=False)],
    )


def line_report(docs: DataFrame, ratio: float = RATIO, held_by: int = HELD_BY) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text_sha256`` (of the cut text; null: empty) of every row."""
    out = drop_boilerplate(docs.select("doc_id", "source", "text"), ratio=ratio, held_by=held_by)
    return out.select("doc_id", F.col("_al_lines").cast("bigint").alias("n_lines"), F.col("_al_dropped").cast("bigint").alias("n_dropped"), F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256"))
