"""WARC records, and resolution of not-modified revisits.

A revisit says that a page had not changed: it has headers but no payload. It
is joined as of its time to the latest earlier full response of the same
canonical URL; the validators of both must agree; then it takes the response's
payload and headers, updated by those headers that a 304 answer may change.

The as-of join has two levels, so that a URL with a third of all captures is
not one task: within (URL, hour) by a window, and over the hours of a URL, of
which only the latest response each is left. Revisits without URL or time take
no part in it.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Headers of a 304 answer that replace stored ones.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that only track.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
#: Responses that revisits take their payload from, up to which their numbers are broadcast (8 bytes each).
BROADCAST_SOURCES = 10_000
RECORD = "record_id string, url string, ts timestamp, kind string, status int, headers map<string,string>, payload binary"


def canonical_url(url):
    """Lower-case scheme and host, no default port, fragment or tracking parameter, parameters sorted."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    head = F.regexp_replace(F.regexp_replace(head, r"^(http://.*):80$", "$1"), r"^(https://.*):443$", "$1")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(rest, r"\?.*$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    return F.concat(head, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _validator(name: str):
    v = F.trim(F.element_at("headers", name))
    return F.when(v != "", F.regexp_replace(v, "^W/", ""))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit with ``state, source_id, headers, payload``.

    ``records``: ``record_id, url, ts, kind, status, headers, payload`` with
    lower-case header names; kind is ``response`` or ``revisit``; full
    responses have status 200. Of responses at one time the largest
    ``record_id`` is the latest; the response must be strictly earlier. States:
    RESOLVED, NO_EARLIER_RESPONSE, NO_COMMON_VALIDATOR, VALIDATOR_MISMATCH; only
    RESOLVED rows take payload and headers. A revisit without URL or time has
    no earlier response; responses without them, and rows of other kinds, are
    ignored; an empty table gives an empty result. Every revisit gives one
    row, also if record ids are null or repeat: rows are told apart by a number of their own. Of responses that
    share id and time the largest by validators, then by a digest of headers
    and payload, is taken. Extra columns are ignored.
    """
    t, curl = F.unix_micros(F.col("ts").cast("timestamp")), canonical_url(F.col("url"))
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200) & t.isNotNull() & curl.isNotNull(), F.lit(False))
    revisit = F.col("kind") == "revisit"
    rows = records.where(full | revisit).select(
        F.monotonically_increasing_id().alias("row"), "record_id", "url", "ts", curl.alias("curl"), t.alias("t"), F.floor(t / 3_600_000_000).alias("hour"), full.alias("full"), _validator("etag").alias("etag"), _validator("last-modified").alias("modified"), "headers",
        F.when(full, F.col("payload")).alias("payload"), F.when(full, F.xxhash64("payload", F.array_sort(F.map_entries("headers")))).alias("digest"),
    )
    rows = materialize(rows, "warc-rows", compression="zstd")  # the numbers are set once
    ref = F.when(F.col("full"), F.struct("t", "record_id", "etag", "modified", "digest", "row"))
    slim = rows.select("row", "record_id", "curl", "t", "hour", "full", "etag", "modified", ref.alias("ref"), *[F.when(~F.col("full"), F.col(c)).alias(n) for c, n in (("url", "url"), ("ts", "ts"), ("headers", "own_headers"))])
    placed = slim.where(F.col("curl").isNotNull() & F.col("t").isNotNull())
    lost = slim.where(F.col("curl").isNull() | F.col("t").isNull()).drop("full").withColumnRenamed("ref", "src")
    within = Window.partitionBy("curl", "hour").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.max("ref").over(within)).where(~F.col("full")).drop("ref", "full")
    hours = placed.groupBy("curl", "hour").agg(F.max("ref").alias("ref"))
    before = Window.partitionBy("curl").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("curl", "hour", F.max("ref").over(before).alias("far"))
    found = near.join(hours, ["curl", "hour"], "left").withColumn("src", F.coalesce("near", "far")).drop("near", "far").unionByName(lost)
    same_tag, same_time = F.col("etag") == F.col("src.etag"), F.col("modified") == F.col("src.modified")
    state = (
        F.when(F.col("src").isNull(), "NO_EARLIER_RESPONSE")
        .when(same_tag.isNull() & same_time.isNull(), "NO_COMMON_VALIDATOR")
        .when(F.coalesce(same_tag, F.lit(True)) & F.coalesce(same_time, F.lit(True)), "RESOLVED")
        .otherwise("VALIDATOR_MISMATCH")
    )
    found = found.select("record_id", "url", F.col("curl").alias("canonical_url"), "ts", "own_headers", state.alias("state"), F.col("src.record_id").alias("source_id"), F.when(state == "RESOLVED", F.col("src.row")).alias("from_row"))
    found = materialize(found, "warc-found")  # without payloads
    source = rows.where("full").select("row", F.col("headers").alias("src_headers"), "payload")
    wanted = found.where("from_row is not null").select("from_row").distinct()
    if wanted.count() <= BROADCAST_SOURCES:  # a checked size; only payloads that are asked for are shuffled
        source = source.join(F.broadcast(wanted), F.col("row") == F.col("from_row"), "left_semi")
    out = found.where("from_row is not null").join(source, F.col("from_row") == F.col("row"))
    out = out.unionByName(found.where("from_row is null"), allowMissingColumns=True)
    allowed = F.map_filter("own_headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter("src_headers", lambda k, v: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False)))
    merged = F.when(F.col("state") == "RESOLVED", F.map_concat(F.coalesce(kept, F.create_map().cast("map<string,string>")), F.coalesce(allowed, F.create_map().cast("map<string,string>")))).otherwise(F.col("own_headers"))
    return out.select("record_id", "url", "canonical_url", "ts", "state", "source_id", merged.alias("headers"), "payload")


def _length(text: str) -> int | None:
    return int(text) if text.isascii() and text.isdigit() else None


def parse_warc(stream) -> Iterator[dict]:
    """Records of a WARC file, plain or gzip, read one by one from a binary stream (or bytes).

    HTTP headers and payload are taken apart. Missing fields are null, headers
    then empty. A record without a readable length has no payload, and reading
    goes on at the next record's first line; one that the file cuts short has
    what is left of it; lines between records are skipped.
    """
    stream = io.BufferedReader(io.BytesIO(stream) if isinstance(stream, bytes) else stream)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = _length(head.get("content-length", ""))
        body = payload = None if size is None else stream.read(size)
        status, headers = None, {}
        if body is not None and head.get("content-type", "").startswith("application/http"):
            top, _, payload = body.partition(b"\r\n\r\n")
            first, *rest = top.decode("latin-1").split("\r\n")
            words = first.split()
            status = int(words[1]) if len(words) > 1 and words[1].isascii() and words[1].isdigit() and len(words[1]) < 9 else None
            for item in rest:
                name, _, value = item.partition(":")
                headers[name.strip().lower()] = value.strip()
        yield {"record_id": head.get("warc-record-id"), "url": head.get("warc-target-uri", "").strip("<>") or None, "ts": head.get("warc-date"), "kind": head.get("warc-type"), "status": status, "headers": headers, "payload": payload}


#: Records and bytes of payload that are handed on together.
PASSED_ROWS, PASSED_BYTES = 500, 16 << 20
#: File systems that a task opens by itself and reads as a stream.
STREAMED = ("file", "hdfs", "s3", "gs", "abfs")


def _framed(records: Iterator[dict]) -> Iterator[pd.DataFrame]:
    names, rows, size = ["record_id", "url", "ts", "kind", "status", "headers", "payload"], [], 0

    def frame() -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        out["ts"] = pd.to_datetime(out["ts"], utc=True, errors="coerce", format="ISO8601").dt.tz_localize(None)
        out["status"] = out["status"].astype("Int32")
        return out

    for r in records:
        rows.append(r)
        size += len(r["payload"] or b"")
        if len(rows) >= PASSED_ROWS or size >= PASSED_BYTES:
            yield frame()
            rows, size = [], 0
    if rows:
        yield frame()


def read_warc(spark, path: str) -> DataFrame:
    """Records of the WARC files under ``path``; one file is one task's work.

    A task reads its file as a stream and hands records on in batches, so a
    file may be larger than its memory. Only where the file system is none of
    ``STREAMED`` does Spark load a file as one value. Malformed records are as
    in ``parse_warc``; a date that cannot be read is null; no file, no rows.
    """
    files = spark.read.format("binaryFile").load(path)
    scheme = path.split("://")[0] if "://" in path else "file"

    def streams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            for name in frame["path"]:
                if name.startswith("file:"):
                    system, inner = fs.LocalFileSystem(), "/" + name.removeprefix("file:").lstrip("/")
                else:
                    system, inner = fs.FileSystem.from_uri(quote(name, safe=":/@"))
                with system.open_input_stream(inner, compression=None) as stream:
                    yield from _framed(parse_warc(stream))

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["content"]:
                yield from _framed(parse_warc(bytes(data)))

    if scheme in STREAMED:
        return files.select("path").mapInPandas(streams, RECORD)
    return files.select("content").mapInPandas(whole, RECORD)


def page_captures(pages: DataFrame) -> DataFrame:
    """A capture log of the rows of a pages table, for the query on it.

    Each page is fetched in full at minute ``page_id`` of 2024 and revisited
    six hours later (the tag of every fifth revisit is stale); every third page
    is also revisited an hour before its fetch.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    tag = F.concat(F.lit('"'), F.md5(html.cast("binary")), F.lit('"'))
    start = F.lit(1704067200)
    at = lambda seconds: F.timestamp_seconds(start + F.col("page_id") * 60 + seconds)
    text = F.col("page_id").cast("string")
    response = F.struct(F.concat(F.lit("a"), text).alias("record_id"), "url", at(0).alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"), F.create_map(F.lit("etag"), tag, F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.lit("d0")).alias("headers"), html.cast("binary").alias("payload"))
    none = F.lit(None).cast("binary").alias("payload")
    later = F.struct(F.concat(F.lit("b"), text).alias("record_id"), "url", at(21600).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), F.create_map(F.lit("etag"), F.when(F.col("page_id") % 5 == 0, F.lit('"stale"')).otherwise(tag), F.lit("content-type"), F.lit("text/none"), F.lit("date"), F.lit("d1")).alias("headers"), none)
    early = F.struct(F.concat(F.lit("c"), text).alias("record_id"), "url", at(-3600).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), F.create_map(F.lit("etag"), tag, F.lit("content-type"), F.lit("text/none"), F.lit("date"), F.lit("d2")).alias("headers"), none)
    rows = F.when(F.col("page_id") % 3 == 0, F.array(response, later, early)).otherwise(F.array(response, later))
    return pages.select(F.explode(rows).alias("r")).select("r.*")
