"""An offline source for replays: rows by a rule, served as the paged source serves them."""

from __future__ import annotations

import io
import json
import urllib.parse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rows(spark: SparkSession, n: int) -> DataFrame:
    """``n`` observations as text; every fault of the rules occurs, at numbers that a rule tells."""
    i = F.col("id")
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (i % 90).cast("int")), "yyyy-MM-dd")
    return spark.range(n).select(
        F.when(i % 50 != 49, F.format_string("C-%07d", i)).alias("id"),
        F.when(i % 40 == 39, "-1").when(i % 40 == 38, "1.001").when(i % 40 == 37, "x").when(i % 40 != 36, F.concat((i * 17 % 100000).cast("string"), F.lit(".50"))).alias("amount"),
        F.when(i % 30 == 29, "2026-02-30T00:00:00.000").otherwise(F.concat(day, F.lit("T00:00:00.000"))).alias("signing"),
        F.when(i % 5 != 4, F.concat(day, F.lit("T08:00:00.000"))).alias("updated"),
        F.when(i % 20 == 19, "Other").otherwise("Antioquia").alias("department"),
    )


def opener(held: list[dict], key: str = "id") -> Callable:
    """What ``http.fetch`` opens instead of a network: answers key cursors and limits over ``held``, which a test holds in memory."""
    ordered = sorted((r for r in held if r[key] is not None), key=lambda r: r[key])

    def opened(url: str, timeout: float) -> io.BytesIO:
        asked = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(url).query).items()}
        after = asked.get("$where", "").rpartition(f"{key} > ")[2].strip("'")
        found = [r for r in ordered if not after or r[key] > after][: int(asked["$limit"])]
        return io.BytesIO(json.dumps([{k: v for k, v in r.items() if v is not None} for r in found]).encode())

    return opened
