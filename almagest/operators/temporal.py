"""Snapshots over time: differences, synchronisation, late evidence, observation index, keyset pages."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almagest.operators.silver import VERSION_ORDER
from almagest.sources.store import scratch_dir


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, change, changed_fields`` of inserted, deleted and updated rows, null-safe."""
    o = old.select(F.col(key).alias("_k"), F.lit(True).alias("_in_old"), *[F.col(c).alias(f"_o_{c}") for c in fields])
    n = new.select(F.col(key), F.lit(True).alias("_in_new"), *fields)
    both = n.join(o, F.col(key) == F.col("_k"), "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_o_{c}")), F.lit(c)) for c in fields]))
    change = F.when(F.col("_in_old").isNull(), "INSERT").when(F.col("_in_new").isNull(), "DELETE").when(F.size(changed) > 0, "UPDATE")
    out = both.select(F.coalesce(key, "_k").alias(key), change.alias("change"), F.when(change == "UPDATE", changed).otherwise(F.array().cast("array<string>")).alias("changed_fields"))
    return out.where("change is not null")


def sync_counts(diff: DataFrame) -> DataFrame:
    one = diff.agg(*[F.count_if(F.col("change") == k).alias(a) for k, a in (("INSERT", "inserted"), ("UPDATE", "updated"), ("DELETE", "deleted"))])
    return one.withColumn("no_op", (F.col("inserted") + F.col("updated") + F.col("deleted")) == 0)


def rejection_links(winners: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rejects tied to the winner of their key, with EARLIER / EQUAL / LATER by acquisition time.

    Only raw ids that are the one spelling of their key can be attributed.
    """
    single = winners.select("contract_key", "source_id_raw").union(rejects.select("contract_key", "source_id_raw")).groupBy("contract_key").agg(F.countDistinct("source_id_raw").alias("k")).where("k = 1").select("contract_key")
    r = rejects.select("contract_key", F.col("fetched_at").alias("seen_at"), "payload_sha256")
    w = winners.select("contract_key", F.col("fetched_at").alias("kept_at"))
    order = F.when(F.col("seen_at") > F.col("kept_at"), "LATER").when(F.col("seen_at") == F.col("kept_at"), "EQUAL").when(F.col("seen_at") < F.col("kept_at"), "EARLIER").otherwise("UNKNOWN")
    out = r.join(w, "contract_key").join(single, "contract_key", "left_semi")
    return out.select("contract_key", order.alias("relation"), F.sha2(F.concat_ws("\u001f", "contract_key", "payload_sha256", order), 256).alias("link_id"))


def observation_condition(winners: DataFrame, links: DataFrame) -> DataFrame:
    """One row per winner: whether a later invalid observation exists."""
    per = links.groupBy("contract_key").agg(F.count_if(F.col("relation") == "LATER").alias("later"), F.count_if(F.col("relation").isin("EQUAL", "UNKNOWN")).alias("unclear"))
    state = F.when(F.col("later") > 0, "LATER_INVALID_OBSERVED").when(F.col("unclear") > 0, "TEMPORAL_ORDER_INDETERMINATE").otherwise("NO_LATER_INVALID_OBSERVED")
    return winners.select("contract_key").join(per, "contract_key", "left").select("contract_key", state.alias("condition"), F.coalesce("later", F.lit(0)).alias("later_links"), F.coalesce("unclear", F.lit(0)).alias("unclear_links"))


def observation_conditions(observed: DataFrame, key: str = "contract_key", raw: str = "source_id_raw", seen: str = "fetched_at") -> DataFrame:
    """The same from observations with ``rejection_details``, which are read once.

    Observations are first counted by key, outcome, spelling and time, in a
    table that is written; winners and rejects are both taken from it. Rejects
    count only where all of them have the winner's spelling.
    """
    ok = F.size("rejection_details") == 0
    order = [F.col(c) for c in VERSION_ORDER if c in observed.columns]
    per = observed.groupBy(F.col(key).alias("k"), ok.alias("ok"), F.col(raw).alias("raw"), F.col(seen).alias("seen")).agg(F.count("*").alias("n"), F.max(F.when(ok, F.struct(F.struct(*order).alias("o"), F.col(seen).alias("at"), F.col(raw).alias("raw")))).alias("best"))
    path = scratch_dir(observed.sparkSession, "conditions")
    per.write.mode("overwrite").parquet(path)
    per = observed.sparkSession.read.schema(per.schema).parquet(path)
    win = per.where("ok").groupBy("k").agg(F.max("best").alias("w"))
    rejects = per.where("not ok").select("k", "raw", "seen", "n")
    both = win.join(rejects, "k", "left")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    at = F.col("w.at")
    per = both.groupBy("k").agg(count(F.col("seen") > at).alias("later"), count(~F.coalesce(F.col("seen") != at, F.lit(False))).alias("unclear"), F.coalesce(F.bool_and(F.col("raw") == F.col("w.raw")), F.lit(True)).alias("single"))
    later, unclear = (F.when(F.col("single"), F.col(c)).otherwise(0).cast("bigint") for c in ("later", "unclear"))
    state = F.when(later > 0, "LATER_INVALID_OBSERVED").when(unclear > 0, "TEMPORAL_ORDER_INDETERMINATE").otherwise("NO_LATER_INVALID_OBSERVED")
    return per.select(F.col("k").alias(key), state.alias("condition"), later.alias("later_links"), unclear.alias("unclear_links"))


def observation_index(batch: DataFrame, state: DataFrame, identity: str, payload: str) -> DataFrame:
    """``identity, payload, outcome`` of a batch against what was seen: NEW, REPEATED or NEW_VERSION."""
    rows = batch.select(F.col(identity).alias("i"), F.col(payload).alias("p")).distinct()
    pairs = state.select(F.col(identity).alias("i"), F.col(payload).alias("p")).distinct().withColumn("_pair", F.lit(True))
    ids = state.select(F.col(identity).alias("i")).distinct().withColumn("_id", F.lit(True))
    out = rows.join(pairs, ["i", "p"], "left").join(ids, "i", "left")
    return out.select(F.col("i").alias(identity), F.col("p").alias(payload), F.when(F.col("_pair"), "REPEATED").when(F.col("_id"), "NEW_VERSION").otherwise("NEW").alias("outcome"))


def indexed(batch: DataFrame, state: DataFrame, identity: str, payload: str) -> DataFrame:
    """``state`` with what the batch brought: the upsert of the observation index; applying a batch again changes nothing."""
    cols = [F.col(identity), F.col(payload)]
    return state.select(*cols).unionByName(batch.select(*cols)).distinct()


def in_scope(df: DataFrame, start: datetime.date, end: datetime.date, date: str = "signing_date") -> DataFrame:
    """Rows signed in ``[start, end)``; rows without a date are in no scope."""
    if start >= end:
        raise ValueError("INVERTED_INTERVAL")
    return df.where((F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(end)))


def batches(keys: list, size: int) -> list[list]:
    """Sorted distinct keys in lists of ``size``, as one request may name them."""
    if size < 1:
        raise ValueError("BATCH_SIZE")
    keys = sorted(set(keys))
    return [keys[i : i + size] for i in range(0, len(keys), size)]


def first_row(df: DataFrame, *keys: str) -> DataFrame:
    """The first row by ``keys``; no row of an empty table."""
    return df.orderBy(*keys).limit(1)


def effective_watermark(start: datetime.datetime, checkpoint: datetime.datetime | None, lookback_days: int = 7) -> datetime.datetime:
    return start if checkpoint is None else max(start, checkpoint - datetime.timedelta(days=lookback_days))


def keyset_page(df: DataFrame, watermark: str, key: str, after: tuple | None, limit: int) -> DataFrame:
    """The rows after a cursor in (watermark, key) order; Spark keeps ``limit`` rows a task."""
    if after:
        w, k = (F.lit(x) for x in after)
        df = df.where((F.col(watermark) > w) | ((F.col(watermark) == w) & (F.col(key) > k)))
    return df.where(F.col(watermark).isNotNull()).orderBy(watermark, key).limit(limit)


def cursor_breaks(df: DataFrame, sequence: Column, cursor: Column, run: str) -> DataFrame:
    """Rows whose cursor is not beyond that of the row before them in their run."""
    w = Window.partitionBy(run).orderBy(sequence)
    return df.withColumn("_before", F.lag(cursor).over(w)).where(F.col("_before") >= cursor).drop("_before")


def lanes(df: DataFrame, watermark: str, event: str, start, end) -> DataFrame:
    """Rows of the watermark lane, and those without one by their event date."""
    a = df.where((F.col(watermark) >= F.lit(start)) & (F.col(watermark) < F.lit(end))).withColumn("lane", F.lit("watermark"))
    b = df.where(F.col(watermark).isNull() & (F.col(event) >= F.lit(start)) & (F.col(event) < F.lit(end))).withColumn("lane", F.lit("fallback"))
    return a.unionByName(b)
