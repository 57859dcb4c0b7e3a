"""Chat formatting with collapse of cumulative snapshots, in DataFrame operations only.

Logs often hold a conversation several times, each time some turns longer. A
turn's hash covers its position, role and text; the running sum of these hashes
(two 64-bit hashes, each summed in halves) names the conversation up to that
turn. A conversation whose last sum is an inner sum of a longer one is a prefix
of it and goes, by an anti-join; of equal conversations the smallest id stays.
Only distinct sums are joined, so a greeting that opens a third of all
conversations is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

TEMPLATE = ("<|{role}|>\n", "\n<|end|>\n")


def _sums() -> list:
    """Turn hashes as four 32-bit parts, safe to add without overflow."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = F.concat(F.col("role").isNull().cast("string"), F.col("text").isNull().cast("string"))
    a, b = F.xxhash64("_pos", role, text, known), F.xxhash64(known, text, F.lit("second"), role, "_pos")
    low = F.lit(0xFFFFFFFF)
    return [x for h in (a, b) for x in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n, last, key``: each turn with its place and prefix hash.

    Turns are ordered by number, role and text, nulls first; rows equal in all
    of them count once. Rows with a null ``conv_id`` belong to no conversation.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("_pos", F.row_number().over(order))
    parts = _sums()
    rows = rows.withColumns({f"_h{i}": p for i, p in enumerate(parts)})
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"_s{i}": F.sum(f"_h{i}").over(run) for i in range(4)})
    rows = rows.withColumn("last", F.lead("_pos").over(order).isNull())
    return rows.select("conv_id", "turn", "role", "text", F.col("_pos").alias("n"), "last", F.concat_ws(":", "_pos", *[f"_s{i}" for i in range(4)]).alias("key"))


def maximal(pre: DataFrame) -> DataFrame:
    """``conv_id, key, n_turns, n_copies`` of the conversations that stay."""
    ends = pre.where("last")
    whole = ends.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("n").alias("n_turns"), F.count("*").alias("n_copies"))
    inner = pre.where("not last").select("key").distinct()
    return whole.join(inner, "key", "left_anti").select("conv_id", "key", "n_turns", "n_copies")


def format_chats(turns: DataFrame, template: tuple[str, str] = TEMPLATE) -> DataFrame:
    """``conv_id, n_turns, n_copies, rendered`` of every maximal conversation.

    A null role or text renders as nothing. Extra columns are ignored; an
    empty table gives an empty result.
    """
    pre = materialize(prefixes(turns), "chat-prefixes")
    stay = maximal(pre)
    head, tail = template
    before, after = head.split("{role}")
    piece = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(after), F.coalesce("text", F.lit("")), F.lit(tail))
    kept = pre.join(stay.drop("key"), "conv_id")
    shown = kept.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("n", piece.alias("p")))).alias("t"))
    return shown.select("conv_id", F.col("n_turns").cast("bigint").alias("n_turns"), "n_copies", F.array_join("t.p", "").alias("rendered"))
