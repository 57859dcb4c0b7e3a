"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every window of w consecutive k-word grams the one with the smallest hash
(the last of equals) is a fingerprint. A span of k + w - 1 words has a window
of its own, so whatever that long stands in a document and in an item has the
same fingerprint at the same place in both. Fingerprints are joined, each with
the words around it, and a hit is extended to both sides; what is long enough
is a shared span, and every shared window of an item lies in such a span.

Items of 13 words or more ask for spans of 13; shorter items for their whole
length, so w shrinks to the shortest item of at least k words, and items under
k words are grams of their own length (every position is a fingerprint).

A document is known by its id and a 128-bit hash of its text, so nothing rests
on the order in which rows are read; equal rows are one until the end. A hit
carries the number of its fingerprint's surroundings, not the items that have
them: items are looked up once for each set of surroundings that some document
holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SPAN, GRAM = 13, 5
#: Fingerprints of the benchmark up to which they are broadcast, and the bytes of their words and item ids.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 100 << 20
#: Bits of the filter that spares most fingerprints of documents the join: eight for each fingerprint of the benchmark, between these.
SIEVE_BITS = (12, 22)
#: Parts that each fingerprint is dealt to where the benchmark is too large to broadcast.
SALTS = 16
#: Distinct sets of hits up to which their items' digests are broadcast (100 bytes each).
BROADCAST_SETS = 200_000
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters, but A-Z, that lower() may change; without one, lower() is the quick way.
_CASED = r"[\p{Lu}\p{Lt}\p{Nl}\x{24B6}-\x{24CF}&&[^A-Z]]"


def words(text):
    """Words of a text after lower-casing A-Z; none for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(text.rlike(_CASED), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, GAPS, -1), "")


def _grams(hashes: str, k: int) -> str:
    if k == 1:
        return hashes
    return f"if(size({hashes}) < {k}, array(), transform(sequence(1, size({hashes}) - {k - 1}), i -> xxhash64(slice({hashes}, i, {k}))))"


def _packed(grams: str) -> str:
    """Of each gram its hash's upper half and, to order equals, its place from the end."""
    return f"transform({grams}, (g, i) -> (g & -4294967296L) | (2147483647L - i))"


def _chosen(grams: str, packed: str, w: int) -> str:
    """Places (from 0) of the fingerprints."""
    if w == 1:
        return f"if(size({grams}) = 0, array(), sequence(0, size({grams}) - 1))"
    windows = f"transform(sequence(1, size({packed}) - {w - 1}), i -> array_min(slice({packed}, i, {w})))"
    return f"if(size({packed}) < {w}, array(), transform(array_distinct({windows}), m -> cast(2147483647L - (m & 4294967295L) as int)))"


SHAPE = "array<struct<fp:bigint,at:int,pre:int,near:array<string>>>"


def _fingerprinted(df: DataFrame, k: int, w: int, reach: int, sentinel: bool, sieve: str | None = None) -> DataFrame:
    """A row for each fingerprint: ``fp``, ``at``, and the words around it, ``near``, of which ``pre`` stand before.

    With ``sentinel`` also a row with null ``at`` for each row of ``df``. Of
    the fingerprints, those go on that the sieve lets through.
    """
    base = df.withColumn("_h", F.expr("transform(_w, x -> xxhash64(x))")).withColumn("_g", F.expr(_grams("_h", k)))
    if w > 1:
        base = base.withColumn("_p", F.expr(_packed("_g")))
    at = _chosen("_g", "_p", w)
    base = base.withColumn("_at", F.expr(f"filter({at}, p -> {sieve})" if sieve else at))
    rows = f"cast(transform(_at, p -> named_struct('fp', _g[p], 'at', p, 'pre', least(p, {reach}), 'near', slice(_w, greatest(p - {reach}, 0) + 1, least(p, {reach}) + {k + reach}))) as {SHAPE})"
    if sentinel:
        rows = f"concat(cast(array(named_struct('fp', null, 'at', null, 'pre', null, 'near', null)) as {SHAPE}), {rows})"
    keep = [c for c in df.columns if c != "_w"]
    return base.select(*keep, F.explode(F.expr(rows)).alias("_f")).select(*keep, "_f.*")


def _sieve(prints: DataFrame, rows: int) -> str:
    """A test on ``_g[p]`` that all fingerprints of the items pass: a Bloom filter sized by their number.

    It is a literal of at most 2 ** 22 / 64 numbers, whatever the benchmark's size.
    """
    size = min(max((8 * rows).bit_length(), SIEVE_BITS[0]), SIEVE_BITS[1])
    words = (1 << size) // 64
    got = prints.select(F.expr(f"cast(shiftrightunsigned(fp, 6) & {words - 1} as int)").alias("w"), F.expr("shiftleft(1L, cast(fp & 63 as int))").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).collect()
    bits = [0] * words
    for r in got:
        bits[r.w] = r.m
    return f"shiftright(from_json('{bits}', 'array<bigint>')[cast(shiftrightunsigned(_g[p], 6) & {words - 1} as int)], cast(_g[p] & 63 as int)) & 1L = 1L"


def _common(a: str, b: str) -> str:
    """Length of the common start of two arrays of words."""
    at = f"array_position(zip_with({a}, {b}, (x, y) -> x <=> y), false)"
    return f"if({at} = 0, size({a}), cast({at} as int) - 1)"


def _spans(docs: DataFrame, items: DataFrame, k: int, w: int, sentinel: bool) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with ``_start, _end, _ctx, _len`` of their shared spans, and the sentinels; and the items, ``ctx, need, item_id``, of all surroundings."""
    reach = SPAN - k if k == GRAM else 0
    ctx = F.expr(f"unhex(md5(cast(concat({k}, ' ', pre, ' ', array_join(near, ' ')) as binary)))").alias("ctx")
    every = materialize(_fingerprinted(items, k, w, reach, False).select(ctx, "fp", "pre", "near", F.col("_need").alias("need"), "item_id").distinct(), "winnow-items")
    core = lambda near, pre: f"slice({near}, {pre} + 1, {k})"
    before = lambda near, pre: f"reverse(slice({near}, 1, {pre}))"
    after = lambda near, pre: f"slice({near}, {pre} + {k + 1}, {reach})"
    prints = every.groupBy("ctx", "fp", "pre", "near").agg(F.min("need").alias("need"))
    prints = prints.select("ctx", "fp", F.expr(before("near", "pre")).alias("i_pre"), F.expr(core("near", "pre")).alias("i_core"), F.expr(after("near", "pre")).alias("i_post"), "need")
    prints = materialize(prints, "winnow-prints")
    weight = "aggregate(concat(i_pre, i_core, i_post), 0L, (a, x) -> a + octet_length(x) + 24) + 64"
    rows, size = prints.agg(F.count("*"), F.coalesce(F.sum(F.expr(weight)), F.lit(0))).first()
    small = rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    left, right = _common(before("near", "pre"), "i_pre"), _common(after("near", "pre"), "i_post")
    near = F.expr(f"{core('near', 'pre')} = i_core and {left} + {k} + {right} >= need")
    d = _fingerprinted(docs, k, w, reach, sentinel and small, _sieve(prints, rows))
    i = prints.withColumnRenamed("fp", "i_fp")
    cond = (F.col("fp") == F.col("i_fp")) & near
    if small:  # a checked size
        joined = d.join(F.broadcast(i), cond, "left").where("at is null or i_fp is not null") if sentinel else d.join(F.broadcast(i), cond)
    else:  # a fingerprint that stands everywhere is dealt to several tasks
        d = d.withColumn("_salt", F.pmod(F.xxhash64("_t1", "at"), F.lit(SALTS)).cast("int"))
        joined = d.join(i.withColumn("i_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), cond & (F.col("_salt") == F.col("i_salt")))
    keep = [c for c in docs.columns if c != "_w"]
    out = joined.select(*keep, F.expr(f"at - ({left})").cast("int").alias("_start"), F.expr(f"at + {k} + ({right})").cast("int").alias("_end"), "ctx")
    if sentinel and not small:
        out = out.union(docs.select(*keep, F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("binary")))
    return out, every.select("ctx", "need", "item_id")


def _repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, without a list of that length."""
    many = df.withColumn("_block", F.explode(F.expr(f"sequence(0L, ({times} - 1) div 10000)")))
    return many.withColumn("_one", F.explode(F.expr(f"sequence(1L, least(10000L, {times} - _block * 10000))")))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row.

    Null texts and texts without words have no words and no hits; items
    without words have no window; items that repeat an id count once. Every
    row of ``docs`` has its own result, also if ids repeat or are null. Extra
    columns are ignored; an empty benchmark hits nothing.
    """
    if span != SPAN:
        raise ValueError("the context carried with a fingerprint is for spans of 13 words")
    own = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("_w")).where(F.size("_w") > 0).withColumn("_need", F.least(F.size("_w"), F.lit(SPAN)))
    own = materialize(own, "winnow-benchmark")
    lengths = sorted(r[0] for r in own.select("_need").distinct().collect())  # 13 values at most
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit("second"), text).alias("_t2"), words(text).alias("_w")).withColumn("_n", F.size("_w"))
    long = [n for n in lengths if n >= GRAM]
    found, members = _spans(rows, own.where(F.col("_need") >= GRAM), GRAM, (min(long) if long else SPAN) - GRAM + 1, True)
    for n in (n for n in lengths if n < GRAM):
        more, of = _spans(rows, own.where(F.col("_need") == n), n, 1, False)
        found, members = found.union(more), members.union(of)
    hit = F.col("_start").isNotNull()
    per = found.groupBy("doc_id", "_t1", "_t2", "_n").agg(
        F.count_if(~hit).alias("_copies"),
        F.collect_set(F.when(hit, F.struct(F.col("_start").alias("s"), F.col("_end").alias("e")))).alias("_s"),
        F.collect_set(F.when(hit, F.struct("ctx", (F.col("_end") - F.col("_start")).alias("len")))).alias("_c"),
    )
    union = "aggregate(array_sort(_s), named_struct('n', 0, 'to', 0), (a, x) -> named_struct('n', a.n + greatest(0, x.e - greatest(x.s, a.to)), 'to', greatest(a.to, x.e)), a -> a.n)"
    per = per.select("doc_id", F.col("_n").cast("bigint").alias("n_words"), F.expr(union).cast("bigint").alias("n_hit"), "_copies", F.when(F.size("_c") > 0, F.array_sort("_c")).alias("_c"))
    per = per.withColumn("_sig", F.when(F.col("_c").isNotNull(), F.md5(F.to_json(F.struct("_c")).cast("binary"))))
    per = materialize(per, "winnow-hits")
    sets = per.where("_sig is not null").groupBy("_sig").agg(F.first("_c").alias("_c"))
    own_items = sets.select("_sig", F.explode("_c").alias("_x")).select("_sig", F.col("_x.ctx").alias("ctx"), F.col("_x.len").alias("_len")).join(members, "ctx").where("need <= _len").groupBy("_sig").agg(F.array_sort(F.collect_set("item_id")).alias("_i"))
    own_items = materialize(own_items.select("_sig", F.size("_i").cast("bigint").alias("n_items"), F.sha2(F.array_join("_i", ",").cast("binary"), 256).alias("items_sha256")), "winnow-sets")
    side = F.broadcast(own_items) if own_items.count() <= BROADCAST_SETS else own_items  # a checked size
    hits = per.where("_sig is not null").join(side, "_sig").select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "_copies")
    none = per.where("_sig is null").select("doc_id", "n_words", "n_hit", F.lit(0).cast("bigint").alias("n_items"), F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256"), "_copies")
    out = _repeated(hits.union(none), "_copies")
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
