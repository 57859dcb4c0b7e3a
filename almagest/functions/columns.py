"""Column helpers: text, codes, amounts, dates, keys, canonical cells, exact ratios and quantiles.

Everything is built from Spark functions, so it stays in generated code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\u001f"
#: Spellings of "no code".
PLACEHOLDERS = ("0", "-1", "N/A", "NA", "NULL", "NO DEFINIDO", "NO APLICA")
MONEY = "decimal(20,2)"
#: White space of Unicode, of which Java's \\s knows the ASCII part.
SPACE = r"[\s\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_NORMALIZER = "com.ibm.icu.text.Normalizer"


def _normal(c: Column, method: str, compatible: bool) -> Column:
    """A Unicode normal form by the ICU that Spark brings; plain ASCII is left as it is."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.reflect(F.lit(_NORMALIZER), F.lit(method), c, F.lit(compatible))).otherwise(c)


def clean_text(c: Column) -> Column:
    """NFC, runs of white space as one space, trimmed; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(_normal(c, "compose", False), SPACE, " ")), F.lit(""))


def canonical_text(c: Column) -> Column:
    return F.lower(clean_text(c))


def territory_key(c: Column) -> Column:
    """Upper case, compatibility forms taken apart, without marks; for names that are compared."""
    return F.upper(F.regexp_replace(_normal(clean_text(c), "decompose", True), r"\p{M}+", ""))


def identity(raw: Column, legacy: Column | None = None) -> Column:
    """``struct(code, status, reason)``: the first reason that applies, else KNOWN with the trimmed code."""
    code = F.trim(raw)
    none = F.lit(None).cast("string")
    make = lambda value, status, reason: F.struct(value.alias("code"), F.lit(status).alias("status"), F.lit(reason).cast("string").alias("reason"))
    out = F.when(legacy, make(none, "UNKNOWN", "LEGACY_PROJECTION")) if legacy is not None else F.when(F.lit(False), make(none, "UNKNOWN", "LEGACY_PROJECTION"))
    return (
        out.when(code.isNull() | (code == ""), make(none, "UNKNOWN", "MISSING_CODE"))
        .when(F.upper(code).isin(*PLACEHOLDERS), make(none, "UNKNOWN", "PLACEHOLDER_CODE"))
        .when(~code.rlike("^[0-9]+$"), make(none, "UNKNOWN", "INVALID_CODE"))
        .otherwise(make(code, "KNOWN", None))
    )


def amount(raw: Column) -> Column:
    """Money of an accepted spelling; null for any other and on overflow."""
    t = F.trim(raw)
    return F.when(t.rlike(r"^\+?\d+(\.\d{1,2}0*)?$"), t.try_cast(MONEY))


def strict_timestamp(raw: Column) -> Column:
    """A source time of the one accepted shape, with exactly three decimals and nothing around it; else null."""
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}\z"), raw.try_cast("timestamp_ntz"))


def business_date(raw: Column, midnight_only: bool = False) -> Column:
    """The written calendar date of a source time; the older policy takes midnight only."""
    ts = strict_timestamp(raw)
    day = ts.cast("date")
    return F.when(ts == day.cast("timestamp_ntz"), day) if midnight_only else day


def date_key(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "yyyyMMdd").cast("int"), F.lit(0))


def month(d: Column) -> Column:
    return F.trunc(d, "MM")


def year_text(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "yyyy"), F.lit("unknown"))


def contract_key(dataset: str, source_id: Column, rule: str = "silver-key-v1") -> Column:
    return F.sha2(F.concat_ws(UNIT, F.lit(rule), F.lit(dataset), source_id), 256)


def natural_key(dataset: str, role: str, code: Column) -> Column:
    """A JSON array as text with a space after commas."""
    return F.concat(F.lit(f'["{dataset}", "{role}", "'), code, F.lit('"]'))


def surrogate(namespace: str, key: Column) -> Column:
    """md5 of a versioned namespace and a natural key; the null key has a namespace of its own, so no spelling meets it."""
    return F.md5(F.coalesce(F.concat(F.lit(namespace + UNIT), key), F.lit(namespace + "/unknown")))


def cell(c: Column) -> Column:
    """A framed value: ``N;`` or ``V<bytes>:<value>;``; no two rows of cells look alike."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.lit("V"), F.octet_length(s).cast("string"), F.lit(":"), s, F.lit(";")), F.lit("N;"))


def row_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(cell, columns)), 256)


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double, null on a zero or null denominator: one division, at the end."""
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def exact_quantile(values: Column, numerator: int, denominator: int) -> Column:
    """Linear interpolation at ``(n - 1) p`` in decimals over a sorted array; null if it is empty."""
    n = F.size(values)
    h = (n - 1) * numerator
    low = F.floor(h / denominator).cast("int")
    rest = (h % denominator).cast("decimal(10,0)")
    a = F.get(values, low)
    b = F.get(values, F.least(low + 1, n - 1))
    return F.when(n > 0, a + ((b - a) * rest / F.lit(denominator).cast("decimal(10,0)")).cast("decimal(24,4)")).cast("decimal(24,4)")


def quantile_state(count: Column, values: Column) -> Column:
    return F.when(count == 0, "NO_CONTRACTS").when(F.size(values) == 0, "NO_NON_NULL_VALUES").otherwise("AVAILABLE")


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda x, y: x | y, [~a.eqNullSafe(b) for a, b in pairs])


def url_state(c: Column) -> Column:
    return F.when(c.isNull() | (F.trim(c) == ""), "MISSING").when(c.rlike(r"^https?://[^\s]+$"), "AVAILABLE").otherwise("DISALLOWED")


def status_bucket(c: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("__MISSING__"))


def json_url(c: Column) -> Column:
    """The address in a JSON object's ``url`` or ``uri``, or the text itself."""
    looks = F.trim(c).startswith("{")
    return clean_text(F.when(looks, F.coalesce(F.get_json_object(c, "$.url"), F.get_json_object(c, "$.uri"))).otherwise(c))
