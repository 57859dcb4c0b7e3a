"""Codes as texts for readers, by a table of wording that the caller gives.

The table maps a code to its wording, ``*`` to what stands before an unlisted
code, and ``""`` to the text of an empty list. Null is never worded as if it
were empty: it has the wording of ``none``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Default wording; each table may be replaced.
REASONS = {"LEGACY_PROJECTION": "from an older projection", "MISSING_CODE": "no code given", "PLACEHOLDER_CODE": "placeholder instead of a code", "INVALID_CODE": "not a code", "KNOWN": "known", "*": "reason "}
ISSUES = {
    "IDENTIFIER_NULL": "no identifier",
    "AMOUNT_NULL": "no amount",
    "AMOUNT_NEGATIVE": "amount below zero",
    "AMOUNT_INVALID_FORMAT": "amount is no number",
    "AMOUNT_SCALE_EXCEEDED": "amount has over two decimals",
    "AMOUNT_OVERFLOW": "amount out of range",
    "DATE_INVALID": "no such date",
    "DATE_INCONSISTENT": "dates out of order",
    "DEPARTMENT_OUT_OF_SCOPE": "other department",
    "UNKNOWN_MUNICIPALITY": "place not in the catalog",
    "*": "issue ",
    "": "no issues",
}
RELATIONS = {"LATER": "seen later", "EQUAL": "seen at the same time", "EARLIER": "seen earlier", "UNKNOWN": "time unknown", "*": "relation ", "": "no evidence"}
CONDITIONS = {"LATER_INVALID_OBSERVED": "a later invalid observation", "TEMPORAL_ORDER_INDETERMINATE": "order cannot be told", "NO_LATER_INVALID_OBSERVED": "no later invalid observation", "LEGACY_UNASSESSED": "never assessed", "*": "condition "}


def worded(code: Column, words: dict[str, str], none: str = "not stated") -> Column:
    listed = {k: v for k, v in words.items() if k not in ("*", "")}
    pairs = F.create_map(*[F.lit(x) for kv in listed.items() for x in kv])
    return F.when(code.isNull(), none).otherwise(F.coalesce(F.try_element_at(pairs, code), F.concat(F.lit(words.get("*", "")), code)))


def listed(codes: Column, words: dict[str, str] = ISSUES, none: str = "not assessed", between: str = ", ") -> Column:
    """An array of codes; null was not assessed, which differs from none found."""
    return F.when(codes.isNull(), none).when(F.size(codes) == 0, words.get("", "")).otherwise(F.array_join(F.transform(codes, lambda c: worded(c, words)), between))


def identity_text(status: Column, reason: Column, words: dict[str, str] = REASONS) -> Column:
    """The reason, or the status where there is none."""
    return worded(F.coalesce(reason, status), words)


def condition_text(state: Column, later: Column, unclear: Column, words: dict[str, str] = CONDITIONS) -> Column:
    """The state, with its counts where they are not zero."""
    part = lambda n, what: F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {what}")))
    return F.concat_ws(", ", worded(state, words), part(later, "later"), part(unclear, "of unclear order"))


def evidence_text(links: Column, relations: dict[str, str] = RELATIONS, issues: dict[str, str] = ISSUES) -> Column:
    """Of an array of ``struct(relation, rejection_codes)``, a line for each link, in the order given."""
    line = lambda x: F.concat(worded(x["relation"], relations), F.lit(": "), listed(x["rejection_codes"], issues))
    return F.when(links.isNull(), "not assessed").when(F.size(links) == 0, relations[""]).otherwise(F.array_join(F.transform(links, line), "\n"))
