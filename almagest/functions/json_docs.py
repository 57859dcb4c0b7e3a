"""JSON documents in text columns: without some keys, or with listed parts only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without(doc: Column, *keys: str) -> Column:
    """An object without some of its keys; null for text that is no object."""
    fields = F.from_json(doc, "map<string,variant>")
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*keys)), {"ignoreNullFields": "false"})


def _listed(value: Column, parts) -> Column:
    if parts is None:
        return value
    if isinstance(parts, list):
        return F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: _listed(x, parts[0]))
    return F.when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), F.struct(*[_listed(F.try_variant_get(value, f"$.{k}", "variant"), p).alias(k) for k, p in parts.items()]))


def listed(doc: Column, parts: dict) -> Column:
    """The parts of a document that a list names, at every depth; what it does not name is not there.

    ``parts``: for each key None (the value as it is), a dict (an object) or a
    list of one (each element). A value of another kind than listed, and null,
    leave the key out; null for text that is no JSON.
    """
    return F.to_json(_listed(F.try_parse_json(doc), parts))
