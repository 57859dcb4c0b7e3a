"""Paged HTTP acquisition as a Spark data source, with retries and request budgets.

``spark.dataSource.register(JsonPagesSource)`` makes ``format("json_pages")``
known. A scan is planned as windows of the event column; each window is one
task that pages through it by key, so no task depends on another's cursor and a
lost executor repeats its own window only.
"""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from almagest.functions import exact_json

#: HTTP states worth another try.
RETRIED = (408, 429, 500, 502, 503, 504)


class BudgetSpent(RuntimeError):
    """No request is left; what has been read so far stands."""


@dataclasses.dataclass
class Budget:
    """Requests that may still be made; every try counts, also a failed one."""

    requests: int
    used: int = 0

    def take(self) -> None:
        if self.used >= self.requests:
            raise BudgetSpent(f"{self.used} of {self.requests} requests used")
        self.used += 1


def quote(value: str) -> str:
    """A literal of the query language: numbers as written, text in quotes, of which one inside is doubled."""
    return str(value) if isinstance(value, exact_json.Number) else "'" + value.replace("'", "''") + "'"


def predicate(equals: dict[str, str] | None = None, null: str | None = None, window: tuple[str, str, str] | None = None, between: tuple[str, str, str] | None = None, among: tuple[str, list[str]] | None = None, after: tuple[str, str] | None = None) -> str:
    """A conjunction: equalities, a null test, a half-open window, a closed range of the watermark, a list of values, a key cursor."""
    parts = [f"{c} = {quote(v)}" for c, v in (equals or {}).items()]
    if null:
        parts.append(f"{null} IS NULL")
    if window:
        c, start, end = window
        parts.append(f"{c} >= {quote(start)} AND {c} < {quote(end)}")
    if between:
        c, start, end = between
        parts.append(f"{c} >= {quote(start)} AND {c} <= {quote(end)}")
    if among:
        parts.append(f"{among[0]} IN ({', '.join(map(quote, among[1]))})" if among[1] else "1 = 0")
    if after:
        parts.append(f"{after[0]} > {quote(after[1])}")
    return " AND ".join(parts)


def fetch(url: str, budget: Budget, tries: int = 5, most_bytes: int = 64 << 20, timeout: float = 30.0, opener: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body of ``url``.

    Tries again on ``RETRIED`` states and lost connections, after the time the
    server asks for or else 1, 2, 4 ... seconds, a minute at most. Any other
    state fails at once, as does a body of more than ``most_bytes``.
    """
    for n in range(tries):
        budget.take()
        wait = min(60.0, 2.0**n)
        try:
            with opener(url, timeout=timeout) as got:
                body = got.read(most_bytes + 1)
            if len(body) > most_bytes:
                raise ValueError("BODY_TOO_LARGE")
            return body
        except urllib.error.HTTPError as error:
            if error.code not in RETRIED or n + 1 == tries:
                raise
            asked = (error.headers or {}).get("Retry-After") or ""
            wait = min(60.0, float(asked)) if asked.isdigit() else wait
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if n + 1 == tries:
                raise
        sleep(wait)
    raise ValueError("NO_TRIES")


def days(start: str, end: str, step: int) -> list[tuple[str, str]]:
    """Half-open windows of ``step`` days that cover ``[start, end)``."""
    a, z, out = datetime.date.fromisoformat(start), datetime.date.fromisoformat(end), []
    while a < z:
        b = min(z, a + datetime.timedelta(days=step))
        out.append((a.isoformat(), b.isoformat()))
        a = b
    return out


def _beyond(a: str, b: str) -> bool:
    """Whether a key comes after another: numbers by value, texts by code point; never across kinds."""
    if isinstance(a, exact_json.Number) != isinstance(b, exact_json.Number):
        return False
    return decimal.Decimal(a) > decimal.Decimal(b) if isinstance(a, exact_json.Number) else a > b


def pages(url: str, fields: list[str], key: str, limit: int, budget: Budget, **where) -> Iterator[list[dict]]:
    """Pages in key order until a short one; each starts after the last key of the one before."""
    after = None
    while True:
        asked = {"$select": ", ".join(fields), "$order": key, "$limit": str(limit)}
        cond = predicate(**where, after=after)
        if cond:
            asked["$where"] = cond
        rows = exact_json.loads(fetch(f"{url}?{urllib.parse.urlencode(asked)}", budget))  # numbers keep the spelling of the page
        if not isinstance(rows, list):
            raise ValueError("PAGE_IS_NO_ARRAY")
        yield rows
        if len(rows) < limit:
            return
        last = rows[-1].get(key)
        if last is None or after and not _beyond(last, after[1]):
            raise ValueError("CURSOR_DOES_NOT_ADVANCE")
        after = (key, last)


class _Window(InputPartition):
    def __init__(self, start: str | None, end: str | None):
        super().__init__((start, end))
        self.start, self.end = start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], fields: list[str]):
        self.url, self.key, self.column = options["url"], options["key"], options.get("column")
        self.start, self.end, self.step = options.get("start"), options.get("end"), int(options.get("days", "1"))
        self.limit, self.requests, self.fields = int(options.get("limit", "1000")), int(options.get("requests", "100")), fields

    def partitions(self) -> list[InputPartition]:
        if not self.column:
            return [_Window(None, None)]
        out: list[InputPartition] = [_Window(a, b) for a, b in days(self.start, self.end, self.step)]
        return [*out, _Window(None, None)]  # rows without the event column have a lane of their own

    def read(self, partition: _Window) -> Iterator[tuple]:
        where: dict = {}
        if self.column:
            where = {"window": (self.column, partition.start, partition.end)} if partition.start else {"null": self.column}
        for page in pages(self.url, self.fields, self.key, self.limit, Budget(self.requests), **where):
            for row in page:
                yield tuple(exact_json.cell(row.get(f)) for f in self.fields)


class JsonPagesSource(DataSource):
    """Options: ``url``, ``fields`` (comma-separated, all text), ``key``; to cut the scan ``column``, ``start``, ``end``, ``days``; ``limit`` rows a page, ``requests`` a window."""

    @classmethod
    def name(cls) -> str:
        return "json_pages"

    def _fields(self) -> list[str]:
        return [f.strip() for f in self.options["fields"].split(",")]

    def schema(self) -> str:
        return ", ".join(f"`{f}` string" for f in self._fields())

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), self._fields())
