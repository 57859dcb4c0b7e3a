import datetime
import decimal
import hashlib
import io
import json
import threading
import urllib.error
import urllib.parse
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from almagest.functions import codecs, exact_json
from almagest.sources import http, runs, store

ROWS = [{"id": f"k{i:03d}", "day": f"2026-01-{i % 4 + 1:02d}T00:00:00" if i % 5 else None, "n": i, "u": {"url": "x"}, "ok": i % 2 == 0} for i in range(40)]


class _Pages(BaseHTTPRequestHandler):
    """Answers the queries of the source from ``ROWS``; every seventh request is turned away."""

    asked = 0

    def do_GET(self):
        type(self).asked += 1
        if type(self).asked % 7 == 0:
            self.send_response(429)
            self.send_header("Retry-After", "0")
            self.end_headers()
            return
        q = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
        rows = ROWS
        for part in q.get("$where", "").split(" AND "):
            if part == "day IS NULL":
                rows = [r for r in rows if r["day"] is None]
            elif part:
                c, op, v = part.split(" ", 2)
                v = v.strip("'")
                rows = [r for r in rows if r[c] is not None and (r[c] >= v if op == ">=" else r[c] < v if op == "<" else r[c] > v)]
        body = json.dumps(sorted(rows, key=lambda r: r["id"])[: int(q["$limit"])]).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = HTTPServer(("127.0.0.1", 0), _Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/rows"
    server.shutdown()


def test_scan_by_windows_and_lane(spark, url):
    spark.dataSource.register(http.JsonPagesSource)
    opts = {"url": url, "fields": "id, day, n, u, ok", "key": "id", "column": "day", "start": "2026-01-01", "end": "2026-01-05", "limit": "3"}
    got = {r.id: r for r in spark.read.format("json_pages").options(**opts).load().collect()}
    assert set(got) == {r["id"] for r in ROWS}
    assert (got["k004"].n, got["k004"].u, got["k004"].ok, got["k005"].day) == ("4", '{"url":"x"}', "true", None)


def _answers(*states):
    left = list(states)

    def opener(url, timeout):
        s = left.pop(0)
        if s == 200:
            return io.BytesIO(b"[]")
        raise urllib.error.HTTPError(url, s, "", {"Retry-After": "7"} if s == 429 else {}, None)

    return opener


def test_retries_and_budget():
    slept = []
    b = http.Budget(10)
    assert http.fetch("u", b, opener=_answers(429, 503, 200), sleep=slept.append) == b"[]"
    assert slept == [7.0, 2.0] and b.used == 3
    with pytest.raises(urllib.error.HTTPError):
        http.fetch("u", b, opener=_answers(404), sleep=slept.append)
    with pytest.raises(http.BudgetSpent):
        http.fetch("u", http.Budget(1), opener=_answers(503, 200), sleep=slept.append)
    with pytest.raises(ValueError, match="BODY_TOO_LARGE"):
        http.fetch("u", b, most_bytes=1, opener=_answers(200))


def test_predicates():
    assert http.predicate({"d": "O'Neil"}, window=("t", "a", "b"), after=("id", "x")) == "d = 'O''Neil' AND t >= 'a' AND t < 'b' AND id > 'x'"
    assert http.predicate(among=("id", [])) == "1 = 0" and http.predicate(null="t") == "t IS NULL" and http.predicate() == ""
    assert http.days("2026-01-01", "2026-01-06", 2) == [("2026-01-01", "2026-01-03"), ("2026-01-03", "2026-01-05"), ("2026-01-05", "2026-01-06")]


def test_cursor_must_advance():
    stuck = lambda url, timeout: io.BytesIO(b'[{"id": "a"}]')
    fetch = http.fetch
    try:
        http.fetch = lambda url, budget: fetch(url, budget, opener=stuck)
        with pytest.raises(ValueError, match="CURSOR_DOES_NOT_ADVANCE"):
            list(http.pages("u", ["id"], "id", 1, http.Budget(9)))
    finally:
        http.fetch = fetch


def test_codecs_round_trip(spark):
    t = datetime.datetime(2026, 1, 2, 3, 4, 5, 678901)
    rows = [("é\n", 7, -(2**63), True, datetime.date(1999, 12, 31), decimal.Decimal("-0.50"), t, t, ["a", None, ""]), ("", 0, 0, False, None, decimal.Decimal("0.00"), None, None, []), (None,) * 9]
    df = spark.createDataFrame(rows, "t string, i int, l bigint, b boolean, d date, m decimal(20,2), w timestamp_ntz, u timestamp, a array<string>")
    back = codecs.decode_all(codecs.encode_all(df), df)
    assert back.schema.simpleString() == df.schema.simpleString() and back.collect() == df.collect()
    assert all(r.faults == 0 for r in codecs.codec_faults(df).collect())
    assert codecs.encode_all(df).first().w == "2026-01-02T03:04:05.678901"


def test_codecs_refuse_other_spellings(spark):
    bad = spark.createDataFrame([("01", "1.5", "yes")], "i string, m string, b string")
    like = spark.createDataFrame([], "i int, m decimal(20,2), b boolean")
    assert codecs.decode_all(bad, like).first() == (None, None, None)
    with pytest.raises(ValueError, match="NO_CODEC"):
        codecs.codec(MapType(StringType(), StringType()))
    assert codecs.codec_faults(like).agg(F.sum("cells")).first()[0] == 0


def test_exact_json():
    text = '[{"a":1.10,"b":1e2,"c":12345678901234567890123456789012345678901234567890,"d":{"x":[1.50,true,null,"é"]},"e":"1"}]'
    value = exact_json.loads(text)
    assert exact_json.dumps(value) == text and exact_json.cell(value[0]["d"]) == '{"x":[1.50,true,null,"é"]}'
    assert [exact_json.cell(value[0][k]) for k in "abe"] == ["1.10", "1e2", "1"] and exact_json.cell(None) is None and exact_json.cell(False) == "false"
    for bad in ('{"a":1,"a":2}', "[1", "[NaN]", ""):
        with pytest.raises(ValueError):
            exact_json.loads(bad)


def test_pages_keep_numbers_and_lose_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n":1.10,"o":{"v":1e2}},{"n":99999999999999999999.5}]')
    (tmp_path / "b.json").write_text("[]")
    rows = store.read_pages(spark, str(tmp_path), ["n", "o", "m"]).orderBy("row_ordinal").collect()
    assert [(r.n, r.o, r.m, r.payload_json) for r in rows] == [("1.10", '{"v":1e2}', None, '{"n":1.10,"o":{"v":1e2}}'), ("99999999999999999999.5", None, None, '{"n":99999999999999999999.5}')]
    (tmp_path / "c.json").write_text('[{"n":1},{"n":2')
    (tmp_path / "d.json").write_text('[{"n":1,"n":2}]')
    (tmp_path / "e.json").write_bytes(b'[{"n":"\xff"}]')
    (tmp_path / "f.json").write_text('{"n":1}')
    got = store.read_pages(spark, str(tmp_path), ["n"], errors=True).collect()
    assert sorted(r.page_path[-6:] for r in got if r.page_error) == ["c.json", "d.json", "e.json", "f.json"] and len(got) == 6
    with pytest.raises(Exception, match="PAGE_ERROR"):
        store.read_pages(spark, str(tmp_path), ["n"]).collect()


def _run(folder, name, pages, **more):
    (folder / name).mkdir()
    said = []
    for i, text in enumerate(pages):
        (folder / name / f"p{i}.json").write_text(text)
        said.append({"path": f"p{i}.json", "sha256": hashlib.sha256(text.encode()).hexdigest(), "rows": len(json.loads(text))})
    m = json.loads(runs.manifest(name, "d", "c1", said)) | more
    (folder / name / "manifest.json").write_text(json.dumps(m))
    return m


def test_runs_are_checked_before_they_are_read(spark, tmp_path):
    root = f"file://{tmp_path}"
    _run(tmp_path, "r2", ['[{"k":"b","v":2.50}]', "[]"])
    _run(tmp_path, "r1", ['[{"k":"a","v":1.10},{"k":"c"}]'])
    _run(tmp_path, "r3", ['[{"k":"x"}]'], status="prepared")
    (tmp_path / "r4").mkdir()
    rows = runs.read_runs(spark, root, "d", ["k", "v"]).collect()
    assert sorted((r.run_id, r.k, r.v) for r in rows) == [("r1", "a", "1.10"), ("r1", "c", None), ("r2", "b", "2.50")]
    assert rows[0].payload_sha256 == hashlib.sha256(rows[0].payload_json.encode()).hexdigest()
    for asked, code in ((["r3"], "NOT_COMMITTED"), (["r4"], "MISSING_MANIFEST"), (["r1", "r1"], "REPEATED_RUN")):
        with pytest.raises(runs.RunEvidence, match=code):
            runs.resolve_runs(spark, root, "d", asked)
    with pytest.raises(runs.RunEvidence, match="OTHER_DATASET"):
        runs.resolve_runs(spark, root, "e")
    with pytest.raises(runs.RunEvidence, match="UNKNOWN_CONTRACT"):
        runs.resolve_runs(spark, root, "d", contracts={"c2"})
    assert runs.recover(spark, root) == ["r3"] and runs.recover(spark, root) == []
    assert [m["run_id"] for m in runs.resolve_runs(spark, root, "d")] == ["r1", "r2", "r3"]
    (tmp_path / "r1" / "p0.json").write_text('[{"k":"a","v":1.1},{"k":"c"}]')
    with pytest.raises(runs.RunEvidence, match="PAGE_HASH r1/p0.json"):
        runs.read_runs(spark, root, "d", ["k"])
    (tmp_path / "r2" / "p1.json").unlink()
    got = runs.page_faults(spark, root, runs.resolve_runs(spark, root, "d")).collect()
    assert sorted((r.run_id, r.fault) for r in got) == [("r1", "PAGE_HASH"), ("r2", "PAGE_MISSING")]
    _run(tmp_path, "r5", ["[]"], written=3)
    with pytest.raises(runs.RunEvidence, match="WRITTEN_COUNT"):
        runs.resolve_runs(spark, root, "d")
    assert runs.resolve_runs(spark, root + "/none", "d") == []


def test_checkpoint_moves_only_for_whole_runs():
    whole = {"status": "committed", "range_complete": True, "truncated": False, "high_watermark": "2026-02"}
    assert runs.advance(None, whole) == runs.advance("2026-01", whole) == "2026-02" and runs.advance("2026-03", whole) == "2026-03"
    for part in ({"status": "failed"}, {"range_complete": False}, {"truncated": True}, {"purpose": "population"}, {"high_watermark": None}):
        assert runs.advance("2026-01", whole | part) == "2026-01"


def test_ledger_keeps_its_budget(spark, tmp_path):
    path = f"file://{tmp_path}/ledger.json"
    book = runs.Ledger(spark, path, 10)
    book.reserve("a", 6)
    assert book.left() == 4
    for run, n, code in (("a", 1, "ALREADY_RESERVED"), ("b", 5, "BUDGET_SPENT")):
        with pytest.raises(runs.RunEvidence, match=code):
            book.reserve(run, n)
    book.charge("a", 2)
    again = runs.Ledger(spark, path, 99)  # a new process finds the book as it was
    assert again.left() == 8
    again.pause()
    with pytest.raises(runs.RunEvidence, match="PAUSED"):
        book.reserve("c", 1)
    again.pause(False)
    book.reserve("c", 8)
    with pytest.raises(runs.RunEvidence, match="NOT_RESERVED"):
        book.charge("c", 9)
    assert book.left() == 0


def test_numeric_cursors():
    rows = [{"id": i} for i in (98, 99, 100, 101)]

    def opener(url, timeout):
        where = urllib.parse.parse_qs(urllib.parse.urlparse(url).query).get("$where", ["id > 0"])[0]
        after = int(where.split("id > ")[1])
        return io.BytesIO(json.dumps([r for r in rows if r["id"] > after][:2]).encode())

    fetch = http.fetch
    try:
        http.fetch = lambda url, budget: fetch(url, budget, opener=opener)
        got = [r["id"] for page in http.pages("u", ["id"], "id", 2, http.Budget(9)) for r in page]
    finally:
        http.fetch = fetch
    assert got == ["98", "99", "100", "101"]
    assert not http._beyond(exact_json.Number("9"), "1") and http._beyond("b", "a") and http._beyond(exact_json.Number("1e2"), exact_json.Number("99.5"))
    assert http.predicate(between=("t", "a", "b")) == "t >= 'a' AND t <= 'b'"


def test_store_refuses_the_second_writer(spark, tmp_path):
    s = store.VersionStore(spark, f"file://{tmp_path}/store")
    a = s.publish(spark.range(4).selectExpr("id", "cast(id % 2 as string) as p"), ["p"])
    assert s.current() == a and s.read().count() == 4 and s.read().where("p = '1'").count() == 2
    other = store.VersionStore(spark, f"file://{tmp_path}/store")
    number = other._pointer
    other._pointer = lambda: (0, None)  # has looked before the first one was there
    with pytest.raises(ValueError, match="CURRENT_CHANGED"):
        other.activate(a)
    other._pointer = number
    with pytest.raises(ValueError, match="UNKNOWN_VERSION"):
        other.activate("nothing")
    b = other.publish(spark.range(2), expect=a)
    assert s.current() == b and s.retain(1, hours=1) == [] and s.retain(1) == [a]
    with pytest.raises(ValueError, match="READ_BACK_COUNT"):
        s._check(f"{s.root}/versions/{b}", spark.range(1).schema, {"n": 3, "keys": None}, [])
    with pytest.raises(ValueError, match="READ_BACK_SCHEMA"):
        s._check(f"{s.root}/versions/{b}", spark.range(1).selectExpr("cast(id as int) as id").schema, {"n": 2, "keys": None}, [])


def test_synthetic_source_replays(spark, tmp_path):
    """Rows by rule, paged as from a network, land in a version that replaces the one before."""
    from almagest.sources import synthetic

    held = [r.asDict() for r in synthetic.rows(spark, 200).collect()]
    assert len(held) == 200 and sum(r["id"] is None for r in held) == 4 and held == [r.asDict() for r in synthetic.rows(spark, 200).collect()]
    fetch = http.fetch
    try:
        http.fetch = lambda url, budget: fetch(url, budget, opener=synthetic.opener(held))
        pages = list(http.pages("u", ["id"], "id", 30, http.Budget(20)))
    finally:
        http.fetch = fetch
    assert [len(p) for p in pages] == [30] * 6 + [16] and sorted(r["id"] for p in pages for r in p) == sorted(r["id"] for r in held if r["id"])
    s = store.VersionStore(spark, f"file://{tmp_path}/v")
    a = s.reload(synthetic.rows(spark, 10))
    b = s.reload(synthetic.rows(spark, 3))
    assert s.current() == b != a and s.read().count() == 3
