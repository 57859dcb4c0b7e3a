import datetime
import decimal
import json
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from almagest.functions import columns as C
from almagest.operators import checks, digest, silver, temporal
from almagest.plans import metrics as M
from almagest.plans import registry as Q
from almagest.sources import store
from almagest.streaming import events as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
D = decimal.Decimal


def _plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return str(v)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.execute(Q.ORACLE[name])
    names = [x[0] for x in rel.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = sorted(str([_plain(r[names.index(c)]) for c in order]) for r in rel.fetchall())
    got = sorted(str([_plain(r[c]) for c in order]) for r in df.collect())
    assert got == want


def test_anchor_counts(spark):
    r = Q.QUERIES["silver_counts"](spark, SF).first()
    assert (r.input_rows, r.rejected_rows, r.output_rows, r.superseded_versions, r.exact_duplicates) == (6000, 2815, 2656, 529, 0)


def test_amount_and_date_rules(spark):
    rows = [(None, "2026-01-01T00:00:00.000"), ("-1", None), ("COP 10", "2026-02-30T00:00:00.000"), ("1.001", None), ("1234567890123456789.00", None), ("100.000000", None), (" ", None)]
    df = spark.createDataFrame(rows, "a string, d string")
    got = silver.with_rejections(df, silver.amount_rules(F.col("a")) + silver.date_rules({"signing": F.col("d")}, {"signing": C.strict_timestamp(F.col("d"))})).collect()
    assert [r.rejection_codes for r in got] == [["AMOUNT_NULL"], ["AMOUNT_NEGATIVE"], ["AMOUNT_INVALID_FORMAT", "DATE_INVALID"], ["AMOUNT_SCALE_EXCEEDED"], ["AMOUNT_OVERFLOW"], [], ["AMOUNT_NULL"]]


def test_identity_and_dates(spark):
    df = spark.createDataFrame([(" 007 ",), ("0",), (None,), ("n/a",), ("x1",)], "c string").select(C.identity(F.col("c")).alias("i"))
    assert [(r.i.code, r.i.status, r.i.reason) for r in df.collect()] == [("007", "KNOWN", None), (None, "UNKNOWN", "PLACEHOLDER_CODE"), (None, "UNKNOWN", "MISSING_CODE"), (None, "UNKNOWN", "PLACEHOLDER_CODE"), (None, "UNKNOWN", "INVALID_CODE")]
    t = spark.createDataFrame([("2026-01-01T00:00:00.000",), ("2026-01-01T10:00:00.000",), ("no",)], "t string")
    assert [(r[0], r[1]) for r in t.select(C.business_date(F.col("t")), C.business_date(F.col("t"), True)).collect()] == [(datetime.date(2026, 1, 1),) * 2, (datetime.date(2026, 1, 1), None), (None, None)]


def test_version_order(spark):
    d = datetime.date
    rows = [("A", d(2026, 1, 1), 1, "old"), ("A", d(2026, 1, 1), 1, "old"), ("B", None, 1, "first"), ("A", d(2026, 2, 1), 2, "newest"), ("A", d(2025, 12, 1), 2, "late"), ("B", None, 2, "second")]
    df = spark.createDataFrame(rows, "contract_key string, source_updated_at date, fetched_at int, payload_sha256 string")
    assert {r.contract_key: r.payload_sha256 for r in silver.dedupe(df).collect()} == {"A": "newest", "B": "second"}
    c = silver.counters(df.withColumn("rejection_details", F.array())).first()
    assert (c.input_rows, c.exact_duplicates, c.superseded_versions, c.output_rows) == (6, 1, 3, 2)


def _gold(spark):
    """(amount, supplier, month, entity, status)"""
    rows = [("10.01", "A", 1, "1", "b"), ("20.02", "A", 2, "1", "e"), ("90.03", "B", 2, "1", "n"), ("40", "A", 1, "2", "b"), ("40", "B", 1, "2", "b"), ("20", None, 1, "2", "b"), ("0", "A", 1, "3", "b"), ("5", "A", None, "4", None), ("7", "A", 1, None, "b"), ("15", None, 1, "5", "b"), ("0", "A", 1, "6", "b"), ("10", None, 1, "6", "b"), ("40", "A", 1, "7", "b"), ("40", "B", 1, "7", "b")]
    data = [(str(i), e or "?", s or "?", "m", "o", e, s, datetime.date(2026, m, 15) if m else None, D(v), C_status(st)) for i, (v, s, m, e, st) in enumerate(rows)]
    df = spark.createDataFrame(data, "contract_key string, entity_key string, supplier_key string, municipality_key string, modality_key string, entity_natural string, supplier_natural string, signing_date date, value decimal(20,2), status_bucket string")
    return df.withColumns({"signing_month": C.month(F.col("signing_date")), "source_updated_at": F.col("signing_date")})


def C_status(s):
    return s or "__MISSING__"


def test_gold_scenario(spark):
    d = _gold(spark)
    one = M.overview(d, M.Filters(entity_keys=("1",))).first()
    assert (one.contract_count, one.total_value, one.p25, one.median, one.p75) == (3, D("120.06"), D("15.0150"), D("20.0200"), D("55.0250"))
    rows = {r.entity_key: r for r in M.concentration(d).collect()}
    assert rows["1"].hhi == pytest.approx((30.03 / 120.06) ** 2 + (90.03 / 120.06) ** 2, abs=1e-9)
    assert {k: r.hhi_state for k, r in rows.items()} == {"1": "AVAILABLE", "2": "INSUFFICIENT_IDENTITY_COVERAGE", "3": "ZERO_TOTAL_VALUE", "4": "AVAILABLE", "?": "UNKNOWN_ENTITY", "5": "NO_KNOWN_SUPPLIERS", "6": "ZERO_KNOWN_VALUE", "7": "AVAILABLE"}
    loose = {r.entity_key: r for r in M.concentration(d, M.Filters(selected_supplier="B"), min_count=0.5, min_value=0.8).collect()}
    assert (loose["2"].hhi, loose["2"].selected_share, loose["2"].selected_contract_count) == (0.5, 0.5, 1)
    assert {r.hhi_state for r in M.concentration(d, min_count=None).collect()} == {"POLICY_UNCONFIGURED"}
    whole = M.overview(d).first()
    assert (whole.contract_count, whole.total_value) == (14, D("337.06"))
    none = M.overview(d, M.Filters(statuses=("zzz",))).first()
    assert (none.contract_count, none.total_value, none.median, none.quantile_state) == (0, D("0.00"), None, "NO_CONTRACTS")
    cut = M.overview(d, M.Filters(start=datetime.date(2026, 1, 15), end=datetime.date(2026, 2, 15))).first()
    assert cut.contract_count == 11
    assert M.overview(d, M.Filters(missing_signatures=True)).first().contract_count == 1


def test_filter_failures(spark):
    for bad in (dict(statuses=("a",), exclude_statuses=("a",)), dict(start=datetime.date(2026, 2, 1), end=datetime.date(2026, 1, 1)), dict(missing_signatures=True, start=datetime.date(2026, 1, 1))):
        with pytest.raises(ValueError):
            M.Filters(**bad)
    with pytest.raises(ValueError, match="UNKNOWN_ENTITY_KEY"):
        M.query("overview", _gold(spark), M.Filters(entity_keys=("no",)))
    assert M.query("concentration", _gold(spark), limit=3, offset=1).count() == 3


def test_policy_and_selection_guards(spark):
    import hashlib

    policy = {"min_count": 0.5, "min_value": 0.8}
    sha = hashlib.sha256(b'{"min_count":0.5,"min_value":0.8}').hexdigest()
    one = M.entity_concentration(_gold(spark), M.Filters(entity_keys=("2",)), policy, sha).collect()
    assert len(one) == 1 and one[0].hhi == 0.5
    for f, d, code in ((M.Filters(entity_keys=("1", "2")), sha, "ONE_ENTITY_REQUIRED"), (M.NONE, sha, "ONE_ENTITY_REQUIRED"), (M.Filters(entity_keys=("2",)), "0", "POLICY_CHANGED")):
        with pytest.raises(ValueError, match=code):
            M.entity_concentration(_gold(spark), f, policy, d)
    with pytest.raises(ValueError, match="MANY_SUPPLIERS"):
        M.Filters(selected_supplier=("A", "B"))


def test_concentration_of_values_beyond_decimals(spark):
    big = _gold(spark).where("entity_key = '2' and supplier_key <> '?'").withColumn("value", F.lit("999999999999999999.99").cast("decimal(20,2)"))
    r = M.concentration(big).first()
    assert (r.hhi, r.total_value) == (0.5, D("1999999999999999999.98"))


@pytest.mark.parametrize("one_range", [10**6, 0])
def test_quantiles_of_skewed_values(spark, monkeypatch, one_range):
    """One value far out, one value very often, few values, nulls: the ranks are exact, in one range and in many."""
    monkeypatch.setattr(M, "ONE_RANGE", one_range)
    rng = __import__("random").Random(4)
    rows = [("a", D(rng.randint(1, 10**6)) / 100) for _ in range(3000)] + [("a", D("5700000000000.00"))] + [("b", D("7.00"))] * 999 + [("b", D("9.00")), ("c", D("1.01")), ("d", None)]
    df = spark.createDataFrame(rows, "g string, value decimal(20,2)")
    import statistics

    got = {r.g: r for r in M.quantiles(df, ["g"]).collect()}
    for g in "abc":
        v = sorted(x for k, x in rows if k == g)
        want = statistics.quantiles(v, n=4, method="inclusive") if len(v) > 1 else v * 3
        assert [got[g].p25, got[g].median, got[g].p75] == [w.quantize(D("0.0001")) for w in want]
    assert (got["d"].p25, got["d"].median) == (None, None)
    v = sorted(x for _, x in rows if x is not None)
    assert M.quantiles(df).first().median == statistics.median(v).quantize(D("0.0001"))
    assert M.quantiles(df.limit(0)).first().median is None


def test_digest_counts_equal_rows(spark):
    a = spark.range(50_000).select((F.col("id") % 2).alias("k"))
    one = digest.multiset_digest(a, ["k"]).first()
    assert one.rows == 50_000 and one == digest.multiset_digest(a.repartition(7), ["k"]).first()
    assert one.digest != digest.multiset_digest(a.limit(49_999), ["k"]).first().digest


def test_digest_in_sql(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "é;N;")], "k int, v string")
    df.createOrReplaceTempView("digested")
    assert spark.sql(store.digest_sql("digested", ["k", "v"])).first() == digest.multiset_digest(df, ["k", "v"]).first()
    assert spark.sql(store.digest_sql("(select * from digested where false)", ["k", "v"])).first() == digest.multiset_digest(df.limit(0), ["k", "v"]).first()


def test_unknown_place_is_not_the_unknown_member(spark):
    from almagest.operators import star

    rows = spark.createDataFrame([("UNKNOWN", "Unknown"), (None, None), ("X", "x")], "municipality_natural string, municipality string")
    got = star.label_dim(rows, "municipality")
    assert got.select("municipality_key").distinct().count() == got.count() == 3


def test_batches_scope_and_first_row(spark):
    assert temporal.batches([3, 1, 2, 3], 2) == [[1, 2], [3]] and temporal.batches([], 5) == []
    with pytest.raises(ValueError, match="BATCH_SIZE"):
        temporal.batches([1], 0)
    with pytest.raises(ValueError, match="INVERTED_INTERVAL"):
        temporal.in_scope(spark.range(1), datetime.date(2026, 1, 2), datetime.date(2026, 1, 2))
    assert temporal.first_row(spark.range(0), "id").isEmpty()
    b, s = (spark.createDataFrame(r, "i int, p string") for r in ([(1, "a"), (1, "a"), (2, "b")], [(1, "a"), (3, None)]))
    once = temporal.indexed(b, s, "i", "p")
    assert once.count() == 3 == temporal.indexed(b, once, "i", "p").count()


def test_json_documents_of_odd_texts(spark):
    from almagest.functions import json_docs

    df = spark.createDataFrame([('{"a":null,"b":[],"c":{"d":1}}',), ("[1]",), ("no",), (None,), ('{"b":3,"c":7}',)], "t string")
    got = df.select(json_docs.without(F.col("t"), "c").alias("w"), json_docs.listed(F.col("t"), {"b": [{"x": None}], "c": {"d": None}}).alias("l")).collect()
    assert [json.loads(r.w) if r.w else None for r in got][0] == {"a": None, "b": []} and got[2].w is None and got[3].w is None
    assert [r.l for r in got][0] == '{"b":[],"c":{"d":1}}' and got[3].l is None and json.loads(got[4].l) == {}


def test_packages_are_derived_again(spark, tmp_path):
    from almagest.sources import package

    root = f"file://{tmp_path}/pkg"
    a = spark.createDataFrame([(1, "é", D("1.50"), datetime.date(2026, 1, 2)), (2, None, None, None)], "id bigint, t string, m decimal(20,2), d date")
    package.write_package(spark, root, {"a": a, "b": spark.range(5)})
    assert package.package_faults(spark, root, {"a": "id"}).collect() == []
    assert package.read_relation(spark, root, "a", ["id", "m"]).orderBy("id").collect() == [(1, D("1.50")), (2, None)]
    assert package.read_relation(spark, root, "b", ["id"], 1, "id").collect() == [(0,)]
    for args, code in ((("c", ["id"]), "UNKNOWN_RELATION"), (("a", ["x"]), "UNKNOWN_COLUMNS"), (("a", ["id"], 1), "LIMIT_WITHOUT_ORDER")):
        with pytest.raises(ValueError, match=code):
            package.read_relation(spark, root, *args)
    assert {r.codec for r in package.footers(spark, root).collect()} == {"SNAPPY"} and package.codec_problems(spark, root, "ZSTD").count() > 0
    file = next((tmp_path / "pkg" / "b").glob("*.parquet"))
    spark.range(7).selectExpr("cast(id as string) as id").coalesce(1).write.option("compression", "gzip").parquet(f"{root}/b2")
    extra = next((tmp_path / "pkg" / "b2").glob("*.parquet"))
    extra.rename(tmp_path / "pkg" / "b" / "extra.parquet")
    got = {(r.subject, r.fault) for r in package.package_faults(spark, root).collect()}
    assert {("b/extra.parquet", "FILE_ADDED"), ("b", "OTHER_ROWS")} <= got and any(f == "OTHER_CODEC" for _, f in got)
    file.unlink()
    assert (f"b/{file.name}", "FILE_MISSING") in {(r.subject, r.fault) for r in package.package_faults(spark, root).collect()}
    assert package.package_faults(spark, f"{root}/none").collect() == [("manifest.json", "NO_MANIFEST")]
    like = spark.createDataFrame([], "id string")
    assert package.read_files(spark, [str(tmp_path / "pkg" / "b" / "extra.parquet")], like, f"{root}/b").count() == 7
    assert [len(x) for x in package.stream(spark.range(10), 30)] == [3, 3, 3, 1] and list(package.stream(spark.range(0))) == []
    assert package.capture(spark.range(6).withColumn("v", (F.col("id") % 2).cast("string")), {"v": "1"}, f"{root}/cap").count() == 3


def test_public_columns_and_bindings(spark):
    from almagest.operators import evidence as EV

    with pytest.raises(ValueError, match="UNKNOWN_RELATION"):
        EV.public(spark.range(1), "x")
    with pytest.raises(ValueError, match="MISSING_COLUMNS contract_key"):
        EV.public(spark.range(1).withColumn("evidence", F.lit(1)), "evidence")
    s = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 2)], "contract_key string, v int")
    assert sorted(map(tuple, EV.binding_faults(s, s.where("contract_key <> 'c'"), {"v": "v"}).collect())) == [("a", "REPEATED_KEY"), ("c", "NOT_IN_DETAIL")]
    links = spark.createDataFrame([("k", "2", "x"), ("k", "1", "y"), ("k", "1", "y")], "contract_key string, link_id string, page string")
    assert EV.gathered(links, ["link_id"]).collect() == [("k", [("1",), ("2",)])]
    a = spark.createDataFrame([("a", "0")], "contract_key string, sha256 string")
    assert EV.unmet_approvals(s, a, "contract_key", "v").collect() == [("a", "REPEATED")]


def test_large_values_stay_exact(spark):
    df = _gold(spark).limit(1).withColumn("value", F.lit("90071992547639.96").cast("decimal(20,2)"))
    assert M.overview(df).first().total_value == D("90071992547639.96")


def test_checks_find_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert checks.unique(df, "k").count() == 1 and checks.not_null(df, "k").count() == 1
    assert checks.accepted_values(df, "v", ["a"]).count() == 2
    assert checks.relationships(df, "k", df.where("v = 'x'"), "k").count() == 2
    assert checks.bijection(df.where("k is not null"), "k", "v").count() == 1
    assert checks.reconciles(df, df.where("v <> 'b'"), "v", ["k"]).count() == 1
    assert checks.schema_problems(df, df.schema) == [] and checks.schema_problems(df.select("v", "k"), df.schema)


def test_digest_ignores_order_not_content(spark):
    a = spark.range(100).withColumn("s", F.col("id").cast("string"))
    one = lambda df: digest.multiset_digest(df, ["id", "s"]).first()
    assert one(a) == one(a.orderBy(F.desc("id")))
    assert one(a).digest != one(a.union(a.limit(1))).digest
    assert one(a.limit(0)).rows == 0
    assert digest.bag_difference(a, a).isEmpty()


def test_watermark():
    t = datetime.datetime
    assert temporal.effective_watermark(t(2026, 1, 1), t(2026, 2, 1)) == t(2026, 1, 25)
    assert temporal.effective_watermark(t(2026, 1, 1), None) == t(2026, 1, 1)


def test_pages_store_export(spark, tmp_path):
    page = [{"id": "A", "n": 10.10, "o": {"url": "x"}, "b": True}, {"id": None}]
    (tmp_path / "p.json").write_text(json.dumps(page).replace("10.1", "10.10"))
    rows = store.read_pages(spark, str(tmp_path / "p.json"), ["id", "n", "o", "b"]).orderBy("row_ordinal").collect()
    assert (rows[0].id, rows[0].o, rows[0].b, rows[1].id, rows[1].row_ordinal) == ("A", '{"url":"x"}', "true", None, 1)
    s = store.VersionStore(spark, f"file://{tmp_path}/store")
    assert s.current() is None
    a = s.publish(spark.range(3))
    b = s.publish(spark.range(5), expect=a)
    assert s.current() == b and s.read().count() == 5 and s.read(a).count() == 3
    with pytest.raises(ValueError, match="CURRENT_CHANGED"):
        s.activate(a, expect=a)
    s.activate(a, expect=b)
    assert s.read().count() == 3
    s.publish(spark.range(1))
    assert len(s.retain(1)) == 2
    d = spark.createDataFrame([(1, datetime.date(2026, 1, 2)), (2, None)], "id int, signing_date date")
    store.export_months(d, f"{tmp_path}/out")
    back = spark.read.option("partitionColumnTypeInference.enabled", "false").parquet(f"{tmp_path}/out")
    assert {(r.id, r.signing_month_partition) for r in back.collect()} == {(1, "01"), (2, "unknown")} or back.count() == 2
    assert "PARTITIONED BY" in store.ddl("t", back.schema, ["signing_year_partition", "signing_month_partition"], "s3://x")


def test_stream_equals_batch(spark, tmp_path):
    src = f"{tmp_path}/in"
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.repartition(3).write.parquet(src)
    stream = E.event_stream(spark, src, ev.schema, files_per_batch=100)  # at once: else rows over 7 days late would go
    E.run_available(E.deduplicated(stream), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert spark.read.parquet(f"{tmp_path}/out").select("event_id").distinct().count() == ev.select("event_id").distinct().count()
    seen = []
    E.for_each_batch(stream, lambda df, n: seen.append(df.count()), f"{tmp_path}/cp3")
    assert sum(seen) == ev.count()
