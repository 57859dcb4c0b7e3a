"""Queries of evidence, bound snapshots, public columns and JSON documents."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from almagest.functions import codecs, json_docs, presentation
from almagest.operators import evidence as EV
from almagest.operators import receipts, silver, temporal
from almagest.plans import adapter as A
from almagest.plans import metrics as M
from almagest.plans.audits import _first
from almagest.plans.queries import _BUILT, _LINKS, _q
from almagest.sources import runs
from almagest.sources.store import scratch_dir, write_text


def _links(spark, d):
    return temporal.rejection_links(A.valid(spark, d), silver.rejected(A.checked(spark, d)))


@_q(f", {_LINKS}, l as (select distinct contract_key, relation, sha256(concat_ws(chr(31), contract_key, payload_sha256, relation)) as link_id from lk), g as (select contract_key, count(*) as n, '[' || string_agg('{{\"link_id\":\"' || link_id || '\",\"relation\":\"' || relation || '\"}}', ',' order by link_id) || ']' as e from l group by 1) select v.contract_key, coalesce(n, 0) as links, coalesce(e, '[]') as evidence from valid v left join g on v.contract_key = g.contract_key")
def detail_evidence(spark, d):
    """Contracts with their rejected observations as one ordered array."""
    out = EV.with_evidence(A.valid(spark, d).select("contract_key"), EV.gathered(_links(spark, d), ["link_id", "relation"]))
    return out.select("contract_key", F.size("evidence").cast("bigint").alias("links"), F.to_json("evidence").alias("evidence"))


#: Companions of three snapshots; one snapshot is active, and one of its companions has another scope.
_COMPANIONS = [("v1", "m1", None, "COVERED"), ("v1", "m1", "s1", "OTHER_SCOPE"), ("v0", "m0", None, "OLD"), ("v1", "m0", None, "OTHER_MANIFEST")]


@_q(", c(v, m, s, coverage_state) as (values ('v1', 'm1', null, 'COVERED'), ('v1', 'm1', 's1', 'OTHER_SCOPE'), ('v0', 'm0', null, 'OLD'), ('v1', 'm0', null, 'OTHER_MANIFEST')), d as (select contract_key, 'v1' as v, 'm1' as m, case when contract_key[1] = 'b' then 's1' when contract_key[1] = 'c' then 's2' end as s from valid where contract_key[1] <> 'd') select c.coverage_state, count(*) as rows from d join c on d.v = c.v and d.m = c.m and d.s is not distinct from c.s group by 1")
def detail_bound(spark, d):
    """Detail rows of the active snapshot with the companion of their scope; no scope matches no scope."""
    c = spark.createDataFrame(_COMPANIONS, "silver_version_id string, silver_manifest_sha256 string, scope_id string, coverage_state string")
    rows = EV.lineage(A.valid(spark, d).select("contract_key"), "v1", "m1")
    rows = rows.withColumns({"scope_id": F.when(_first() == "b", "s1").when(_first() == "c", "s2"), "silver_version_id": F.when(_first() == "d", "v9").otherwise(F.col("silver_version_id"))})
    return EV.bound(EV.active(rows, c), c, ["coverage_state"]).groupBy("coverage_state").agg(F.count("*").alias("rows"))


@_q("select contract_key, entity_key, supplier_key, municipality_key, modality_key, signing_date, end_date, signing_month, duration_days, value, status_bucket, source_updated_at, 'COP_NOMINAL_OBSERVED' as value_unit, 'LATEST_OBSERVED_BY_SIGNING_DATE' as temporal_basis, payload_sha256 from det")
def public_detail(spark, d):
    """the public columns of the detail mart."""
    return EV.public(EV.lineage(A.detail(spark, d).withColumn("page_path", F.lit("/private")), "v1", "m1"), "contract_detail")


#: A document of each event; JSON numbers are whole or have one decimal.
_DOC = """concat('{"k":', event_id, ',"page_path":"/p/', user_id, '","o":{"a":[1,2.5],"secret":"s"},"l":[{"x":', event_id % 7, ',"y":0},{"y":1}],"t":"é"}')"""


@_q("""select event_id, event_id as k, 's' as secret, event_id % 7 as x, 'é' as t, true as path_gone, '{"k":' || event_id || ',"o":{"a":[1,2.5]},"l":[{"x":' || event_id % 7 || '},{}]}' as listed from events""", base=False)
def json_documents(spark, d):
    """Documents without a key, and with listed parts only, at every depth."""
    e = A.table(spark, d, "events").select("event_id", F.expr(_DOC).alias("doc"))
    out = e.select("event_id", json_docs.without(F.col("doc"), "page_path").alias("w"), json_docs.listed(F.col("doc"), {"k": None, "o": {"a": None}, "l": [{"x": None}], "z": None}).alias("listed"))
    at = lambda p: F.get_json_object("w", p)
    return out.select("event_id", at("$.k").cast("bigint").alias("k"), at("$.o.secret").alias("secret"), at("$.l[0].x").cast("bigint").alias("x"), at("$.t").alias("t"), at("$.page_path").isNull().alias("path_gone"), "listed")


@_q(", s as (select contract_key, value, status from valid where contract_key[1] <> 'e'), t as (select contract_key, case when contract_key[1] = '1' then cast(value + 1 as decimal(20,2)) else value end as value, case when contract_key[1] = '2' then null else status end as status from valid where contract_key[1] <> 'f') select coalesce(s.contract_key, t.contract_key) as contract_key, case when t.contract_key is null then 'NOT_IN_DETAIL' when s.contract_key is null then 'NOT_IN_SOURCE' else 'VALUES_DIFFER' end as fault from s full outer join t on s.contract_key = t.contract_key where s.contract_key is null or t.contract_key is null or s.value is distinct from t.value or s.status is distinct from t.status")
def binding_faults(spark, d):
    """Shared values of the source and of the detail, compared as canonical cells."""
    v = A.valid(spark, d).select("contract_key", "value", "status")
    t = v.where(_first() != "f").select("contract_key", F.when(_first() == "1", (F.col("value") + 1).cast("decimal(20,2)")).otherwise(F.col("value")).alias("value"), F.when(_first() != "2", F.col("status")).alias("status_raw"))
    return EV.binding_faults(v.where(_first() != "e"), t, {"value": "value", "status": "status_raw"})


@_q("select s_suppkey, case when s_suppkey % 5 <> 0 then s_name end as s_name from supplier", base=False)
def minimised_suppliers(spark, d):
    """approved cells are nulled if their text is still the approved one; every seventh approval is for another text."""
    s = A.table(spark, d, "supplier").select("s_suppkey", "s_name")
    approved = s.where("s_suppkey % 5 = 0 or s_suppkey % 7 = 0").select("s_suppkey", F.sha2(F.when(F.col("s_suppkey") % 5 == 0, F.col("s_name")).otherwise("other"), 256).alias("sha256"))
    return EV.minimised(s, approved, "s_suppkey", "s_name")


@_q("select s_suppkey, case when s_suppkey % 11 = 0 then 'NOT_FOUND' else 'CHANGED' end as state from supplier where s_suppkey % 7 = 0 or s_suppkey % 11 = 0", base=False)
def unmet_approvals(spark, d):
    """approvals whose cell has changed or is gone."""
    s = A.table(spark, d, "supplier").select("s_suppkey", "s_name")
    approved = s.where("s_suppkey % 5 = 0 or s_suppkey % 7 = 0 or s_suppkey % 11 = 0").select("s_suppkey", F.sha2(F.when(F.col("s_suppkey") % 7 != 0, F.col("s_name")).otherwise("other"), 256).alias("sha256"))
    return EV.unmet_approvals(s.where("s_suppkey % 11 <> 0"), approved, "s_suppkey", "s_name")


@_q(f", {_BUILT} select unnest(['late_invalid_contracts', 'indeterminate_contracts', 'late_invalid_links']) as control, unnest([count(*) filter (where later > 0), count(*) filter (where later = 0 and unclear > 0), cast(coalesce(sum(later), 0) as bigint)]) as numerator, count(*) as denominator from st")
def condition_controls(spark, d):
    """Q12: controls of late invalid evidence."""
    return EV.condition_controls(temporal.observation_conditions(A.checked(spark, d)))


@_q("select control, severity, passed, affected, grain, case grain when 'OBSERVATION' then i when 'CONTRACT' then o end as denominator from (values ('IDENTITY_CONSISTENCY', 'CRITICAL', 'CONTRACT'), ('CRITICAL_NULLS', 'CRITICAL', 'CONTRACT'), ('UNIQUE_CONTRACT_KEY', 'CRITICAL', 'CONTRACT'), ('AMOUNT_VALID', 'CRITICAL', 'CONTRACT'), ('DATE_COHERENCE', 'CRITICAL', 'CONTRACT'), ('TERRITORY_CONSISTENCY', 'CRITICAL', 'CONTRACT'), ('KEY_COLLISION', 'CRITICAL', 'OBSERVATION'), ('COUNT_RECONCILIATION', 'CRITICAL', 'OBSERVATION'), ('PANDERA_SILVER_SCHEMA', 'CRITICAL', 'TABLE'), ('PANDERA_METRICS_SCHEMA', 'CRITICAL', 'TABLE'), ('SILVER_COLUMN_ORDER', 'CRITICAL', 'TABLE'), ('METRICS_COLUMN_ORDER', 'CRITICAL', 'TABLE'), ('NON_EMPTY_OUTPUT', 'CRITICAL', 'TABLE'), ('REJECTION_RATE', 'CRITICAL', 'OBSERVATION'), ('UNKNOWN_MUNICIPALITY', 'WARNING', 'CONTRACT')) c(control, severity, grain), (select count(*) as i, count(*) filter (where bad) as r from obs), (select count(*) as o, count(*) filter (where municipality is null) as u from valid), lateral (select case when grain = 'TABLE' then null when control = 'REJECTION_RATE' then r when control = 'UNKNOWN_MUNICIPALITY' then u else 0 end as affected), lateral (select case when control = 'REJECTION_RATE' then r <= 0.02 * i else coalesce(affected, 0) = 0 end as passed)")
def quality_summary(spark, d):
    """Q10: controls with their grain and denominator, without what was observed."""
    counts = silver.counters(A.checked(spark, d))
    return EV.quality_summary(silver.quality_results(A.valid(spark, d), counts), counts)


@_q(", g as (select 'G' as grain, * from det union all select 'R', * from det where status_bucket <> 'f' union all select 'S', * from det where status_bucket <> 'f' and supplier_natural = '[\"driver\", \"supplier\", \"7\"]') select grain, unnest(['missing_status', 'unknown_entity', 'selected_unique_contracts']) as control, unnest([count(*) filter (where status_bucket = '__MISSING__'), count(*) filter (where entity_natural is null), count(*)]) as numerator, count(*) as denominator from g group by 1")
def quality_grains(spark, d):
    """Controls of the publication, of the reference and of a supplier's selection."""
    from almagest.plans.queries import _CHOSEN

    return M.quality_grains(A.detail(spark, d), M.Filters(exclude_statuses=("f",), selected_supplier=_CHOSEN)).where(F.col("control").isin("missing_status", "unknown_entity", "selected_unique_contracts"))


_META = [("a", "Departamento", "Where it is"), ("b", "Ciudad", "city of the seat"), ("c", "Municipio", None), ("d", "ID", "Identificador del contrato firmado"), ("e", "ID 2", "identificador del contrato FIRMADO en la plataforma"), ("f", "Última actualización", None)]
_RULES = [("department", "label", "departamento", 100), ("municipality", "label", "ciudad", 100), ("municipality", "label", "municipio", 100), ("identity", "description", "identificador del contrato firmado", 100), ("identity", "description", "plataforma", 20), ("watermark", "label", "ultima actualizacion", 100), ("modality", "label", "modalidad", 100)]


@_q("select * from (values ('department', 'a', 100::bigint, 'FOUND'), ('municipality', 'b', 100, 'AMBIGUOUS'), ('identity', 'e', 120, 'FOUND'), ('watermark', 'f', 100, 'FOUND'), ('modality', null, null, 'MISSING')) t(role, field, score, state)", base=False)
def field_roles(spark, d):
    """Fields of a source by what their labels and descriptions say."""
    return EV.field_roles(spark.createDataFrame(_META, "field string, label string, description string"), spark.createDataFrame(_RULES, "role string, part string, pattern string, weight bigint"))


@_q("select * from (values ('b', 'INCOMPATIBLE_TYPE'), ('x', 'CRITICAL_MISSING'), ('y', 'OPTIONAL_MISSING'), ('d', 'ADDED')) t(field, drift)", base=False)
def source_drift(spark, d):
    """A source against its contract, by the types that its cells show."""
    from almagest.operators import profile

    e = A.table(spark, d, "events").select(F.col("event_id").cast("string").alias("a"), "event_type", F.date_format("ts", "yyyy-MM-dd").alias("c"), F.lit("1").alias("d"))
    seen = None
    for name, column in (("a", "a"), ("b", "event_type"), ("c", "c"), ("d", "d")):
        one = profile.observed_types(e, column).select(F.lit(name).alias("field"), "observed_type")
        seen = one if seen is None else seen.unionByName(one)
    return EV.drifted([("a", "number", True), ("b", "number", True), ("c", "calendar_date", True), ("x", "text", True), ("y", "text", False)], seen)


@_q("select o_orderkey as k, o_orderkey || '.' || (o_orderkey % 10) || '0' as price, case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then 'true' else 'false' end as flag, '{\"v\":1e' || (o_orderkey % 5) || ',\"s\":\"' || o_orderstatus || '\"}' as doc, 'r' || (o_orderkey % 2) as run_id from orders", base=False)
def bronze_rows(spark, d):
    """Orders written as runs of JSON pages, and read back with every number as it was written."""
    import hashlib

    root = scratch_dir(spark, "bronze")
    cell = "concat('{\"k\":', o_orderkey, ',\"price\":', o_orderkey, '.', o_orderkey % 10, '0', case o_orderkey % 3 when 0 then ',\"flag\":null' when 1 then ',\"flag\":true' else ',\"flag\":false' end, ',\"doc\":{\"v\":1e', o_orderkey % 5, ',\"s\":\"', o_orderstatus, '\"}}')"
    o = A.table(spark, d, "orders")
    pages = o.select((F.col("o_orderkey") % 2).alias("run"), F.floor(F.col("o_orderkey") / 4000).alias("page"), F.expr(cell).alias("row")).groupBy("run", "page").agg(F.count("*").alias("n"), F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("row")), ","), F.lit("]")).alias("text"))
    said: dict[str, list] = {"r0": [], "r1": []}
    for r in pages.toLocalIterator():  # a source's pages come one by one
        name = f"p{r.page}.json"
        write_text(spark, f"{root}/r{r.run}/{name}", r.text)
        said[f"r{r.run}"].append({"path": name, "sha256": hashlib.sha256(r.text.encode()).hexdigest(), "rows": r.n})
    for run, found in said.items():
        write_text(spark, f"{root}/{run}/manifest.json", runs.manifest(run, "orders", "c1", found))
    return runs.read_runs(spark, root, "orders", ["k", "price", "flag", "doc"], contracts={"c1"}).select(F.col("k").cast("bigint").alias("k"), "price", "flag", "doc", "run_id")


@_q("select count(*) as contract_count, cast(coalesce(sum(value), 0) as decimal(38,2)) as total_value, min(signing_date) as first_day from det where signing_date >= date '1995-03-01' and signing_date < date '1995-04-01'")
def overview_of_a_month(spark, d):
    """One governed month."""
    f = M.Filters(start=datetime.date(1995, 3, 1), end=datetime.date(1995, 4, 1))
    rows = f.selected(A.detail(spark, d))
    return rows.agg(F.count("*").alias("contract_count"), F.coalesce(F.sum("value"), F.lit(0)).cast("decimal(38,2)").alias("total_value"), F.min("signing_date").alias("first_day"))


#: Receipts of two runs: one assessed, one not.
_SUMMARY = '{"state": "AVAILABLE", "counts": {"input_observations": 10, "rejected_observations": 2}, "controls": [{"check_id": "K", "affected_rows": 1, "denominator": 8, "denominator_grain": "contracts", "passed": false, "severity": "CRITICAL"}]}'
_COVERAGE = '{"state": "COVERED", "scope": {"signing_from": "2026-01-01", "signing_to": "2026-04-01"}, "limitations": ["one"], "acquisitions": [{"campaign_id": "c1", "state": "COMPLETE", "truncated": false, "scope_scan_complete": true}, {"campaign_id": "c2", "state": "PARTIAL"}]}'


def _receipts(spark):
    return spark.createDataFrame([(_SUMMARY, _COVERAGE, "COVERED"), ('{"state": "UNAVAILABLE"}', "{}", None)], "summary string, coverage string, coverage_state string")


@_q("""select * from (values ('input_observations', 10::bigint, 10::bigint, 'OBSERVATION', 'AVAILABLE', null), ('rejected_observations', 2, 10, 'OBSERVATION', 'AVAILABLE', null), ('K', 1, 8, 'contracts', 'FAILED', 'CRITICAL'),
 ('acquisition:c1:truncated', 0, 1, 'ACQUISITION_LANE', 'COMPLETE', 'COVERED'), ('acquisition:c1:scope_scan_complete', 1, 1, 'ACQUISITION_LANE', 'COMPLETE', 'COVERED'), ('acquisition:c1:baseline_check_complete', 0, 1, 'ACQUISITION_LANE', 'COMPLETE', 'COVERED'),
 ('acquisition:c2:truncated', 0, 1, 'ACQUISITION_LANE', 'PARTIAL', 'COVERED'), ('acquisition:c2:scope_scan_complete', 0, 1, 'ACQUISITION_LANE', 'PARTIAL', 'COVERED'), ('acquisition:c2:baseline_check_complete', 0, 1, 'ACQUISITION_LANE', 'PARTIAL', 'COVERED'),
 ('input_observations', null, null, 'OBSERVATION', 'UNAVAILABLE', null), ('accepted_valid_observations', null, null, 'OBSERVATION', 'UNAVAILABLE', null), ('output_contracts', null, null, 'OBSERVATION', 'UNAVAILABLE', null), ('rejected_observations', null, null, 'OBSERVATION', 'UNAVAILABLE', null), ('exact_duplicates', null, null, 'OBSERVATION', 'UNAVAILABLE', null), ('superseded_valid_observations', null, null, 'OBSERVATION', 'UNAVAILABLE', null)) t(control, numerator, denominator, grain, state, reason)""", base=False)
def receipt_controls(spark, d):
    """Controls of the receipts of two runs."""
    return receipts.quality_mart(_receipts(spark))


@_q("""select * from (values ('COVERED', '2026-01-01', '2026-04-01', 'c1: COMPLETE, scan complete, whole' || chr(10) || 'c2: PARTIAL, scan not stated, not stated', 'one'), (null, null, null, null, null)) t(state, signing_from, signing_to, acquisitions, limitations)""", base=False)
def coverage_metadata(spark, d):
    """Scope and acquisitions of coverage receipts as text."""
    return receipts.coverage_metadata(_receipts(spark))


@_q("select unnest(['o_orderkey', 'o_orderstatus', 'o_totalprice', 'day', 'at']) as \"column\", unnest(['int64', 'text', 'decimal', 'date', 'wall-clock-us']) as codec, unnest([count(o_orderkey), count(o_orderstatus), count(o_totalprice), count(o_orderdate), count(o_orderdate)]) as cells, 0::bigint as faults from orders", base=False)
def codec_faults(spark, d):
    """Cells that do not come back equal from their text."""
    o = A.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(20,2)").alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    return codecs.codec_faults(o)


@_q("select contract_key, case when coalesce(later, 0) > 0 then 'a later invalid observation, ' || later || ' later' when coalesce(unclear, 0) > 0 then 'order cannot be told' else 'no later invalid observation' end || case when coalesce(unclear, 0) > 0 then ', ' || unclear || ' of unclear order' else '' end as condition_text from (select v.contract_key, later, unclear from valid v left join (select contract_key, count(*) filter (where relation = 'LATER') as later, count(*) filter (where relation in ('EQUAL', 'UNKNOWN')) as unclear from lk group by 1) x on v.contract_key = x.contract_key)".replace("select contract_key, case", f", {_LINKS} select contract_key, case", 1))
def condition_texts(spark, d):
    """Conditions worded for readers."""
    c = temporal.observation_conditions(A.checked(spark, d))
    return c.select("contract_key", presentation.condition_text(F.col("condition"), F.col("later_links"), F.col("unclear_links")).alias("condition_text"))
