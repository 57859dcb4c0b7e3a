"""The engine's queries over the driver's tables, and the same in SQL for DuckDB."""

from __future__ import annotations

import datetime
import hashlib

from pyspark.sql import functions as F

from almagest.functions import columns as C
from almagest.operators import checks, digest, profile, silver, star, temporal
from almagest.plans import adapter as A
from almagest.plans import metrics as M
from almagest.streaming import events as E

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

_ID = "case when trim({0}) = '' or {0} is null then {1} when upper(trim({0})) in ('0','-1','N/A','NA','NULL','NO DEFINIDO','NO APLICA') then {2} when not regexp_full_match(trim({0}), '[0-9]+') then {3} else {4} end"


def _ident(raw: str, n: str) -> str:
    return f"{_ID.format(raw, 'NULL', 'NULL', 'NULL', f'trim({raw})')} as {n}_code, {_ID.format(raw, *["'UNKNOWN'"] * 3, "'KNOWN'")} as {n}_status, {_ID.format(raw, "'MISSING_CODE'", "'PLACEHOLDER_CODE'", "'INVALID_CODE'", 'NULL')} as {n}_reason"


def _sk(role: str) -> str:
    return f"case when {role}_natural is null then md5('{role}-v1/unknown') else md5(concat('{role}-v1', chr(31), {role}_natural)) end"


#: The adapter in SQL.
BASE = f"""
o0 as (select concat(l_orderkey, '-', l_linenumber) as source_id_raw, {A.ENTITY_RAW} as ec, {A.SUPPLIER_RAW} as sc, l_orderkey, l_linenumber,
  sha256(concat_ws(chr(31), l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as decimal(20,2)), cast(l_extendedprice as decimal(20,2)), cast(l_discount as decimal(20,2)), cast(l_tax as decimal(20,2)), l_returnflag, l_linestatus, cast(l_shipdate as date))) as payload_sha256,
  c_name as entity_name, s_name as supplier_name, {A.PLACE_RAW.replace('else municipality', 'else n_name')} as municipality, r_name as department, o_orderpriority as modality, case when l_orderkey % 17 <> 0 then o_orderstatus end as status,
  cast(o_orderdate as date) as signing_date, cast(l_shipdate as date) as end_date, cast(l_extendedprice as decimal(20,2)) as value
  from lineitem join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey left join supplier on l_suppkey = s_suppkey),
obs as (select *, sha256(concat_ws(chr(31), 'silver-key-v1', 'driver', source_id_raw)) as contract_key, {_ident('ec', 'entity')}, {_ident('sc', 'supplier')}, end_date as source_updated_at, signing_date as fetched_at, coalesce(signing_date > end_date, false) as bad from o0),
valid as (select * from obs where not bad qualify row_number() over (partition by contract_key order by source_updated_at desc nulls last, fetched_at desc nulls last, payload_sha256 desc nulls last) = 1),
rw as (select *, case when entity_code is not null then concat('["driver", "entity", "', entity_code, '"]') end as entity_natural, case when supplier_code is not null then concat('["driver", "supplier", "', supplier_code, '"]') end as supplier_natural,
  upper(nullif(trim(municipality), '')) as municipality_natural, lower(nullif(trim(modality), '')) as modality_natural, cast(date_diff('day', signing_date, end_date) as integer) as duration_days from valid),
det as (select contract_key, payload_sha256, {_sk('entity')} as entity_key, {_sk('supplier')} as supplier_key,
  {_sk('municipality')} as municipality_key, {_sk('modality')} as modality_key, entity_natural, supplier_natural,
  signing_date, end_date, duration_days, value, source_updated_at, coalesce(nullif(lower(trim(status)), ''), '__MISSING__') as status_bucket, cast(date_trunc('month', signing_date) as date) as signing_month from rw)"""


def _q(sql: str | None = None, base: bool = True):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = f"with {BASE}{sql}" if base and sql.lstrip().startswith(",") else f"with {BASE} {sql}" if base else sql
        return f

    return put


# -- silver


@_q("select count(*) as input_rows, count(*) filter (where bad) as rejected_rows, (select count(*) from obs where not bad) - (select count(*) from (select distinct contract_key, payload_sha256 from obs where not bad)) as exact_duplicates, (select count(*) from (select distinct contract_key, payload_sha256 from obs where not bad)) - (select count(*) from valid) as superseded_versions, (select count(*) from valid) as output_rows, round(cast(count(*) filter (where bad) as double) / count(*), 12) as rejection_rate from obs")
def silver_counts(spark, d):
    """The accounting of a run."""
    return silver.counters(A.checked(spark, d)).withColumn("rejection_rate", F.round("rejection_rate", 12))


@_q("select contract_key, source_id_raw, entity_code, entity_status, supplier_code, supplier_status, municipality, department, modality, status, signing_date, end_date, value, payload_sha256 from valid")
def silver_valid(spark, d):
    """Accepted winners."""
    return A.valid(spark, d).select("contract_key", "source_id_raw", "entity_code", "entity_status", "supplier_code", "supplier_status", "municipality", "department", "modality", "status", "signing_date", "end_date", "value", "payload_sha256")


@_q("select 'DATE_INCONSISTENT' as code, 'signing' as field, count(*) as rows from obs where bad having count(*) > 0")
def rejection_details_explode(spark, d):
    """Rejections by code and field."""
    return silver.rejected(A.checked(spark, d)).select(F.explode("rejection_details").alias("r")).groupBy("r.code", "r.field").agg(F.count("*").alias("rows"))


_RAW = "case l_linenumber % 7 when 0 then null when 1 then concat('-', cast(cast(l_extendedprice as decimal(20,2)) as varchar)) when 2 then concat('COP ', l_orderkey) when 3 then '1.001' when 4 then '1234567890123456789.00' when 5 then concat(cast(cast(l_extendedprice as decimal(20,2)) as varchar), '0000') else cast(cast(l_extendedprice as decimal(20,2)) as varchar) end"


@_q(f"""select code, count(*) as rows from (select case when raw is null or trim(raw) = '' then 'AMOUNT_NULL' when regexp_full_match(raw, '-\\d+(\\.\\d+)?') then 'AMOUNT_NEGATIVE' when regexp_full_match(raw, '\\+?\\d+\\.\\d{{2}}\\d*[1-9]\\d*') then 'AMOUNT_SCALE_EXCEEDED'
 when not regexp_full_match(raw, '\\+?\\d+(\\.\\d{{1,2}}0*)?') then 'AMOUNT_INVALID_FORMAT' when try_cast(raw as decimal(20,2)) is null then 'AMOUNT_OVERFLOW' else 'OK' end as code from (select {_RAW} as raw from lineitem)) group by code""", base=False)
def amount_rules(spark, d):
    """Q1b-Q1f, X9: amounts as written, by first outcome."""
    rows = A.table(spark, d, "lineitem").select(F.expr(_RAW.replace("as varchar", "as string")).alias("raw"))
    got = silver.with_rejections(rows, silver.amount_rules(F.col("raw")))
    return got.select(F.coalesce(F.get("rejection_codes", 0), F.lit("OK")).alias("code")).groupBy("code").agg(F.count("*").alias("rows"))


@_q("select entity_status as status, entity_reason as reason, count(*) as rows, cast(sum(value) as decimal(38,2)) as value, count(distinct case when labels > 1 then entity_code end) as codes_with_variants from (select *, count(distinct entity_name) over (partition by entity_code) as labels from valid) group by 1, 2")
def identity_coverage(spark, d):
    """Entities by identity status."""
    return profile.identity_coverage(A.valid(spark, d), "entity")


@_q("select supplier_code_raw as raw, supplier_code as code, supplier_status as status, supplier_reason as reason, count(*) as rows from (select sc as supplier_code_raw, supplier_code, supplier_status, supplier_reason from obs) group by all")
def identity_status(spark, d):
    """Supplier codes and why some are unknown."""
    return A.observations(spark, d).groupBy(F.col("supplier_code_raw").alias("raw"), F.col("supplier_code").alias("code"), F.col("supplier_status").alias("status"), F.col("supplier_reason").alias("reason")).agg(F.count("*").alias("rows"))


@_q("select lower(source) as k, count(distinct source) as spellings, count(*) as rows from (select case when doc_id % 3 = 0 then upper(source) else source end as source from documents) group by 1 having count(distinct source) > 1", base=False)
def key_collisions(spark, d):
    """Keys with several spellings."""
    rows = A.table(spark, d, "documents").select(F.when(F.col("doc_id") % 3 == 0, F.upper("source")).otherwise(F.col("source")).alias("raw"))
    return silver.collisions(rows.withColumn("k", F.lower("raw")), "k", "raw")


_TWICE = "twice as (select *, 1 as copy from obs union all select *, 2 from obs where l_orderkey % 10 = 0), rk as (select *, row_number() over (partition by contract_key, payload_sha256 order by source_updated_at desc nulls last, fetched_at desc nulls last) as er from twice)"


@_q(f", {_TWICE} select er as exact_rank, count(*) as rows from rk group by er")
def exact_duplicates(spark, d):
    """Copies of one payload; a tenth of the orders is there twice."""
    o = A.observations(spark, d)
    twice = o.unionByName(o.where(F.split("source_id_raw", "-")[0].cast("bigint") % 10 == 0))
    return silver.version_ranks(twice).groupBy(F.col("exact_rank").cast("bigint").alias("exact_rank")).agg(F.count("*").alias("rows"))


@_q(f", {_TWICE} select vr as version_rank, count(*) as rows from (select row_number() over (partition by contract_key order by source_updated_at desc nulls last, fetched_at desc nulls last, payload_sha256 desc nulls last) as vr from rk where er = 1) group by vr")
def version_ranks(spark, d):
    """Versions of one key."""
    o = A.observations(spark, d)
    twice = o.unionByName(o.where(F.split("source_id_raw", "-")[0].cast("bigint") % 10 == 0))
    return silver.version_ranks(twice).where("version_rank is not null").groupBy(F.col("version_rank").cast("bigint").alias("version_rank")).agg(F.count("*").alias("rows"))


_RESULTS = """, rate as (select count(*) as n, count(*) filter (where {bad}) as r from {rows}), v as (select count(*) as n, count(*) filter (where {warned}) as w, {extra} from {valid})
select * from (select unnest(['IDENTITY_CONSISTENCY', 'CRITICAL_NULLS', 'UNIQUE_CONTRACT_KEY', 'AMOUNT_VALID', 'DATE_COHERENCE', 'TERRITORY_CONSISTENCY']) as control, 'CRITICAL' as severity, unnest([id, nu, du, am, da, te]) as affected from v) c, lateral (select cast(c.affected as varchar) as observed, '0' as expected, c.affected = 0 as passed)
union all by name select control, 'CRITICAL' as severity, case when ok then 'valid' else 'invalid' end as observed, expected, null::bigint as affected, ok as passed from (select unnest(['PANDERA_SILVER_SCHEMA', 'PANDERA_METRICS_SCHEMA', 'SILVER_COLUMN_ORDER', 'METRICS_COLUMN_ORDER']) as control, unnest([am + nu + du = 0, true, true, true]) as ok, unnest(['columns, types and rows of the contract', 'types and sums of the contract', 'order of the contract', 'order of the contract']) as expected from v)
union all by name select 'KEY_COLLISION' as control, 'CRITICAL' as severity, count(*) || '/' || coalesce(sum(n), 0) as observed, '0/0' as expected, cast(coalesce(sum(n), 0) as bigint) as affected, count(*) = 0 as passed from ({spelled})
union all by name select 'COUNT_RECONCILIATION' as control, 'CRITICAL' as severity, cast(n as varchar) as observed, cast(n as varchar) as expected, 0 as affected, true as passed from rate
union all by name select 'REJECTION_RATE' as control, 'CRITICAL' as severity, r || '/' || n as observed, 'at most 0.02' as expected, r as affected, r <= 0.02 * n as passed from rate
union all by name select 'NON_EMPTY_OUTPUT' as control, 'CRITICAL' as severity, cast(n as varchar) as observed, '> 0' as expected, null::bigint as affected, n > 0 as passed from v
union all by name select 'UNKNOWN_MUNICIPALITY' as control, 'WARNING' as severity, cast(w as varchar) as observed, '0' as expected, w as affected, w = 0 as passed from v"""


@_q(_RESULTS.format(bad="bad", rows="obs", warned="municipality is null", valid="valid", spelled="select 1 as n from valid where false", extra="0 as id, 0 as nu, 0 as du, 0 as am, 0 as da, 0 as te"))
def quality_results(spark, d):
    """Q3: the controls of a valid table and its run."""
    return silver.quality_results(A.valid(spark, d), silver.counters(A.checked(spark, d)))


# -- star


def _party(role):
    return f"select md5(concat('{role}-v1', chr(31), {role}_natural)) as {role}_key, {role}_natural as natural_key, {role}_code as code, nullif(trim({role}_name), '') as label from rw where {role}_status = 'KNOWN' qualify row_number() over (partition by {role}_natural order by nullif(trim({role}_name), '') is null, source_updated_at desc nulls last, fetched_at desc, contract_key desc) = 1 union all select md5('{role}-v1/unknown'), null, null, 'UNKNOWN'"


def _label(role):
    return f"select md5(concat('{role}-v1', chr(31), natural_key)) as {role}_key, natural_key, label from (select {role}_natural as natural_key, min({role}) as label from rw where {role}_natural is not null group by 1) union all select md5('{role}-v1/unknown'), null, 'UNKNOWN'"


@_q(_party("entity"))
def dim_entity(spark, d):
    """W3, U1, X6, X8."""
    return star.party_dim(A.rows(spark, d), "entity")


@_q(_party("supplier"))
def dim_supplier(spark, d):
    """W3, U1, X6, X8."""
    return star.party_dim(A.rows(spark, d), "supplier")


@_q(_label("municipality"))
def dim_municipality(spark, d):
    """A15, J12, X2."""
    return star.label_dim(A.rows(spark, d), "municipality")


@_q(_label("modality"))
def dim_modality(spark, d):
    """A15, J12, X7."""
    return star.label_dim(A.rows(spark, d), "modality")


@_q(", r as (select least(min(signing_date), min(end_date)) as a, greatest(max(signing_date), max(end_date)) as b from valid), ds as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from r union all select null) select coalesce(cast(strftime(d, '%Y%m%d') as integer), 0) as date_key, d as date, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month, monthname(d) as month_name, cast(day(d) as integer) as day, cast(isodow(d) as integer) as iso_weekday, dayname(d) as day_name from ds")
def dim_date(spark, d):
    """J10, A14, X12, X15."""
    return star.date_dim(A.rows(spark, d))


@_q("select det.contract_key, entity_key, supplier_key, municipality_key, modality_key, coalesce(cast(strftime(det.signing_date, '%Y%m%d') as integer), 0) as signing_date_key, coalesce(cast(strftime(det.end_date, '%Y%m%d') as integer), 0) as end_date_key, det.duration_days, det.value, rw.status, det.payload_sha256, det.signing_date, det.source_updated_at from det join rw using (contract_key)")
def fact_contract(spark, d):
    """J1, F3, X12, X13."""
    return star.fact(A.rows(spark, d))


@_q(", e as (" + _party("entity") + "), s as (" + _party("supplier") + ") select det.contract_key, e.label as entity_label, s.label as supplier_label, det.value, signing_month, status_bucket, case when duration_days is null then 'UNKNOWN' when duration_days < 0 then 'NEGATIVE' else 'AVAILABLE' end as duration_state from det left join e using (entity_key) left join s using (supplier_key)")
def contract_detail(spark, d):
    """The fact with labels."""
    r = A.published(spark, d)
    out = star.detail(star.fact(r), star.party_dim(r, "entity"), star.party_dim(r, "supplier"), star.label_dim(r, "municipality"), star.label_dim(r, "modality"))
    return out.select("contract_key", "entity_label", "supplier_label", "value", "signing_month", "status_bucket", "duration_state")


# -- metrics

_QUART = "cast(round({0}, 4) as decimal(24,4))"


def _quant(v="value"):
    pick = lambda p: f"cast(a[cast(floor((len(a) - 1) * {p} / 4) as int) + 1] + (a[least(cast(floor((len(a) - 1) * {p} / 4) as int) + 2, len(a))] - a[cast(floor((len(a) - 1) * {p} / 4) as int) + 1]) * cast((len(a) - 1) * {p} % 4 as decimal(10,0)) / 4 as decimal(24,4))"
    return f"{pick(1)} as p25, {pick(2)} as median, {pick(3)} as p75, 'AVAILABLE' as quantile_state"


_MEAS = "count(*) as contract_count, cast(sum(value) as decimal(38,2)) as total_value, count(*) filter (where signing_date is null) as missing_signing, count(*) filter (where supplier_natural is null) as unknown_supplier"


@_q(f"select * exclude a, {_quant()} from (select entity_key, municipality_key, modality_key, signing_month, status_bucket, {_MEAS}, list(value order by value) as a from det group by 1, 2, 3, 4, 5)")
def overview_stored(spark, d):
    """A2-A5, A9."""
    return M.overview(A.detail(spark, d), stored=True)


@_q(f"select * exclude a, {_quant()} from (select {_MEAS}, list(value order by value) as a from det)")
def overview_pooled(spark, d):
    """One row over all contracts."""
    return M.overview(A.detail(spark, d))


_F = M.Filters(exclude_statuses=("f",), start=datetime.date(1995, 1, 1), end=datetime.date(1997, 1, 1))


@_q(f"select * exclude a, {_quant()} from (select {_MEAS}, list(value order by value) as a from det where status_bucket <> 'f' and signing_date >= date '1995-01-01' and signing_date < date '1997-01-01')")
def overview_filtered(spark, d):
    """Excluded statuses and a half-open interval."""
    return M.overview(A.detail(spark, d), _F)


@_q("select 0::bigint as contract_count, 0.00::decimal(38,2) as total_value, 0::bigint as missing_signing, 0::bigint as unknown_supplier, null::decimal(24,4) as p25, null::decimal(24,4) as median, null::decimal(24,4) as p75, 'NO_CONTRACTS' as quantile_state")
def overview_empty(spark, d):
    """An empty selection is a row with reasons."""
    return M.overview(A.detail(spark, d), M.Filters(statuses=("'; drop table x --",)))


@_q(f", g as (select entity_key, signing_month, count(*) as contract_count, cast(sum(value) as decimal(38,2)) as total_value, list(value order by value) as a from det group by 1, 2), s as (select entity_key, signing_month, string_agg(status_bucket || '=' || n, ',' order by status_bucket) as statuses from (select entity_key, signing_month, status_bucket, count(*) as n from det group by 1, 2, 3) group by 1, 2) select g.* exclude a, statuses, {_quant()} from g join s on g.entity_key = s.entity_key and g.signing_month is not distinct from s.signing_month")
def entity_monthly(spark, d):
    """A6, A9, W5."""
    out = M.entity_monthly(A.detail(spark, d))
    return out.withColumn("statuses", F.array_join(F.transform(F.map_entries("statuses"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ","))


@_q("select entity_key, round(n::double / sum(n) over (), 12) as count_share, round(v::double / cast(sum(v) over () as decimal(38,2))::double, 12) as value_share from (select entity_key, count(*) as n, cast(sum(value) as decimal(38,2)) as v from det group by 1)")
def share_of_total(spark, d):
    """W4."""
    return M.shares(A.detail(spark, d))


def _conc(grain, lo="1.0", chosen=None):
    keys = ", ".join(grain)
    ch = f"supplier_key = '{chosen}'" if chosen else "true"
    none = "false" if chosen else "true"
    return f""", b as (select {keys}, supplier_key, bool_or(supplier_natural is not null) as known, bool_or(entity_natural is not null) as ek, count(*) as n, cast(sum(value) as decimal(19,2)) as v, bool_or({ch}) as ch from det group by {keys}, supplier_key),
g as (select {keys}, bool_or(ek) as ek, cast(sum(n) as bigint) as contract_count, cast(sum(v) as decimal(38,2)) as total_value, cast(coalesce(sum(n) filter (where known), 0) as bigint) as known_count, cast(coalesce(sum(v) filter (where known), 0) as decimal(38,2)) as known_value, sum(cast(v * v as decimal(38,4))) filter (where known) as sq, cast(coalesce(sum(n) filter (where ch), 0) as bigint) as selected_contract_count, cast(sum(v) filter (where ch and known) as decimal(38,2)) as cv from b group by {keys}),
h as (select *, round(known_count::double / contract_count, 10) as count_coverage, round(known_value::double / nullif(total_value::double, 0), 10) as value_coverage, case when not ek then 'UNKNOWN_ENTITY' when known_count = 0 then 'NO_KNOWN_SUPPLIERS' when total_value = 0 then 'ZERO_TOTAL_VALUE' when known_value = 0 then 'ZERO_KNOWN_VALUE' when known_count::double / contract_count < {lo} or known_value::double / total_value::double < {lo} then 'INSUFFICIENT_IDENTITY_COVERAGE' else 'AVAILABLE' end as hhi_state,
 case when known_count = 0 then 'NO_KNOWN_SUPPLIERS' when known_value = 0 then 'ZERO_KNOWN_VALUE' when {none} or cv is null then 'NO_SELECTED_KNOWN_SUPPLIER' else 'AVAILABLE' end as share_state from g)
select * exclude (ek, sq, cv), case when hhi_state = 'AVAILABLE' then round(sq::double / (known_value::double * known_value::double), 10) end as hhi, case when share_state = 'AVAILABLE' then round(cv::double / known_value::double, 10) end as selected_share from h"""


@_q(_conc(["entity_key", "signing_month"]))
def concentration_stored(spark, d):
    """A11, A12, X23 at the stored grain."""
    return M.concentration(A.detail(spark, d), monthly=True)


@_q(_conc(["entity_key"], "0.5"))
def concentration_pooled(spark, d):
    """One row per entity, relaxed policy."""
    return M.concentration(A.detail(spark, d), min_count=0.5, min_value=0.5)




_CHOSEN = hashlib.md5('supplier-v1\u001f["driver", "supplier", "7"]'.encode()).hexdigest()


@_q(_conc(["entity_key"], chosen=_CHOSEN))
def selected_supplier_share(spark, d):
    """A13, B1-B3, F4e: the reference does not move with the selection."""
    return M.concentration(A.detail(spark, d), M.Filters(selected_supplier=_CHOSEN))


@_q("select unnest(['missing_signing_date', 'unknown_supplier', 'unknown_entity', 'missing_status', 'unprofiled_status', 'missing_source_update', 'selected_unique_contracts']) as control, unnest([count(*) filter (where signing_date is null), count(*) filter (where supplier_natural is null), count(*) filter (where entity_natural is null), count(*) filter (where status_bucket = '__MISSING__'), count(*) filter (where status_bucket not in ('__MISSING__', 'f')), count(*) filter (where source_updated_at is null), count(*)]) as numerator, count(*) as denominator from det")
def quality_controls(spark, d):
    """A25, Q12, J8, J11."""
    return M.quality_controls(A.detail(spark, d), profiled=("f",))


@_q("select supplier_key, known_value, row_number() over (order by known_value desc, supplier_key) as position, round(known_value::double / (select cast(sum(value) as decimal(38,2))::double from det where supplier_natural is not null), 12) as share from (select supplier_key, cast(sum(value) as decimal(38,2)) as known_value from det where supplier_natural is not null group by 1) order by 2 desc, 1 limit 25")
def supplier_ranking(spark, d):
    """A top-25 report; the denominator is all known value."""
    from pyspark.sql import Window

    by = A.detail(spark, d).where("supplier_natural is not null").groupBy("supplier_key").agg(F.sum("value").cast("decimal(38,2)").alias("known_value"))
    total = by.agg(F.sum("known_value").cast("decimal(38,2)").alias("t"))
    top = by.orderBy(F.desc("known_value"), "supplier_key").limit(25)
    return top.crossJoin(F.broadcast(total)).select("supplier_key", "known_value", F.row_number().over(Window.orderBy(F.desc("known_value"), "supplier_key")).cast("bigint").alias("position"), F.round(C.ratio(F.col("known_value"), F.col("t")), 12).alias("share"))


# -- time


@_q("""select coalesce(n.contract_key, o.contract_key) as contract_key, case when o.contract_key is null then 'INSERT' when n.contract_key is null then 'DELETE' else 'UPDATE' end as change, case when n.contract_key is null or o.contract_key is null then '' else concat_ws(',', case when n.value is distinct from o.value then 'value' end, case when n.status is distinct from o.status then 'status' end) end as changed_fields
 from (select contract_key, value, status from valid where l_orderkey % 11 <> 0) n full outer join (select contract_key, case when l_orderkey % 5 = 0 then cast(value + 1 as decimal(20,2)) else value end as value, case when l_orderkey % 7 = 0 then null else status end as status from valid where l_orderkey % 13 <> 0) o on n.contract_key = o.contract_key
 where n.contract_key is null or o.contract_key is null or n.value is distinct from o.value or n.status is distinct from o.status""")
def snapshot_diff(spark, d):
    """Two snapshots that differ by key rules."""
    out = temporal.snapshot_diff(*_snapshots(spark, d), "contract_key", ["value", "status"])
    return out.withColumn("changed_fields", F.array_join("changed_fields", ","))


def _snapshots(spark, d):
    v = A.valid(spark, d).withColumn("_ok", F.split("source_id_raw", "-")[0].cast("bigint"))
    new = v.where("_ok % 11 <> 0").select("contract_key", "value", "status")
    old = v.where("_ok % 13 <> 0").select("contract_key", F.when(F.col("_ok") % 5 == 0, (F.col("value") + 1).cast(C.MONEY)).otherwise(F.col("value")).alias("value"), F.when(F.col("_ok") % 7 != 0, F.col("status")).alias("status"))
    return old, new


@_q("""select count(*) filter (where o.k is null) as inserted, count(*) filter (where n.k is not null and o.k is not null and (n.value is distinct from o.value or n.status is distinct from o.status)) as updated, count(*) filter (where n.k is null) as deleted, false as no_op
 from (select contract_key as k, value, status from valid where l_orderkey % 11 <> 0) n full outer join (select contract_key as k, case when l_orderkey % 5 = 0 then cast(value + 1 as decimal(20,2)) else value end as value, case when l_orderkey % 7 = 0 then null else status end as status from valid where l_orderkey % 13 <> 0) o on n.k = o.k""")
def snapshot_sync_counts(spark, d):
    """Insert, update and delete counts."""
    return temporal.sync_counts(temporal.snapshot_diff(*_snapshots(spark, d), "contract_key", ["value", "status"]))


_LINKS = "lk as (select r.contract_key, case when r.fetched_at > w.fetched_at then 'LATER' when r.fetched_at = w.fetched_at then 'EQUAL' when r.fetched_at < w.fetched_at then 'EARLIER' else 'UNKNOWN' end as relation, r.payload_sha256 from obs r join valid w on r.contract_key = w.contract_key where r.bad)"


_BUILT = f"{_LINKS}, st as (select w.contract_key, coalesce(later, 0) as later, coalesce(unclear, 0) as unclear from valid w left join (select contract_key, count(*) filter (where relation = 'LATER') as later, count(*) filter (where relation in ('EQUAL', 'UNKNOWN')) as unclear from lk group by 1) x on w.contract_key = x.contract_key)"


@_q(f", {_LINKS} select w.contract_key, case when coalesce(later, 0) > 0 then 'LATER_INVALID_OBSERVED' when coalesce(unclear, 0) > 0 then 'TEMPORAL_ORDER_INDETERMINATE' else 'NO_LATER_INVALID_OBSERVED' end as condition, coalesce(later, 0) as later_links, coalesce(unclear, 0) as unclear_links from valid w left join (select contract_key, count(*) filter (where relation = 'LATER') as later, count(*) filter (where relation in ('EQUAL', 'UNKNOWN')) as unclear from lk group by 1) x on w.contract_key = x.contract_key")
def late_invalid_state(spark, d):
    """T1, J17."""
    return temporal.observation_conditions(A.checked(spark, d))


@_q(f", {_LINKS} select contract_key, relation, sha256(concat_ws(chr(31), contract_key, payload_sha256, relation)) as link_id from lk")
def rejection_links(spark, d):
    """T2."""
    return temporal.rejection_links(A.valid(spark, d), silver.rejected(A.checked(spark, d)))


@_q("""with b as (select distinct user_id as i, event_type as p from events where event_id % 2 = 0), s as (select distinct user_id as i, event_type as p from events where event_id % 2 = 1)
 select i as user_id, p as event_type, case when exists (select 1 from s where s.i = b.i and s.p = b.p) then 'REPEATED' when exists (select 1 from s where s.i = b.i) then 'NEW_VERSION' else 'NEW' end as outcome from b""", base=False)
def observation_index(spark, d):
    """T5."""
    e = A.table(spark, d, "events")
    return temporal.observation_index(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_type")


@_q("select event_id, cast(ts as timestamp) as ts, user_id from events where ts > timestamp '2024-01-10 00:00:00' or (ts = timestamp '2024-01-10 00:00:00' and event_id > 100) order by ts, event_id limit 100", base=False)
def keyset_page(spark, d):
    """L1: a page of 100 after a cursor."""
    e = A.table(spark, d, "events")
    return temporal.keyset_page(e, "ts", "event_id", (datetime.datetime(2024, 1, 10), 100), 100).select("event_id", "ts", "user_id")


@_q("select o_orderkey, o_custkey, to_json_text as row_text from (select o_orderkey, o_custkey, concat('{\"o_orderkey\":', o_orderkey, ',\"o_custkey\":', o_custkey, '}') as to_json_text from orders) order by row_text limit 50 offset 100", base=False)
def paged_read(spark, d):
    """Limit and offset in the order of the rows' text."""
    o = A.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return M.page(o, 50, 100).withColumn("row_text", F.to_json(F.struct("o_orderkey", "o_custkey")))


@_q("select user_id, count(*) as breaks from (select user_id, event_id, lag(t) over (partition by user_id order by event_id) as before, t as ts from (select *, case when event_id % 50 = 0 then ts - interval 10 day else ts end as t from events)) where before >= ts group by 1", base=False)
def cursor_breaks(spark, d):
    """L3: cursors that do not advance; every fiftieth event is set back."""
    e = A.table(spark, d, "events").withColumn("ts", F.expr("case when event_id % 50 = 0 then ts - interval 10 days else ts end"))
    return temporal.cursor_breaks(e, F.col("event_id"), F.col("ts"), "user_id").groupBy("user_id").agg(F.count("*").alias("breaks"))


@_q("select lane, count(*) as rows from (select case when w is null then 'fallback' else 'watermark' end as lane from (select case when event_id % 3 <> 0 then ts end as w, ts from events) where coalesce(w, ts) >= timestamp '2024-01-05' and coalesce(w, ts) < timestamp '2024-01-20') group by 1", base=False)
def two_lanes(spark, d):
    """T4."""
    e = A.table(spark, d, "events").withColumn("w", F.when(F.col("event_id") % 3 != 0, F.col("ts")))
    return temporal.lanes(e, "w", "ts", datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 20)).groupBy("lane").agg(F.count("*").alias("rows"))


@_q("select cast(date_trunc('day', ts) as timestamp) as start, cast(date_trunc('day', ts) + interval 1 day as timestamp) as \"end\", event_type, count(*) as n, cast(sum(cast(value as decimal(20,2))) as decimal(30,2)) as total from events group by 1, 2, 3", base=False)
def daily_windows(spark, d):
    """Tumbling windows; the function is the stream's."""
    out = E.windowed(A.table(spark, d, "events"))
    return out.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


# -- sets, keys, profiles, digests, checks


@_q("select 'admitted' as part, count(*) as keys from (select distinct user_id from events where event_id % 2 = 0 except select user_id from events where event_id % 2 = 1) union all select 'missing', count(*) from (select distinct user_id from events where event_id % 2 = 1 except select user_id from events where event_id % 2 = 0)", base=False)
def key_set_admission(spark, d):
    """U5."""
    e = A.table(spark, d, "events")
    a, b = e.where("event_id % 2 = 0").select("user_id").distinct(), e.where("event_id % 2 = 1").select("user_id").distinct()
    count = lambda n, df: df.agg(F.count("*").alias("keys")).select(F.lit(n).alias("part"), "keys")
    return count("admitted", a.join(b, "user_id", "left_anti")).unionByName(count("missing", b.join(a, "user_id", "left_anti")))


@_q("select 'l_suppkey' as fk, count(*) as violations from lineitem where l_suppkey not in (select s_suppkey from supplier where s_suppkey % 10 <> 3) union all select 'o_custkey', count(*) from orders where o_custkey not in (select c_custkey from customer)", base=False)
def fk_violations(spark, d):
    """J19, Q6."""
    t = lambda n: A.table(spark, d, n)
    count = lambda n, df: df.agg(F.count("*").alias("violations")).select(F.lit(n).alias("fk"), "violations")
    return count("l_suppkey", checks.relationships(t("lineitem"), "l_suppkey", t("supplier").where("s_suppkey % 10 <> 3"), "s_suppkey")).unionByName(count("o_custkey", checks.relationships(t("orders"), "o_custkey", t("customer"), "c_custkey")))


_PROF = " union all ".join(f"select '{c}' as \"column\", count({c}) as present, count(*) - count({c}) as nulls, count(distinct {c}) as distinct_values, min(cast({c} as varchar)) as low, max(cast({c} as varchar)) as high, 0.0::double as null_rate from orders" for c in ("o_orderkey", "o_orderstatus", "o_orderpriority"))


@_q(_PROF, base=False)
def column_profile(spark, d):
    """A19, A21, A23."""
    return profile.column_profile(A.table(spark, d, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@_q("select columns, k as distinct_rows, k = n as is_unique from (select 'l_orderkey' as columns, count(distinct l_orderkey) as k, count(*) as n from lineitem union all select 'l_linenumber', count(distinct l_linenumber), count(*) from lineitem union all select 'l_orderkey+l_linenumber', count(distinct (l_orderkey, l_linenumber)), count(*) from lineitem)", base=False)
def unique_sets(spark, d):
    """A24."""
    return profile.unique_sets(A.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], 2)


@_q("select case when regexp_full_match(v, '[+-]?\\d{1,18}') then 'integer' when regexp_full_match(v, '[+-]?\\d+\\.\\d+') then 'decimal' when v = '' then 'blank' else 'text' end as observed_type, count(*) as rows from (select trim(case event_id % 4 when 0 then event_type when 1 then cast(user_id as varchar) when 2 then '1.5' else ' ' end) as v from events) group by 1", base=False)
def observed_types(spark, d):
    """X28."""
    e = A.table(spark, d, "events").select(F.expr("case event_id % 4 when 0 then event_type when 1 then cast(user_id as string) when 2 then '1.5' else ' ' end").alias("v"))
    return profile.observed_types(e, "v")


@_q("select l_returnflag, l_linestatus, count(*) as rows from lineitem group by 1, 2 order by rows desc, 1, 2 limit 3", base=False)
def top_groups(spark, d):
    """L5, A23."""
    return profile.top_groups(A.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], 3)


@_q("select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1", base=False)
def duplicate_groups(spark, d):
    """A16, A23, Q6."""
    return profile.duplicate_groups(A.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _framed(cols):
    return "concat(" + ", ".join(f"coalesce(concat('V', strlen(cast({c} as varchar)), ':', cast({c} as varchar), ';'), 'N;')" for c in cols) + ")"


@_q(f"""with g as (select sha256({_framed(['o_custkey', 'o_orderstatus'])}) as h, count(*) as n from orders group by 1), a as (select h[1:6] as b, sum(n) as n, sha256(string_agg(concat(h[1:6], h, 'x', n, ';'), '' order by concat(h, 'x', n, ';'))) as d from g group by 1), c as (select b[1:3] as b, sum(n) as n, sha256(string_agg(b || d, '' order by b, d)) as d from a group by 1)
 select cast(sum(n) as bigint) as rows, sha256(string_agg(b || d, '' order by b, d)) as digest from c""", base=False)
def multiset_digest(spark, d):
    """A28, A29, X26."""
    return digest.multiset_digest(A.table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@_q("select o_orderstatus, o_orderpriority, cast(sum(s) as bigint) as surplus from (select o_orderstatus, o_orderpriority, 1 as s from orders union all select o_orderstatus, o_orderpriority, -1 from orders where o_orderkey % 3 = 0) group by 1, 2 having sum(s) <> 0", base=False)
def bag_difference(spark, d):
    """U4, U6."""
    o = A.table(spark, d, "orders")
    return digest.bag_difference(o.select("o_orderstatus", "o_orderpriority"), o.where("o_orderkey % 3 = 0").select("o_orderstatus", "o_orderpriority"))


@_q("select state, count(*) as rows from (select case when u is null or trim(u) = '' then 'MISSING' when regexp_full_match(u, 'https?://[^\\s]+') then 'AVAILABLE' else 'DISALLOWED' end as state from (select case page_id % 5 when 0 then null when 1 then concat('javascript:', page_id) else url end as u from pages)) group by 1", base=False)
def url_states(spark, d):
    """F10."""
    p = A.table(spark, d, "pages").select(F.expr("case page_id % 5 when 0 then null when 1 then concat('javascript:', page_id) else url end").alias("u"))
    return p.groupBy(C.url_state(F.col("u")).alias("state")).agg(F.count("*").alias("rows"))


@_q("select cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as rows from events group by 1", base=False)
def json_path(spark, d):
    """X19."""
    return A.table(spark, d, "events").groupBy(F.get_json_object("props", "$.k").cast("bigint").alias("k")).agg(F.count("*").alias("rows"))


@_q("select n_name, upper(translate(trim(n_name), 'áéíóú', 'aeiou')) as territory from nation", base=False)
def territory_key(spark, d):
    """X2, X7."""
    return A.table(spark, d, "nation").select("n_name", C.territory_key(F.col("n_name")).alias("territory"))
