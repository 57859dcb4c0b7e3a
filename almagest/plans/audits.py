"""Data tests over marts in which faults are planted by key, so that each of them has something to find."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from almagest.functions import columns as C
from almagest.operators import checks, silver, star, temporal
from almagest.plans import adapter as A
from almagest.plans import metrics as M
from almagest.plans.queries import _LINKS, _label, _party, _q



def _first(n: int = 1):
    """The first characters of a contract key, which is a hash; they say what is done to its row."""
    return F.substring("contract_key", 1, n)


_DIMS = f", e as ({_party('entity')}), s as ({_party('supplier')}), m as ({_label('municipality')}), o as ({_label('modality')})"
_UNKNOWN = "count(*) filter (where natural_key is null) as unknown"


@_q(_DIMS + f" select * from (select {_UNKNOWN}, 'entity' as dimension from (select natural_key from e union all select natural_key from e where natural_key is null) union all select {_UNKNOWN}, 'supplier' from s where natural_key is not null union all select {_UNKNOWN}, 'municipality' from m union all select {_UNKNOWN}, 'modality' from o) where unknown <> 1")
def one_unknown_member(spark, d):
    """Dimensions without exactly one unknown member; one has two, one none."""
    r = A.published(spark, d)
    e, s = star.party_dim(r, "entity"), star.party_dim(r, "supplier")
    return checks.one_unknown({"entity": e.unionByName(e.where("natural_key is null")), "supplier": s.where("natural_key is not null"), "municipality": star.label_dim(r, "municipality"), "modality": star.label_dim(r, "modality")})


#: The fact with rows dropped, changed and added.
_FACT = ", f as (select case when contract_key[1:2] = '2a' then 'x' || contract_key else contract_key end as contract_key, case when contract_key[1] = '1' then cast(value + 1 as decimal(20,2)) else value end as value, payload_sha256, entity_status, supplier_status from valid where contract_key[1] <> '0')"


def _fact(r):
    f = r.where(_first() != "0")
    return f.withColumns({"value": F.when(_first() == "1", (F.col("value") + 1).cast(C.MONEY)).otherwise(F.col("value")), "contract_key": F.when(_first(2) == "2a", F.concat(F.lit("x"), "contract_key")).otherwise(F.col("contract_key"))})


@_q(_FACT + " select coalesce(f.contract_key, v.contract_key) as contract_key from f full outer join valid v on f.contract_key = v.contract_key where f.contract_key is null or v.contract_key is null or f.value is distinct from v.value or f.payload_sha256 is distinct from v.payload_sha256")
def fact_reconciles(spark, d):
    """The fact against its source, null-safe."""
    r = A.published(spark, d)
    return checks.reconciles(_fact(r), r, "contract_key", ["value", "payload_sha256"])


_BI = "select '{r}' as relation, cast({a} as varchar) as value, count(distinct {b}) as k, '{s}' as side from q group by {a} having count(distinct {b}) > 1"
_RELATIONS = [(r, f"{r}_key", n) for r, n in (("entity", "entity_natural"), ("supplier", "supplier_natural"), ("municipality", "municipality_natural"), ("modality", "modality_natural"), ("contract", "contract_key"))]
_RELATIONS[-1] = ("contract", "contract_sk", "contract_key")


@_q(", q as (select * replace (" + ", ".join(f"case when det.contract_key[1:2] = '3{i}' then 'same' else det.{k} end as {k}" for i, (_, k, _) in enumerate(_RELATIONS[:-1])) + "), municipality_natural, modality_natural, case when det.contract_key[1:2] = '34' then 'same' else md5(concat('contract-v1', chr(31), det.contract_key)) end as contract_sk from det join (select contract_key as ck, municipality_natural, modality_natural from rw) on ck = contract_key) " + " union all ".join(_BI.format(r=r, a=a, b=b, s=s) for r, k, n in _RELATIONS for a, b, s in ((k, n, "KEY"), (n, k, "NATURAL"))))
def key_bijections(spark, d):
    """Q7k, A16: surrogate and natural keys of five relations; each has rows under a wrong key."""
    r = A.published(spark, d)
    m = A.marted(r).join(r.select("contract_key", "municipality_natural", "modality_natural"), "contract_key").withColumn("contract_sk", C.surrogate("contract-v1", F.col("contract_key")))
    out = None
    for i, (name, key, natural) in enumerate(_RELATIONS):
        q = m.select(F.when(_first(2) == f"3{i}", "same").otherwise(F.col(key)).alias("KEY"), F.col(natural).alias("NATURAL"))
        one = checks.bijection(q, "KEY", "NATURAL").select(F.lit(name).alias("relation"), "value", "k", "side")
        out = one if out is None else out.unionByName(one)
    return out


@_q(_FACT + ", d as (select contract_key, value from valid where contract_key[1] <> '5' union all select contract_key, value from valid where contract_key[1] = '4') select contract_key, 'REPEATED' as fault from d group by 1 having count(*) > 1 union all select distinct coalesce(f.contract_key, d.contract_key), 'NOT_THE_FACT' from f full outer join d on f.contract_key = d.contract_key where f.contract_key is null or d.contract_key is null or f.value is distinct from d.value union all select distinct contract_key, 'NOT_IN_SOURCE' from d where contract_key[1] in ('6', '4')")
def detail_faults(spark, d):
    """Q7d, Q7e: detail rows that repeat, differ from the fact, or have no source."""
    r = A.published(spark, d)
    detail = r.where(_first() != "5").unionByName(r.where(_first() == "4")).select("contract_key", "value")
    return checks.detail_faults(detail, _fact(r), r.where(~_first().isin("6", "4")), "contract_key", ["value"])


@_q(", t as (select min(payload_sha256) as version, cast(null as varchar) as scope from valid union select min(payload_sha256), cast(null as varchar) from valid union select min(payload_sha256), cast(null as varchar) from valid where contract_key[1] <> (select contract_key[1] from valid order by payload_sha256 limit 1)) select * from t where (select count(*) from t) <> 1")
def snapshot_tuples(spark, d):
    """Q7f, U2: the snapshots that the marts were built from, if there are several; one mart is from another."""
    r = A.published(spark, d)
    low = lambda df: df.agg(F.min("payload_sha256").alias("version")).withColumn("scope", F.lit(None).cast("string"))
    at = temporal.first_row(r, "payload_sha256").select(_first().alias("_c"))
    other = r.join(F.broadcast(at), _first() == F.col("_c"), "left_anti")  # one row
    return checks.one_snapshot([low(r), low(r), low(other)], ["version", "scope"])


_COV = "select entity_status, supplier_status, count(*) as rows, cast(sum(value) as decimal(38,2)) as value from {0} group by 1, 2"


@_q(_FACT + f", a as ({_COV.format('valid')}), b as ({_COV.format('f')}) select *, 'EXPECTED' as side from (select * from a except all select * from b) union all select *, 'ACTUAL' from (select * from b except all select * from a)")
def identity_coverage_differs(spark, d):
    """Q7g, A27, U3: contracts and value by identity, source against fact."""
    r = A.published(spark, d)
    return checks.coverage_differs(r, _fact(r), ["entity_status", "supplier_status"])


@_q(_DIMS + "".join(f", {x} as (select '{r}' as role, rw.contract_key from rw left join (select {r}_key as k, case when code like '%7' then null else code end as code from {t} where code is null or code not like '%3') d on d.k = case when {r}_natural is null then md5('{r}-v1/unknown') else md5(concat('{r}-v1', chr(31), {r}_natural)) end where d.k is null or ({r}_status = 'KNOWN') is distinct from (d.code is not null) or ({r}_status = 'UNKNOWN') is distinct from ({r}_reason is not null))" for x, r, t in (("x1", "entity", "e"), ("x2", "supplier", "s"))) + " select * from x1 union all select * from x2")
def member_disagreements(spark, d):
    """Q7h: identities against dimension members; some members are gone, some have lost their code."""
    r = A.published(spark, d)
    out = None
    for role in ("entity", "supplier"):
        dim = star.party_dim(r, role).where("code is null or code not like '%3'").withColumn("code", F.when(~F.coalesce(F.col("code").like("%7"), F.lit(False)), F.col("code")))
        key = C.surrogate(f"{role}-v1", F.when(F.col(f"{role}_status") == "KNOWN", F.col(f"{role}_natural")))
        one = checks.member_disagrees(r.withColumn(f"{role}_key", key), dim, role)
        out = one if out is None else out.unionByName(one)
    return out


@_q(", c as (select contract_key from valid where contract_key[1] <> '6' union all select contract_key from valid where contract_key[1] = '7' union all select 'x' || contract_key from valid where contract_key[1:2] = '8a'), n as (select contract_key, count(*) as rows from c group by 1) select coalesce(v.contract_key, n.contract_key) as contract_key, coalesce(rows, 0) as rows from valid v full outer join n on v.contract_key = n.contract_key where v.contract_key is null or coalesce(rows, 0) <> 1")
def conditions_not_once(spark, d):
    """Q7i: contracts without exactly one condition, and conditions without a contract."""
    k = A.published(spark, d).select("contract_key")
    c = k.where(_first() != "6").unionByName(k.where(_first() == "7")).unionByName(k.where(_first(2) == "8a").select(F.concat(F.lit("x"), "contract_key").alias("contract_key")))
    return checks.not_once(c, k)


@_q(f", {_LINKS}, n as (select contract_key, count(*) filter (where relation = 'LATER') as l, count(*) filter (where relation in ('EQUAL', 'UNKNOWN')) as e from lk group by 1), c as (select v.contract_key, coalesce(l, 0) + case when v.contract_key[1] = '9' then 1 else 0 end as later_links, coalesce(l, 0) as later_found from valid v left join n on v.contract_key = n.contract_key) select contract_key, later_links, later_found from c where later_links <> later_found")
def link_counters_disagree(spark, d):
    """Q7j: conditions that count other links than there are."""
    seen = A.checked(spark, d)
    made = temporal.observation_conditions(seen).withColumn("later_links", F.col("later_links") + F.when(_first() == "9", 1).otherwise(0))
    return checks.counters_disagree(made, temporal.rejection_links(A.valid(spark, d), silver.rejected(seen)))


@_q("select 'status' as \"column\", status as value, count(*) as rows from valid where status is not null and status not in ('F', 'O') group by 2 union all select 'municipality', null, count(*) from valid where municipality is null")
def column_rules(spark, d):
    """Q6: values that are not accepted, and cells that may not be null."""
    v = A.valid(spark, d)
    bad = checks.accepted_values(v, "status", ["F", "O"]).select(F.lit("status").alias("column"), F.col("status").alias("value"), "rows")
    return bad.unionByName(checks.not_null(v, "municipality").agg(F.count("*").alias("rows")).select(F.lit("municipality").alias("column"), F.lit(None).cast("string").alias("value"), "rows"))


@_q("with u as (select distinct user_id from events), c as (select * from u where user_id % 7 <> 0) select 'POPULATION_COMPLETE' as gate, count(*) as affected, count(*) = 0 as passed from u where user_id not in (select user_id from c) union all select 'POPULATION_PRESERVATION', count(*), count(*) = 0 from u where user_id % 3 = 0 and user_id not in (select user_id from c) union all select 'POPULATION_SCOPE', count(*), count(*) = 0 from c where user_id >= 50", base=False)
def population_gates(spark, d):
    """Q9: keys that miss, were lost, or are out of scope."""
    u = A.table(spark, d, "events").select("user_id").distinct()
    return checks.population_gates(u, u.where("user_id % 3 = 0"), u.where("user_id % 7 <> 0"), u.where("user_id < 50"), "user_id")


@_q("select 'orders' as relation, (select count(*) from orders) as rows_before, (select count(*) from orders) as rows_after union all select 'region', (select count(*) from region), null", base=False)
def input_drift(spark, d):
    """Q11: inputs that changed while a build ran; one has a changed cell, one is gone, one is as it was in another order."""
    o, n, g = (A.table(spark, d, t) for t in ("orders", "nation", "region"))
    cols = ["o_orderkey", "o_orderstatus"]
    later = o.select("o_orderkey", F.when(F.col("o_orderkey") == 1, "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return checks.drift(checks.bound_inputs({"orders": o.select(*cols), "nation": n, "region": g}), checks.bound_inputs({"orders": later, "nation": n.orderBy(F.desc("n_nationkey"))}))


@_q("select count(*) as rows, min(signing_date) as first_day, max(signing_date) as last_day from valid where signing_date >= date '1994-01-01' and signing_date < date '1995-01-01'")
def scope_members(spark, d):
    """F8: contracts of a half-open signing interval."""
    return temporal.in_scope(A.valid(spark, d), datetime.date(1994, 1, 1), datetime.date(1995, 1, 1)).agg(F.count("*").alias("rows"), F.min("signing_date").alias("first_day"), F.max("signing_date").alias("last_day"))


@_q("select contract_key, value from valid order by contract_key limit 1")
def first_contract(spark, d):
    """The first contract by key."""
    return temporal.first_row(A.valid(spark, d), "contract_key").select("contract_key", "value")


@_q("select distinct user_id as i, event_type as p from events", base=False)
def observation_index_upsert(spark, d):
    """T5: the index after a batch."""
    e = A.table(spark, d, "events")
    return temporal.indexed(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_type").select(F.col("user_id").alias("i"), F.col("event_type").alias("p"))


def _keys(role: str, codes: list[int]) -> str:
    return ", ".join(f"""md5(concat('{role}-v1', chr(31), '["driver", "{role}", "{c}"]'))""" for c in codes)




def _keyed(role: str, codes: list[int]) -> tuple[str, ...]:
    import hashlib

    return tuple(hashlib.md5(f'{role}-v1\u001f["driver", "{role}", "{c}"]'.encode()).hexdigest() for c in codes)


@_q(f", p as (select value, row_number() over (order by value) as n, count(*) over () as k from det where entity_key in ({_keys('entity', list(range(1, 40)))}) and modality_key = md5(concat('modality-v1', chr(31), '1-urgent'))) select count(*) as contract_count, cast(coalesce(sum(value), 0) as decimal(38,2)) as total_value, max(case when n = (k - 1) // 2 + 1 then value end) as low_middle from p")
def overview_by_keys(spark, d):
    """A governed selection by entity and modality keys."""
    import hashlib

    f = M.Filters(entity_keys=_keyed("entity", list(range(1, 40))), modality_keys=(hashlib.md5("modality-v1\u001f1-urgent".encode()).hexdigest(),))
    rows = f.selected(A.detail(spark, d))
    one = M.overview(A.detail(spark, d), f)
    low = rows.groupBy("value").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    run = low.withColumn("to", F.sum("n").over(Window.orderBy("value"))).crossJoin(one.select("contract_count"))
    middle = run.where((F.col("to") > F.floor((F.col("contract_count") - 1) / 2))).agg(F.min("value").alias("low_middle"))
    return one.select("contract_count", "total_value").crossJoin(middle)


@_q("select count(*) as contract_count, cast(coalesce(sum(value), 0) as decimal(38,2)) as total_value from det where contract_key[1] = 'a'")
def overview_missing_signatures(spark, d):
    """F4d, B6: contracts without a signing date, of a table in which a sixteenth have none."""
    m = A.detail(spark, d).withColumn("signing_date", F.when(_first() != "a", F.col("signing_date")))
    return M.overview(m, M.Filters(missing_signatures=True)).select("contract_count", "total_value")
