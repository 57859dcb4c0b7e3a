"""Order lines as a source writes them, all text, with every fault that the rules know, planted by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almagest.functions import columns as C
from almagest.operators import silver
from almagest.plans import adapter as A
from almagest.plans.queries import _RESULTS, _q
from almagest.sources.store import spread

#: Raw cells; the same text is SQL for both engines but for ``{day}``, a date as text, and ``{text}``, the type of a text.
CELLS = {
    "id_raw": "case when l_orderkey % 97 = 0 then '  ' when l_orderkey % 7 = 0 and l_linenumber = 1 then concat(' ', l_orderkey, '-', l_linenumber, '  ') else concat(l_orderkey, '-', l_linenumber) end",
    "amount_raw": "case when l_orderkey % 89 = 0 then null when l_orderkey % 83 = 0 then concat('-', cast(cast(l_extendedprice as decimal(20,2)) as {text})) when l_orderkey % 79 = 0 then concat('COP ', l_orderkey) when l_orderkey % 73 = 0 then '1.001' when l_orderkey % 71 = 0 then '1234567890123456789.00' when l_orderkey % 5 = 0 then concat('+', cast(cast(l_extendedprice as decimal(20,2)) as {text}), '0000') else cast(cast(l_extendedprice as decimal(20,2)) as {text}) end",
    "signing_raw": "case when l_orderkey % 61 = 0 then '1996-02-30T00:00:00.000' when l_orderkey % 59 = 0 then concat({day[o_orderdate]}, 'T00:00:00') when l_orderkey % 53 = 0 then null when l_orderkey % 11 = 0 then concat({day[o_orderdate]}, 'T10:30:00.000') else concat({day[o_orderdate]}, 'T00:00:00.000') end",
    "start_raw": "case when l_orderkey % 47 = 0 then 'soon' when l_orderkey % 43 = 0 then '2030-01-01T00:00:00.000' when l_orderkey % 2 = 0 then '' else concat({day[o_orderdate]}, 'T00:00:00.000') end",
    "end_raw": "case when l_orderkey % 41 = 0 then concat(' ', {day[l_shipdate]}, 'T00:00:00.000') when l_orderkey % 37 = 0 then '1990-01-01T00:00:00.000' when l_linenumber % 2 = 0 then null else '2020-12-31T00:00:00.000' end",
    "updated_raw": "case when l_orderkey % 67 = 0 then '2024-13-01T00:00:00.000' else concat({day[l_shipdate]}, 'T08:15:30.250') end",
    "department_raw": "case when l_orderkey % 31 = 0 then 'EUROPE' when l_orderkey % 29 = 0 then null when l_orderkey % 3 = 0 then '  américa ' else 'America' end",
    "municipality_raw": "case when l_orderkey % 23 = 0 then null when l_orderkey % 19 = 0 then 'Atlántis' else n_name end",
}
#: Nations of the catalog are those with a number under this; spellings are their names.
CATALOG_BELOW = 20
ORIGIN = "from lineitem join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey"


def _cells(text: str, day: str) -> dict[str, str]:
    days = {c: day.format(c) for c in ("o_orderdate", "l_shipdate")}
    return {k: v.replace("{text}", text).format(day=days) if "{day" in v else v.replace("{text}", text) for k, v in CELLS.items()}


def raw_rows(spark, d: str) -> DataFrame:
    """Text cells of every order line, with its key."""
    line, orders, cust, nation = (A.table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    rows = spread(line.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")).join(orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(cust.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left").join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    cells = _cells("string", "date_format({}, 'yyyy-MM-dd')")
    return rows.select("l_orderkey", "l_linenumber", *[F.expr(v).alias(k) for k, v in cells.items()])


def catalog(spark, d: str) -> dict[str, str]:
    """Spellings and names of the places in scope; a table of 25 rows."""
    return {r.n_name: r.n_name for r in A.table(spark, d, "nation").where(F.col("n_nationkey") < CATALOG_BELOW).orderBy("n_nationkey").limit(25).collect()}


def annotated(spark, d: str) -> DataFrame:
    """Raw rows with their parsed columns, rejections and warnings."""
    col = F.col
    rows = raw_rows(spark, d)
    parsed = rows.withColumns({
        "source_id_raw": C.clean_text(col("id_raw")), "value": C.amount(col("amount_raw")),
        "signing_date": C.business_date(col("signing_raw")), "start_date": C.business_date(col("start_raw")), "end_date": C.business_date(col("end_raw")), "source_updated_at": C.strict_timestamp(col("updated_raw")),
        "place": silver.municipality_status(col("municipality_raw"), catalog(spark, d)),
    })
    parsed = parsed.withColumns({"contract_key": C.contract_key("driver", col("source_id_raw")), "municipality": col("place.name"), "municipality_status": col("place.status"), "quality_warning_codes": silver.warning_codes(col("place.status")), "signing_year": C.year_text(col("signing_date"))})
    dates = {"signing": "signing_date", "start": "start_date", "end": "end_date", "updated": "source_updated_at"}
    rules = silver.identifier_rule(col("id_raw"), "id") + silver.amount_rules(col("amount_raw"), "amount") + silver.date_rules({k: col(f"{k}_raw") for k in dates}, {k: col(v) for k, v in dates.items()}) + silver.scope_rule(col("department_raw"), "America", "department")
    return silver.with_rejections(parsed, rules).drop("place")


_DAY = "case when regexp_full_match({0}, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}\\.\\d{{3}}') then cast(try_cast({0} as timestamp) as date) end"
_SQL_CELLS = ", ".join(f"{v} as {k}" for k, v in _cells("varchar", "strftime({}, '%Y-%m-%d')").items())
RAW = f"""raw as (select row_number() over () as rid, l_orderkey, l_linenumber, {_SQL_CELLS} {ORIGIN}),
an as (select *, {_DAY.format('signing_raw')} as sd, {_DAY.format('start_raw')} as td, {_DAY.format('end_raw')} as ed, {_DAY.format('updated_raw')} as ud, trim(amount_raw) as am from raw),
rej as (select rid, l_orderkey, l_linenumber, unnest(list_filter([
 case when trim(id_raw) = '' then {{'code': 'IDENTIFIER_NULL', 'field': 'id', 'raw': id_raw}} end,
 case when am is null then {{'code': 'AMOUNT_NULL', 'field': 'amount', 'raw': am}} end,
 case when am like '-%' then {{'code': 'AMOUNT_NEGATIVE', 'field': 'amount', 'raw': am}} end,
 case when am = '1.001' then {{'code': 'AMOUNT_SCALE_EXCEEDED', 'field': 'amount', 'raw': am}} end,
 case when am like 'COP%' then {{'code': 'AMOUNT_INVALID_FORMAT', 'field': 'amount', 'raw': am}} end,
 case when regexp_full_match(am, '\\+?\\d+(\\.\\d{{1,2}}0*)?') and try_cast(am as decimal(20,2)) is null then {{'code': 'AMOUNT_OVERFLOW', 'field': 'amount', 'raw': am}} end,
 case when trim(signing_raw) <> '' and sd is null then {{'code': 'DATE_INVALID', 'field': 'signing', 'raw': signing_raw}} end,
 case when trim(start_raw) <> '' and td is null then {{'code': 'DATE_INVALID', 'field': 'start', 'raw': start_raw}} end,
 case when trim(end_raw) <> '' and ed is null then {{'code': 'DATE_INVALID', 'field': 'end', 'raw': end_raw}} end,
 case when trim(updated_raw) <> '' and ud is null then {{'code': 'DATE_INVALID', 'field': 'updated', 'raw': updated_raw}} end,
 case when td > ed then {{'code': 'DATE_INCONSISTENT', 'field': 'start', 'raw': cast(td as varchar)}} end,
 case when sd > ed then {{'code': 'DATE_INCONSISTENT', 'field': 'signing', 'raw': cast(sd as varchar)}} end,
 case when upper(strip_accents(trim(department_raw))) is distinct from 'AMERICA' then {{'code': 'DEPARTMENT_OUT_OF_SCOPE', 'field': 'department', 'raw': department_raw}} end], lambda x: x is not null)) as r from an),
pl as (select *, case when trim(municipality_raw) is null then 'MISSING' when municipality_raw in (select n_name from nation where n_nationkey < {CATALOG_BELOW}) then 'KNOWN' else 'UNKNOWN' end as place from an)"""


@_q(f"with {RAW} select r.code as code, r.field as field, count(*) as rows, count(distinct r.raw) as spellings from rej group by 1, 2", base=False)
def rejections_by_rule(spark, d):
    """Q1, Q1a-Q1i: every rejection code, by field, with the spellings met."""
    return annotated(spark, d).select(F.explode("rejection_details").alias("r")).groupBy("r.code", "r.field").agg(F.count("*").alias("rows"), F.countDistinct("r.raw_value").alias("spellings"))


@_q(f"with {RAW} select codes, count(*) as rows from (select string_agg(distinct r.code, ',' order by r.code) as codes from rej group by rid) group by 1", base=False)
def rejection_code_sets(spark, d):
    """Sorted distinct codes of the rejected rows."""
    return silver.rejected(annotated(spark, d)).groupBy(F.array_join("rejection_codes", ",").alias("codes")).agg(F.count("*").alias("rows"))


@_q(f"with {RAW}, c as (select list(distinct r.code) as codes from rej group by rid) select list_has_any(codes, ['AMOUNT_NULL', 'DATE_INVALID']) as named, len(codes) as codes, count(*) as rows from c group by 1, 2", base=False)
def rejections_that_overlap(spark, d):
    """Rows whose codes meet a list, by how many they have."""
    some = F.array(F.lit("AMOUNT_NULL"), F.lit("DATE_INVALID"))
    return silver.rejected(annotated(spark, d)).groupBy(F.arrays_overlap("rejection_codes", some).alias("named"), F.cardinality("rejection_codes").cast("bigint").alias("codes")).agg(F.count("*").alias("rows"))


@_q(f"with {RAW} select place as municipality_status, case when place = 'UNKNOWN' then 'UNKNOWN_MUNICIPALITY' else '' end as warnings, count(*) as rows, count(distinct case when place = 'KNOWN' then municipality_raw end) as places from pl group by 1, 2", base=False)
def warnings_by_place(spark, d):
    """Places of a catalog, and warnings for those it lacks."""
    return annotated(spark, d).groupBy("municipality_status", F.array_join("quality_warning_codes", ",").alias("warnings")).agg(F.count("*").alias("rows"), F.countDistinct("municipality").alias("places"))


@_q(f"with {RAW} select sd is not null as later_policy, sd is not null and signing_raw like '%T00:00:00.000' as older_policy, count(*) as rows, min(sd) as first_day, max(sd) as last_day, count(distinct coalesce(strftime(sd, '%Y'), 'unknown')) as years from an group by 1, 2", base=False)
def business_dates(spark, d):
    """Dates under both policies; the older takes midnight only."""
    r = raw_rows(spark, d).select(C.business_date(F.col("signing_raw")).alias("sd"), C.business_date(F.col("signing_raw"), True).alias("old"))
    return r.groupBy(F.col("sd").isNotNull().alias("later_policy"), F.col("old").isNotNull().alias("older_policy")).agg(F.count("*").alias("rows"), F.min("sd").alias("first_day"), F.max("sd").alias("last_day"), F.countDistinct(C.year_text(F.col("sd"))).alias("years"))


#: Text with decomposed marks, compatibility forms and spaces that are not ASCII.
_MIXED = "concat('  ', n_name, chr(160), 'Bogota', chr(769), chr(8195), ' ', chr(64257), 'n Ş', chr(12288))"


@_q("select n_name, nfc_normalize(upper(n_name[1:1]) || n_name[2:]) || ' Bogotá ' || chr(64257) || 'n Ş' as clean, upper(n_name) || ' BOGOTA FIN S' as territory from nation", base=False)
def text_forms(spark, d):
    """NFC and Unicode spaces; names compared without marks and compatibility forms."""
    n = A.table(spark, d, "nation").select("n_name", F.expr(_MIXED.replace("chr(160)", "' '").replace("chr(769)", "'́'").replace("chr(8195)", "' '").replace("chr(64257)", "'ﬁ'").replace("chr(12288)", "'　'")).alias("t"))
    return n.select("n_name", C.clean_text(F.col("t")).alias("clean"), C.territory_key(F.col("t")).alias("territory"))


def _planted(spark, d) -> DataFrame:
    """Accepted rows as a valid table with faults planted by key, so that the controls have something to find."""
    k = F.col("l_orderkey")
    v = silver.accepted(annotated(spark, d)).withColumn("payload_sha256", F.sha2(F.concat_ws(C.UNIT, "id_raw", "amount_raw"), 256))
    v = v.withColumns({
        "value": F.when(k % 101 == 0, F.lit(None).cast(C.MONEY)).when(k % 103 == 0, -F.col("value")).otherwise(F.col("value")).cast(C.MONEY),
        "signing_year": F.when(k % 107 == 0, "1900").otherwise(F.col("signing_year")),
        "department": F.when(k % 109 == 0, "Europe").otherwise("America"),
        "start_date": F.when(k % 113 == 0, F.col("end_date") + 1).otherwise(F.col("start_date")),
        "contract_key": F.when((k % 127 == 0) & (F.col("l_linenumber") == 2), F.sha2(F.concat_ws(C.UNIT, F.lit("silver-key-v1"), F.lit("driver"), F.concat(k, F.lit("-1"))), 256)).otherwise(F.col("contract_key")),
    })
    for role, n in (("entity", 131), ("supplier", 137)):
        v = v.withColumns({f"{role}_code": F.when(k % n != 0, k.cast("string")), f"{role}_status": F.lit("KNOWN"), f"{role}_reason": F.lit(None).cast("string")})
    return v


@_q(f"""with {RAW}, ok as (select an.*, place from an join pl using (rid) where rid not in (select rid from rej)),
 bound as (select *, case when l_orderkey % 101 = 0 then null when l_orderkey % 103 = 0 then -1 else 1 end as v2, case when l_orderkey % 127 = 0 and l_linenumber = 2 then concat(l_orderkey, '-1') else trim(id_raw) end as k2, case when l_orderkey % 113 = 0 then ed + 1 else td end as t2 from ok),
 nrej as (select count(distinct rid) as r from rej), src as (select rid in (select rid from rej) as isbad from an)"""
    + _RESULTS.format(bad="isbad", rows="src", warned="place = 'UNKNOWN'", valid="bound", spelled="select count(*) as n from bound group by k2 having count(distinct trim(id_raw)) > 1", extra="count(*) filter (where l_orderkey % 131 = 0 or l_orderkey % 137 = 0) as id, count(*) filter (where v2 is null) as nu, count(*) - count(distinct k2) as du, count(*) filter (where v2 is null or v2 < 0) as am, count(*) filter (where sd > ed or t2 > ed) as da, count(*) filter (where l_orderkey % 107 = 0 or l_orderkey % 109 = 0) as te"), base=False)
def quality_of_faulty_table(spark, d):
    """Q3, Q3a-Q3d, Q4, Q8: all fifteen controls over a table with planted faults."""
    return silver.quality_results(_planted(spark, d), silver.counters(annotated(spark, d).withColumn("contract_key", F.monotonically_increasing_id()).withColumn("payload_sha256", F.lit(""))), department="America")


@_q(f"with {RAW} select role, count(*) as rows from (select 'entity' as role from an where l_orderkey % 131 = 0 and rid not in (select rid from rej) union all select 'supplier' from an where l_orderkey % 137 = 0 and rid not in (select rid from rej)) group by 1", base=False)
def identity_faults(spark, d):
    """Q8: identities that are not what their raw codes say, recomputed row by row."""
    v = _planted(spark, d)
    out = None
    for role in ("entity", "supplier"):
        again = C.identity(F.col("l_orderkey").cast("string"))
        wrong = F.struct(F.col(f"{role}_code").alias("code"), F.col(f"{role}_status").alias("status"), F.col(f"{role}_reason").alias("reason"))
        one = v.where(~again.eqNullSafe(wrong)).groupBy(F.lit(role).alias("role")).agg(F.count("*").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out
