"""Order lines of a trading schema as contract observations, and the stages built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almagest.functions import columns as C
from almagest.operators import silver, star
from almagest.sources.store import scratch_dir, spread


#: Codes and places as the source writes them; the same text is SQL for both engines.
ENTITY_RAW = "case when o_custkey % 41 = 0 then null when o_custkey % 43 = 0 then ' n/a ' when o_custkey % 47 = 0 then concat('X', cast(o_custkey as varchar(20))) else cast(o_custkey as varchar(20)) end"
SUPPLIER_RAW = "case when (l_suppkey + l_orderkey) % 37 = 0 then '  ' when l_orderkey % 31 = 0 then '0' when l_orderkey % 29 = 0 then concat(cast(l_suppkey as varchar(20)), '-9') else cast(l_suppkey as varchar(20)) end"
PLACE_RAW = "case when l_orderkey % 23 = 0 then null when l_orderkey % 19 = 0 then 'Unknown' else municipality end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An observation for each order line; sizes decide which joins are broadcast."""
    line, orders, cust, supp, nation, region = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "nation", "region"))
    money = [F.col(c).cast(C.MONEY) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    payload = F.sha2(F.concat_ws(C.UNIT, *[F.col(c).cast("string") for c in ids], *[m.cast("string") for m in money], "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").cast("string")), 256)
    line = spread(line.select(*ids, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"))
    rows = line.select(*ids, "l_linestatus", F.col("l_shipdate").cast("date").alias("end_date"), F.col("l_extendedprice").cast(C.MONEY).alias("value"), payload.alias("payload_sha256"))
    rows = rows.join(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("signing_date")), rows.l_orderkey == orders.o_orderkey)
    place = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select("n_nationkey", F.col("n_name").alias("municipality"), F.col("r_name").alias("department"))
    rows = rows.join(cust.select("c_custkey", F.col("c_name").alias("entity_name"), "c_nationkey"), rows.o_custkey == F.col("c_custkey"), "left").join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(supp.select("s_suppkey", F.col("s_name").alias("supplier_name")), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    source = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    # by key rules some codes are missing, placeholders or no codes, and some places are missing or named "Unknown"
    ec, sc = F.expr(ENTITY_RAW), F.expr(SUPPLIER_RAW)
    e, s = C.identity(ec), C.identity(sc)
    return rows.select(
        source.alias("source_id_raw"), C.contract_key("driver", source).alias("contract_key"), "payload_sha256",
        ec.alias("entity_code_raw"), e["code"].alias("entity_code"), e["status"].alias("entity_status"), e["reason"].alias("entity_reason"), "entity_name",
        sc.alias("supplier_code_raw"), s["code"].alias("supplier_code"), s["status"].alias("supplier_status"), s["reason"].alias("supplier_reason"), "supplier_name",
        F.expr(PLACE_RAW).alias("municipality"), "department", F.col("o_orderpriority").alias("modality"), F.when(F.col("l_orderkey") % 17 != 0, F.col("o_orderstatus")).alias("status"),
        "signing_date", "end_date", "value", F.col("end_date").alias("source_updated_at"), F.col("signing_date").alias("fetched_at"),
    )


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with their rejections: the signing date may not be after the end date."""
    obs = observations(spark, sf_dir)
    return silver.with_rejections(obs, silver.date_rules({}, {"signing": F.col("signing_date"), "end": F.col("end_date")}))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedupe(silver.accepted(checked(spark, sf_dir)).drop("rejection_details", "rejection_codes"))


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.enrich(valid(spark, sf_dir))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rows``, written once, for queries that read them several times: versions are chosen once."""
    path = scratch_dir(spark, "rows")
    made = rows(spark, sf_dir)
    made.write.mode("overwrite").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail mart. Labels are joined only where they are asked for (``star.detail``)."""
    return marted(rows(spark, sf_dir))


def marted(r: DataFrame) -> DataFrame:
    """The detail mart of enriched rows."""
    role = lambda n, known: C.surrogate(f"{n}-v1", F.when(F.col(f"{n}_status") == "KNOWN", F.col(f"{n}_natural")) if known else F.col(f"{n}_natural")).alias(f"{n}_key")
    return r.select("contract_key", "payload_sha256", role("entity", True), role("supplier", True), role("municipality", False), role("modality", False), "entity_natural", "supplier_natural", "signing_date", "end_date", "duration_days", "value", "source_updated_at", C.status_bucket(F.col("status")).alias("status_bucket"), C.month(F.col("signing_date")).alias("signing_month"))
