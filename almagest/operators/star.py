"""Star schema: dimensions with an unknown member, calendar and fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almagest.functions import columns as C

DATASET = "driver"


def enrich(valid: DataFrame) -> DataFrame:
    """Natural keys, date keys and duration."""
    return valid.withColumns({
        "entity_natural": C.natural_key(DATASET, "entity", F.col("entity_code")),
        "supplier_natural": C.natural_key(DATASET, "supplier", F.col("supplier_code")),
        "municipality_natural": C.territory_key(F.col("municipality")),
        "modality_natural": C.canonical_text(F.col("modality")),
        "signing_date_key": C.date_key(F.col("signing_date")),
        "end_date_key": C.date_key(F.col("end_date")),
        "duration_days": F.datediff("end_date", "signing_date"),
    })


def party_dim(rows: DataFrame, role: str) -> DataFrame:
    """Known entities or suppliers with the label of their latest named contract, and UNKNOWN."""
    name = F.nullif(F.trim(f"{role}_name"), F.lit(""))
    w = Window.partitionBy(f"{role}_natural").orderBy(name.isNull(), F.col("source_updated_at").desc_nulls_last(), F.col("fetched_at").desc(), F.col("contract_key").desc())
    known = rows.where(F.col(f"{role}_status") == "KNOWN").withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    known = known.select(C.surrogate(f"{role}-v1", F.col(f"{role}_natural")).alias(f"{role}_key"), F.col(f"{role}_natural").alias("natural_key"), F.col(f"{role}_code").alias("code"), name.alias("label"))
    unknown = rows.sparkSession.range(1).select(C.surrogate(f"{role}-v1", F.lit(None)).alias(f"{role}_key"), F.lit(None).cast("string").alias("natural_key"), F.lit(None).cast("string").alias("code"), F.lit("UNKNOWN").alias("label"))
    return known.unionByName(unknown)


def label_dim(rows: DataFrame, role: str) -> DataFrame:
    """One row per natural key, its smallest label; UNKNOWN only where no row has it."""
    found = rows.groupBy(F.col(f"{role}_natural").alias("natural_key")).agg(F.min(role).alias("label"))
    some = found.where("natural_key is not null").unionByName(rows.sparkSession.range(1).select(F.lit(None).cast("string").alias("natural_key"), F.lit("UNKNOWN").alias("label")))
    return some.select(C.surrogate(f"{role}-v1", F.col("natural_key")).alias(f"{role}_key"), "natural_key", "label")


def date_dim(rows: DataFrame) -> DataFrame:
    """Every day between the first and last date, and key 0."""
    ends = rows.agg(F.least(F.min("signing_date"), F.min("end_date")).alias("a"), F.greatest(F.max("signing_date"), F.max("end_date")).alias("b"))
    days = ends.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("d"))
    unknown = rows.sparkSession.range(1).select(F.lit(None).cast("date").alias("d"))
    return days.unionByName(unknown).select(C.date_key(F.col("d")).alias("date_key"), F.col("d").alias("date"), F.year("d").alias("year"), F.quarter("d").alias("quarter"), F.month("d").alias("month"), F.date_format("d", "MMMM").alias("month_name"), F.dayofmonth("d").alias("day"), F.expr("extract(dayofweek_iso from d)").cast("int").alias("iso_weekday"), F.date_format("d", "EEEE").alias("day_name"))


def fact(rows: DataFrame) -> DataFrame:
    """One row per contract. Surrogates are functions of natural keys, so no dimension is joined."""
    key = lambda role: C.surrogate(f"{role}-v1", F.when(F.col(f"{role}_status") == "KNOWN", F.col(f"{role}_natural")) if role in ("entity", "supplier") else F.col(f"{role}_natural")).alias(f"{role}_key")
    return rows.select("contract_key", key("entity"), key("supplier"), key("municipality"), key("modality"), "signing_date_key", "end_date_key", "duration_days", "value", "status", "payload_sha256", "signing_date", "source_updated_at")


def detail(facts: DataFrame, entity: DataFrame, supplier: DataFrame, municipality: DataFrame, modality: DataFrame) -> DataFrame:
    """The fact with its members' labels; Spark broadcasts those dimensions whose measured size allows it."""
    out = facts
    for role, dim in (("entity", entity), ("supplier", supplier), ("municipality", municipality), ("modality", modality)):
        out = out.join(dim.select(f"{role}_key", F.col("natural_key").alias(f"{role}_natural"), F.col("label").alias(f"{role}_label")), f"{role}_key", "left")
    return out.withColumns({"signing_month": C.month(F.col("signing_date")), "status_bucket": C.status_bucket(F.col("status")), "duration_state": F.when(F.col("duration_days").isNull(), "UNKNOWN").when(F.col("duration_days") < 0, "NEGATIVE").otherwise("AVAILABLE")})
