"""Profiles of a table: columns, identities, groups, unique column sets."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almagest.functions import columns as C


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, present, nulls, null_rate, distinct_values, low, high``; a row for each column also of an empty table.

    Cells are counted by column and value first, so no row is multiplied by
    the number of distinct counts and a frequent value is one row.
    """
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])).alias("x")).select("x.*")
    counts = cells.groupBy("i", "v").agg(F.count("*").alias("n"))
    per = counts.groupBy("i").agg(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("present"), F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("nulls"), F.count("v").alias("distinct_values"), F.min("v").alias("low"), F.max("v").alias("high"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "i int, column string")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    out = names.join(per, "i", "left").select("column", zero("present"), zero("nulls"), zero("distinct_values"), "low", "high")
    return out.withColumn("null_rate", F.round(F.coalesce(C.ratio(F.col("nulls"), F.col("nulls") + F.col("present")), F.lit(0.0)), 12))


def observed_types(df: DataFrame, column: str) -> DataFrame:
    """How many values of a text column read as which type, the narrowest first."""
    c = F.trim(F.col(column).cast("string"))
    kind = F.when(F.col(column).isNull(), "null").when(c == "", "blank").when(c.rlike(r"^[+-]?\d{1,18}$"), "integer").when(c.rlike(r"^[+-]?\d+\.\d+$"), "decimal").when(F.lower(c).isin("true", "false"), "boolean").when(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull(), "date").otherwise("text")
    return df.groupBy(kind.alias("observed_type")).agg(F.count("*").alias("rows"))


def identity_coverage(df: DataFrame, role: str) -> DataFrame:
    """Rows and value by status and reason, and codes with several labels."""
    labelled = df.select(f"{role}_status", f"{role}_reason", f"{role}_code", "value", C.clean_text(F.col(f"{role}_name")).alias("label"))
    named = labelled.groupBy(f"{role}_status", f"{role}_reason", f"{role}_code").agg(F.count("*").alias("n"), F.sum("value").alias("v"), F.countDistinct("label").alias("labels"))
    return named.groupBy(F.col(f"{role}_status").alias("status"), F.col(f"{role}_reason").alias("reason")).agg(F.sum("n").alias("rows"), F.sum("v").cast("decimal(38,2)").alias("value"), F.count_if((F.col("labels") > 1) & F.col(f"{role}_code").isNotNull()).alias("codes_with_variants"))


def top_groups(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *keys).limit(n)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def unique_sets(df: DataFrame, columns: list[str], most: int = 3) -> DataFrame:
    """Column sets of up to ``most`` columns and whether they are unique: each is grouped by itself, with counts combined before the shuffle."""
    total = df.agg(F.count("*").alias("n"))
    out = None
    for s in (s for k in range(1, most + 1) for s in itertools.combinations(columns, k)):
        one = df.groupBy(*s).agg(F.lit(1)).agg(F.count("*").alias("distinct_rows")).select(F.lit("+".join(s)).alias("columns"), "distinct_rows")
        out = one if out is None else out.unionByName(one)
    return out.crossJoin(F.broadcast(total)).select("columns", "distinct_rows", (F.col("distinct_rows") == F.col("n")).alias("is_unique"))  # one row
