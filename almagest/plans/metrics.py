"""Governed metrics with filters: overview, entity by month, concentration, detail, quality.

Supplier selection narrows ``selected`` only; HHI and coverage stay on
``reference``. Every number that may be missing says why in a state column.
"""

from __future__ import annotations

import dataclasses
import datetime
import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almagest.functions import columns as C
from almagest.sources.store import scratch_dir


@dataclasses.dataclass(frozen=True)
class Filters:
    entity_keys: tuple[str, ...] | None = None
    municipality_keys: tuple[str, ...] | None = None
    modality_keys: tuple[str, ...] | None = None
    statuses: tuple[str, ...] | None = None
    exclude_statuses: tuple[str, ...] | None = None
    start: datetime.date | None = None
    end: datetime.date | None = None
    missing_signatures: bool | None = None
    selected_supplier: str | None = None

    def __post_init__(self):
        if self.selected_supplier is not None and not isinstance(self.selected_supplier, str):
            raise ValueError("MANY_SUPPLIERS")
        if self.statuses and self.exclude_statuses and set(self.statuses) & set(self.exclude_statuses):
            raise ValueError("STATUS_OVERLAP")
        if self.start and self.end and self.start >= self.end:
            raise ValueError("INVERTED_INTERVAL")
        if self.missing_signatures and (self.start or self.end):
            raise ValueError("MISSING_SIGNATURE_WITH_INTERVAL")

    def check_keys(self, detail: DataFrame) -> None:
        """Fail with UNKNOWN_<ROLE>_KEY if a key is no member; one pass looks for all named keys, and for no others."""
        asked = {r: tuple(k) for r in ("entity", "municipality", "modality") if (k := getattr(self, f"{r}_keys"))}
        if self.selected_supplier:
            asked["supplier"] = (self.selected_supplier,)
        if not asked:
            return
        found = detail.agg(*[F.collect_set(F.when(F.col(f"{r}_key").isin(*keys), F.col(f"{r}_key"))).alias(r) for r, keys in asked.items()]).first()
        for role, keys in asked.items():
            if set(keys) - set(found[role]):
                raise ValueError(f"UNKNOWN_{role.upper()}_KEY")

    def reference(self, d: DataFrame) -> DataFrame:
        for name, col in (("entity_keys", "entity_key"), ("municipality_keys", "municipality_key"), ("modality_keys", "modality_key"), ("statuses", "status_bucket")):
            if getattr(self, name) is not None:
                d = d.where(F.col(col).isin(*getattr(self, name)))
        if self.exclude_statuses is not None:
            d = d.where(~F.col("status_bucket").isin(*self.exclude_statuses))
        if self.start:
            d = d.where(F.col("signing_date") >= F.lit(self.start))
        if self.end:
            d = d.where(F.col("signing_date") < F.lit(self.end))
        if self.missing_signatures is not None:
            d = d.where(F.col("signing_date").isNull() == F.lit(self.missing_signatures))
        return d

    def selected(self, d: DataFrame) -> DataFrame:
        d = self.reference(d)
        return d.where(F.col("supplier_key") == self.selected_supplier) if self.selected_supplier else d


NONE = Filters()


_QUANTILE_STATE = lambda: F.when(F.col("contract_count") == 0, "NO_CONTRACTS").when(F.col("median").isNull(), "NO_NON_NULL_VALUES").otherwise("AVAILABLE")
STORED = ["entity_key", "municipality_key", "modality_key", "signing_month", "status_bucket"]
#: Ranges that all values are cut into, a power of two; and distinct values of a group up to which it is one range.
RANGES, ONE_RANGE = 1024, 1_000_000


def _written(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _counted(rows: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """Rows counted by group, value and ``more``, written once: all measures and ranks of a metric are taken from it."""
    counted = rows.groupBy(*keys, F.col("value").alias("v"), *more).agg(F.count("*").alias("n"), F.count_if(F.col("signing_date").isNull()).alias("missing"), F.count_if(F.col("supplier_natural").isNull()).alias("unknown"))
    return _written(counted, "counted")


def _measures() -> list:
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    total = F.coalesce(F.sum(F.col("v") * F.col("n")), F.lit(0)).cast("decimal(38,2)")
    return [count("n").alias("contract_count"), total.alias("total_value"), count("missing").alias("missing_signing"), count("unknown").alias("unknown_supplier")]


def overview(detail: DataFrame, f: Filters = NONE, stored: bool = False) -> DataFrame:
    """Counts, exact totals and quantiles; pooled in one row, or at the stored grain."""
    keys = STORED if stored else []
    return _grouped(_counted(f.selected(detail), keys), keys, _measures()).withColumn("quantile_state", _QUANTILE_STATE())


def quantiles(rows: DataFrame, keys: list[str] | None = None, value: str = "value") -> DataFrame:
    """Exact quartiles of each group, or of all rows in one row; null where a group has no value."""
    keys = keys or []
    return _grouped(_written(rows.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("n")), "counted"), keys, [])


def _grouped(counted: DataFrame, keys: list[str], measures: list) -> DataFrame:
    """``keys``, ``measures`` and the quartiles of ``v``, each row of ``counted`` standing for ``n``.

    No task holds all values of a large group. Groups of up to ``ONE_RANGE``
    values are ranked by one window. If there is a larger one, values are cut
    into ranges at quantiles of a sketch, so a range holds its share however
    skewed the values are; the counts of a group's ranges are summed in a table
    of ``RANGES`` rows a group at most; and only the ranges that hold a wanted
    rank are sorted. A null key is a value like any other.
    """
    from pyspark.sql import Window

    def quartiles():
        def at(p: int):
            h = (F.col("_all") - 1) * p
            low, high = F.floor(h / 4).cast("bigint"), F.ceil(h / 4).cast("bigint")
            pick = lambda r: F.max(F.when((r >= F.col("_from")) & (r < F.col("_to")), F.col("v")))
            a, b = pick(low), pick(high)
            rest = F.max((h % 4).cast("decimal(10,0)"))
            return (a + ((b - a) * rest / F.lit(4).cast("decimal(10,0)")).cast("decimal(24,4)")).cast("decimal(24,4)")

        return [at(1).alias("p25"), at(2).alias("median"), at(3).alias("p75")]

    most = counted.groupBy(*keys).agg(F.count("v").alias("k")).agg(F.max("k")).first()[0] or 0
    held = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(F.lit(0))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    if most <= ONE_RANGE:
        ranked = counted.withColumn("_all", F.sum(held).over(group)).withColumn("_to", F.sum(held).over(group.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("_from", F.col("_to") - held)
        return ranked.groupBy(*keys).agg(*measures, *quartiles())
    counts = counted.where("v is not null").groupBy(F.struct(F.lit(0).alias("all_rows"), *keys).alias("_g"), "v").agg(F.sum("n").alias("n"))
    cuts = counts.agg(F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("_cuts"))  # one row
    # binary search: the number of cuts below the value
    steps = ",".join(str(RANGES >> i) for i in range(1, RANGES.bit_length()))
    part = F.expr(f"aggregate(array({steps}), 0, (at, step) -> if(_cuts[at + step - 1] < v, at + step, at))")
    placed = counts.crossJoin(F.broadcast(cuts)).withColumn("_part", part).drop("_cuts")
    ranges = placed.groupBy("_g", "_part").agg(F.sum("n").alias("_m"))
    ranges = ranges.withColumn("_before", F.sum("_m").over(Window.partitionBy("_g").orderBy("_part")) - F.col("_m")).withColumn("_all", F.sum("_m").over(Window.partitionBy("_g")))
    wanted = F.array(*[g((F.col("_all") - 1) * p / 4).cast("bigint") for p in (1, 2, 3) for g in (F.floor, F.ceil)])
    ranges = ranges.where(F.exists(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_m")))).drop("_m")
    ranked = placed.join(ranges, ["_g", "_part"])
    ranked = ranked.withColumn("_to", F.col("_before") + F.sum("n").over(Window.partitionBy("_g", "_part").orderBy("v"))).withColumn("_from", F.col("_to") - F.col("n"))
    found = ranked.groupBy("_g").agg(*quartiles())
    groups = counted.groupBy(F.struct(F.lit(0).alias("all_rows"), *keys).alias("_g")).agg(*(measures or [F.count("*").alias("_rows")])) if keys else counted.agg(*(measures or [F.count("*").alias("_rows")])).withColumn("_g", F.struct(F.lit(0).alias("all_rows")))
    out = groups.join(found, "_g", "left")
    return out.select(*[F.col(f"_g.{k}").alias(k) for k in keys], *[c for c in out.columns if c not in ("_g", "_rows")])


def entity_monthly(detail: DataFrame, f: Filters = NONE) -> DataFrame:
    """Per entity and month, with the contracts of each status as a sorted map."""
    from pyspark.sql import Window

    keys = ["entity_key", "signing_month"]
    counted = _counted(f.selected(detail), keys, "status_bucket")
    counted = counted.withColumn("_s", F.sum("n").over(Window.partitionBy(*keys, "status_bucket")))
    made = [*_measures()[:2], F.map_from_entries(F.array_sort(F.collect_set(F.struct("status_bucket", F.col("_s").alias("n"))))).alias("statuses")]
    return _grouped(counted, keys, made).withColumn("quantile_state", _QUANTILE_STATE())


def shares(detail: DataFrame, f: Filters = NONE) -> DataFrame:
    """Contracts and value of each entity as shares of all; the totals are one row that is joined."""
    rows = f.selected(detail).groupBy("entity_key").agg(F.count("*").alias("n"), F.sum("value").cast("decimal(38,2)").alias("v"))
    total = rows.agg(F.sum("n").alias("tn"), F.sum("v").cast("decimal(38,2)").alias("tv"))
    return rows.crossJoin(F.broadcast(total)).select("entity_key", F.round(C.ratio(F.col("n"), F.col("tn")), 12).alias("count_share"), F.round(C.ratio(F.col("v"), F.col("tv")), 12).alias("value_share"))


def concentration(detail: DataFrame, f: Filters = NONE, monthly: bool = False, min_count: float | None = 1.0, min_value: float | None = 1.0) -> DataFrame:
    """HHI of known suppliers, identity coverage and the selected supplier's share, with states."""
    grain = ["entity_key", "signing_month"] if monthly else ["entity_key"]
    ref = f.reference(detail)
    known = F.col("supplier_natural").isNotNull()
    chosen = F.col("supplier_key") == F.lit(f.selected_supplier) if f.selected_supplier else F.lit(True)
    by = ref.groupBy(*grain, "supplier_key").agg(F.max(known).alias("known"), F.max(F.col("entity_natural").isNotNull()).alias("entity_known"), F.count("*").alias("n"), F.sum("value").cast("decimal(38,2)").alias("v"), F.max(chosen).alias("chosen"))
    kv, kn = F.when(F.col("known"), F.col("v")), F.when(F.col("known"), F.col("n"))
    g = by.groupBy(*grain).agg(
        F.max("entity_known").alias("entity_known"), F.sum("n").alias("contract_count"), F.sum("v").cast("decimal(38,2)").alias("total_value"),
        F.coalesce(F.sum(kn), F.lit(0)).alias("known_count"), F.coalesce(F.sum(kv), F.lit(0)).cast("decimal(38,2)").alias("known_value"),
        F.sum(kv.cast("double") * kv.cast("double")).alias("_squares"),  # doubles take the square of any sum; the ratio is rounded far above their error
        F.coalesce(F.sum(F.when(F.col("chosen"), F.col("n"))), F.lit(0)).alias("selected_contract_count"),
        F.sum(F.when(F.col("chosen") & F.col("known"), F.col("v"))).cast("decimal(38,2)").alias("_chosen"),
    )
    cov_n, cov_v = C.ratio(F.col("known_count"), F.col("contract_count")), C.ratio(F.col("known_value"), F.col("total_value"))
    ok = lambda x: x is not None and 0 <= x <= 1
    state = (
        F.when(F.lit(not (ok(min_count) and ok(min_value))), "POLICY_UNCONFIGURED").when(F.col("contract_count") == 0, "NO_CONTRACTS").when(~F.col("entity_known"), "UNKNOWN_ENTITY")
        .when(F.col("known_count") == 0, "NO_KNOWN_SUPPLIERS").when(F.col("total_value") == 0, "ZERO_TOTAL_VALUE").when(F.col("known_value") == 0, "ZERO_KNOWN_VALUE")
        .when((cov_n < F.lit(min_count or 0.0)) | (cov_v < F.lit(min_value or 0.0)), "INSUFFICIENT_IDENTITY_COVERAGE").otherwise("AVAILABLE")
    )
    hhi = F.round(F.col("_squares") / F.nullif(F.col("known_value").cast("double") * F.col("known_value").cast("double"), F.lit(0.0)), 10)
    share_state = F.when(F.col("known_count") == 0, "NO_KNOWN_SUPPLIERS").when(F.col("known_value") == 0, "ZERO_KNOWN_VALUE").when(F.lit(f.selected_supplier is None) | F.col("_chosen").isNull(), "NO_SELECTED_KNOWN_SUPPLIER").otherwise("AVAILABLE")
    out = g.withColumns({"hhi_state": state, "share_state": share_state, "count_coverage": F.round(cov_n, 10), "value_coverage": F.round(cov_v, 10)})
    return out.withColumns({"hhi": F.when(F.col("hhi_state") == "AVAILABLE", hhi), "selected_share": F.when(F.col("share_state") == "AVAILABLE", F.round(C.ratio(F.col("_chosen"), F.col("known_value")), 10))}).drop("_squares", "_chosen", "entity_known")


def quality_controls(detail: DataFrame, f: Filters = NONE, profiled: tuple[str, ...] = ()) -> DataFrame:
    """``control, numerator, denominator``: one pass, a row for each control even for an empty selection."""
    rows = f.selected(detail)
    tests = {
        "missing_signing_date": F.col("signing_date").isNull(), "unknown_supplier": F.col("supplier_natural").isNull(), "unknown_entity": F.col("entity_natural").isNull(),
        "missing_status": F.col("status_bucket") == "__MISSING__", "unprofiled_status": ~F.col("status_bucket").isin("__MISSING__", *profiled), "missing_source_update": F.col("source_updated_at").isNull(), "selected_unique_contracts": F.lit(True),
    }
    one = rows.agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in tests.items()])
    pairs = ", ".join(f"'{k}', {k}" for k in tests)
    return one.selectExpr("n", f"stack({len(tests)}, {pairs}) as (control, numerator)").select("control", "numerator", F.col("n").alias("denominator"))


def quality_grains(detail: DataFrame, f: Filters = NONE, profiled: tuple[str, ...] = ()) -> DataFrame:
    """The controls of the publication (G), of the reference (R), and of the selected supplier's rows (S)."""
    whole = quality_controls(detail, NONE, profiled).withColumn("grain", F.lit("G"))
    ref = quality_controls(detail, dataclasses.replace(f, selected_supplier=None), profiled).withColumn("grain", F.lit("R"))
    return whole.unionByName(ref).unionByName(quality_controls(detail, f, profiled).withColumn("grain", F.lit("S")))


def entity_concentration(detail: DataFrame, f: Filters, policy: dict, digest: str, monthly: bool = False) -> DataFrame:
    """Concentration of exactly one entity, its months pooled, under a policy whose digest is the published one."""
    if not f.entity_keys or len(set(f.entity_keys)) != 1:
        raise ValueError("ONE_ENTITY_REQUIRED")
    if hashlib.sha256(json.dumps(policy, sort_keys=True, separators=(",", ":")).encode()).hexdigest() != digest:
        raise ValueError("POLICY_CHANGED")
    return concentration(detail, f, monthly, policy.get("min_count"), policy.get("min_value"))


def query(metric: str, detail: DataFrame, f: Filters = NONE, limit: int = 100, offset: int = 0) -> DataFrame:
    """A bounded page of a metric in the order of its rows' text; the page size is the feature."""
    if metric not in METRICS:
        raise ValueError("UNKNOWN_METRIC")
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("INVALID_PAGE")
    f.check_keys(detail)
    return page(METRICS[metric](detail, f), limit, offset)


def page(df: DataFrame, limit: int, offset: int) -> DataFrame:
    return df.orderBy(F.to_json(F.struct(*df.columns))).offset(offset).limit(limit)


METRICS = {"overview": overview, "entity_monthly": entity_monthly, "concentration": concentration, "detail": lambda d, f: f.selected(d), "quality": quality_controls}
