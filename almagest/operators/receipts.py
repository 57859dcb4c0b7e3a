"""Quality controls read from the JSON receipts of a run, one row for each control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters that a receipt without counts still lists, and what is asked of an acquisition.
COUNTERS = ("input_observations", "accepted_valid_observations", "output_contracts", "rejected_observations", "exact_duplicates", "superseded_valid_observations")
ASKED = ("truncated", "scope_scan_complete", "baseline_check_complete")

_SUMMARY = "state string, reason string, counts map<string,bigint>, controls array<struct<check_id:string,affected_rows:bigint,denominator:bigint,denominator_grain:string,passed:boolean,severity:string>>"
_COVERAGE = "acquisitions array<struct<campaign_id:string,state:string,truncated:boolean,scope_scan_complete:boolean,baseline_check_complete:boolean>>"
_COLUMNS = ["control", "numerator", "denominator", "grain", "state", "reason"]


def run_counts(receipts: DataFrame, summary: str = "summary") -> DataFrame:
    """A control for each counter of a run over its input rows; null numbers where counts are missing."""
    none = F.map_from_arrays(F.array(*map(F.lit, COUNTERS)), F.array_repeat(F.lit(None).cast("bigint"), len(COUNTERS)))
    s = receipts.select(F.from_json(summary, _SUMMARY).alias("s")).select("s.state", "s.reason", F.coalesce("s.counts", none).alias("c"))
    # one null key, so that a map without the counter gives null instead of failing
    s = s.select("state", "reason", F.explode("c").alias("control", "numerator"), F.try_element_at("c", F.lit("input_observations")).alias("denominator"))
    return s.withColumn("grain", F.lit("OBSERVATION")).select(*_COLUMNS)


def verified(receipts: DataFrame, summary: str = "summary") -> DataFrame:
    """The checks that a run has made, PASSED or FAILED, with their severity as reason."""
    c = receipts.select(F.explode(F.from_json(summary, _SUMMARY)["controls"]).alias("c"))
    return c.select(F.col("c.check_id").alias("control"), F.col("c.affected_rows").alias("numerator"), F.col("c.denominator").alias("denominator"), F.col("c.denominator_grain").alias("grain"), F.when(F.col("c.passed"), "PASSED").otherwise("FAILED").alias("state"), F.col("c.severity").alias("reason"))


def acquisition_lanes(receipts: DataFrame, coverage: str = "coverage", reason: str = "coverage_state") -> DataFrame:
    """Three yes-or-no controls for each acquisition of a receipt; an absent answer counts as no."""
    a = receipts.select(F.col(reason).alias("reason"), F.explode(F.from_json(coverage, _COVERAGE)["acquisitions"]).alias("a"))
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(F.col(f"a.{n}"), F.lit(False)).cast("bigint").alias("yes")) for n in ASKED])).alias("q")
    a = a.select("reason", "a.campaign_id", "a.state", asked)
    return a.select(F.concat(F.lit("acquisition:"), "campaign_id", F.lit(":"), "q.name").alias("control"), F.col("q.yes").alias("numerator"), F.lit(1).cast("bigint").alias("denominator"), F.lit("ACQUISITION_LANE").alias("grain"), "state", "reason")


def quality_mart(receipts: DataFrame) -> DataFrame:
    """All controls of the receipts ``summary, coverage, coverage_state``."""
    return run_counts(receipts).unionByName(verified(receipts)).unionByName(acquisition_lanes(receipts))


_SCOPE = "state string, basis string, scope struct<signing_from:string,signing_to:string>, limitations array<string>, acquisitions array<struct<campaign_id:string,state:string,truncated:boolean,scope_scan_complete:boolean>>"


def coverage_metadata(receipts: DataFrame, coverage: str = "coverage") -> DataFrame:
    """``state, signing_from, signing_to, acquisitions, limitations`` of coverage receipts, the last two as text, a line each.

    A receipt that is no JSON, and what it lacks, is null; it is never worded as if it were complete.
    """
    c = receipts.select(F.from_json(coverage, _SCOPE).alias("c"))
    flag = lambda x, yes, no: F.when(x, yes).when(~x, no).otherwise("not stated")
    line = lambda a: F.concat(F.coalesce(a["campaign_id"], F.lit("?")), F.lit(": "), F.coalesce(a["state"], F.lit("not stated")), F.lit(", scan "), flag(a["scope_scan_complete"], "complete", "partial"), F.lit(", "), flag(a["truncated"], "truncated", "whole"))
    return c.select("c.state", "c.scope.signing_from", "c.scope.signing_to", F.array_join(F.transform("c.acquisitions", line), "\n").alias("acquisitions"), F.array_join("c.limitations", "\n").alias("limitations"))
