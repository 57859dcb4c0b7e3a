"""``python -m almagest list``, ``run QUERY --data DIR [--out DIR]``, ``runs ROOT --dataset ID``, ``verify ROOT``, ``versions ROOT``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from almagest.plans import registry as queries
from almagest.sources import package, runs, store


def main(argv: list[str] | None = None) -> int:
    """0 when done, 1 when something was found that should not be, 2 for a name that is not known."""
    parser = argparse.ArgumentParser(prog="almagest", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the queries and what they give")
    run = sub.add_parser("run", help="run a query over a folder of Parquet tables")
    run.add_argument("query")
    run.add_argument("--data", required=True, help="folder that holds the tables")
    run.add_argument("--out", help="write Parquet here; it may not exist yet")
    run.add_argument("--rows", type=int, default=20, help="rows shown when nothing is written")
    ingested = sub.add_parser("runs", help="committed runs of a dataset, after their pages were checked")
    ingested.add_argument("root")
    ingested.add_argument("--dataset", required=True)
    ingested.add_argument("--recover", action="store_true", help="first settle the runs that a crash left open")
    verified = sub.add_parser("verify", help="check an export package against its manifest")
    verified.add_argument("root")
    versions = sub.add_parser("versions", help="versions of a store, the current one marked")
    versions.add_argument("root")
    versions.add_argument("--activate", help="make this version current")
    versions.add_argument("--expect", help="only if this one is current now")
    asked = parser.parse_args(argv)
    if asked.command == "list":
        for name, f in queries.QUERIES.items():
            print(f"{name}\t{(f.__doc__ or '').strip()}")
        return 0
    if asked.command == "run" and asked.query not in queries.QUERIES:
        print(f"UNKNOWN_QUERY {asked.query}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"almagest {asked.command}").getOrCreate()
    try:
        return {"run": _run, "runs": _runs, "verify": _verify, "versions": _versions}[asked.command](spark, asked)
    except ValueError as error:
        print(error, file=sys.stderr)
        return 1


def _run(spark: SparkSession, asked: argparse.Namespace) -> int:
    df = queries.QUERIES[asked.query](spark, asked.data)
    if asked.out:
        df.write.mode("errorifexists").parquet(asked.out)
    else:
        df.show(asked.rows, truncate=False)
    return 0


def _runs(spark: SparkSession, asked: argparse.Namespace) -> int:
    for run in runs.recover(spark, asked.root) if asked.recover else []:
        print(f"SETTLED {run}")
    found = runs.resolve_runs(spark, asked.root, asked.dataset)
    bad = runs.page_faults(spark, asked.root, found).collect()  # pages of manifests that are in memory already
    for m in found:
        print(f"{m['run_id']}\t{len(m['pages'])} pages\t{m['written']} rows")
    for r in bad:
        print(f"{r.fault} {r.run_id}/{r.path}", file=sys.stderr)
    return int(bool(bad))


def _verify(spark: SparkSession, asked: argparse.Namespace) -> int:
    none = True
    for r in package.package_faults(spark, asked.root).toLocalIterator():
        print(f"{r.fault} {r.subject}", file=sys.stderr)
        none = False
    return int(not none)


def _versions(spark: SparkSession, asked: argparse.Namespace) -> int:
    held = store.VersionStore(spark, asked.root)
    if asked.activate:
        held.activate(asked.activate, asked.expect)
    now = held.current()
    for v in held.versions():
        print(f"{'*' if v == now else ' '} {v}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
