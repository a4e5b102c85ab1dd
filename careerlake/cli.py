"""Commands: smoke (the gate over a run's manifest) and audit (a seed list against probes and the last run)."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from careerlake.operators import seeds
from careerlake.plans import gate
from careerlake.schemas import PROBE
from careerlake.settings import session
from careerlake.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="careerlake", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    smoke = sub.add_parser("smoke")
    smoke.add_argument("manifest")
    smoke.add_argument("--most-quarantined", type=float, default=gate.MOST_QUARANTINED)
    smoke.add_argument("--least-success", type=float, default=gate.LEAST_SUCCESS)
    audit = sub.add_parser("audit")
    for name in ("seeds", "probes", "out"):
        audit.add_argument(name)
    audit.add_argument("--runs", help="folder of run_* folders; the last portal summary there counts")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.command == "smoke":
        runs = readers.manifest(spark, args.manifest).select("run_id", "close_reason", "counts.jobs_exported_total", "counts.jobs_quarantined_total", "quality.job_detail_success_rate")
        row = gate.checked(runs, args.most_quarantined, args.least_success).first()
        print(json.dumps(row.asDict() if row else {"failure": "no manifest"}))
        return int(row is None or row["failure"] is not None)
    last = readers.latest_run(spark, args.runs) if args.runs else None
    probes = spark.read.schema(PROBE).json(args.probes)
    audited = seeds.recommend(seeds.classify(readers.seed_csv(spark, args.seeds), probes), readers.portal_summary_file(spark, last) if last else None)
    writers.audit(audited, f"{args.out}/report", f"{args.out}/recommended")
    print(json.dumps({r["name"]: r["n"] for r in seeds.audit_totals(audited).orderBy(F.col("name")).collect()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
