"""Run the staging job for one cob date.

    python -m stagecraft \\
        --entity s3://.../entity --config s3://.../config \\
        --population s3://.../population --dpd s3://.../dpd \\
        --min-factor-date 2017-04-30 \\
        --result s3://.../stage_status [--impute-into s3://.../dpd] [--format parquet]

A scheduler gives each run a ``--run-id``; a retry with the same one goes on where the first ended.
With ``--format table`` the four inputs and the targets are catalog table names.
The session comes from the cluster (``getOrCreate``); its ``spark.checkpoint.dir``
is used to checkpoint the per-loan table. (For ``spark-submit``, pass it this file and the
package with ``--py-files``.)
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json

from pyspark.sql import SparkSession

from stagecraft.sources.params import resolve_params
from stagecraft.sources.sinks import run_stage_status
from stagecraft.sources.tables import StageInputs


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="stagecraft", description=__doc__.split("\n")[0])
    for name in ("entity", "config", "population", "dpd"):
        ap.add_argument(f"--{name}", required=True, help=f"{name} table (path, or name with --format table)")
    ap.add_argument("--min-factor-date", required=True, type=dt.date.fromisoformat, help="window start")
    ap.add_argument("--result", required=True, help="stage status target (overwritten)")
    ap.add_argument("--impute-into", help="DPD table to append imputed rows to")
    ap.add_argument("--format", default="parquet", help="storage format, or 'table' for catalog tables")
    ap.add_argument("--partitions", type=int, help="partitions of the per-loan stages (default: sized)")
    ap.add_argument("--entity-code", help="entity code stamped on imputed rows")
    ap.add_argument("--run-ts", type=dt.datetime.fromisoformat, help="audit timestamp (default: now)")
    ap.add_argument("--versioned", action="store_true", help="publish a path as a version (see stagecraft.sources.storage)")
    ap.add_argument("--run-id", help="name of the run: another attempt of that name goes on from the first one's stage table")
    ap.add_argument("--stage-folder", help="folder of stage tables (default: below the checkpoint folder)")
    ap.add_argument("--counts", action="store_true", help="also print what the run dropped and filled")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("stagecraft").getOrCreate()

    def load(name: str):
        target = getattr(args, name)
        return spark.table(target) if args.format == "table" else spark.read.format(args.format).load(target)

    inputs = StageInputs(load("entity"), load("config"), load("population"), load("dpd"))
    params = resolve_params(inputs.entity, inputs.config, args.min_factor_date, args.run_ts or dt.datetime.now())
    options = {}
    if args.partitions:
        options["partitions"] = args.partitions
    if args.entity_code:
        options["entity_code"] = args.entity_code
    report = run_stage_status(
        inputs, params, args.result, args.impute_into, fmt=args.format, versioned=args.versioned,
        run_id=args.run_id, stage_folder=args.stage_folder, **options,
    )
    out = {
        "reporting_date": params.reporting_date.isoformat(),
        "result_rows": report.result_rows,
        "imputed_rows": report.imputed_rows,
        "materialised": report.materialised,
    }
    if args.counts:
        out |= {k: v for k, v in dataclasses.asdict(report).items() if k not in out}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
