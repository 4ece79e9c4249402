"""Command line: run the pipeline, or some of its steps.

    spark-submit --conf spark.checkpoint.dir=<shared dir> <repository>/viewlog/__main__.py \
        --raw <log dir> --out <output dir> [--steps ingest,transform] [--glob 'logt*.txt']

Starts from any folder: the package is found beside this file and its modules
are sent to the workers. Prints the run log (step, seconds, rows) as JSON
lines. A database target is named by ``--jdbc-url`` and its companions, or by
the environment variables ``VIEWLOG_JDBC_URL``, ``_USER``, ``_PASSWORD``,
``_DRIVER`` and ``_CONNECTIONS``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STEPS = ("check", "ingest", "transform", "load", "quality", "reports")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="viewlog", description=__doc__.splitlines()[0])
    ap.add_argument("--raw", required=True, help="folder with the text log files")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--glob", default="logt*.txt", help="file name pattern of the logs")
    ap.add_argument("--steps", default=",".join(STEPS),
                    help=f"comma-separated subset of {','.join(STEPS)} (default: all)")
    ap.add_argument("--table-prefix", default="", help="prefix for the catalog tables")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ap.add_argument("--incremental", action="store_true",
                    help="process only files new since the last run and rebuild the dates they touch")
    ap.add_argument("--max-files-per-batch", type=int, default=None,
                    help="with --incremental: ingest a backlog in batches of so many files")
    for name, about in (("url", "JDBC url; loads into this database instead of catalog tables"), ("user", "database user"),
                        ("driver", "JDBC driver class"), ("num-partitions", "concurrent connections at most")):
        ap.add_argument(f"--jdbc-{name}", default=None, help=about)
    args = ap.parse_args(argv)
    steps = tuple(s.strip() for s in args.steps.split(",") if s.strip())
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        ap.error(f"unknown steps: {unknown}")

    from viewlog.plans.pipeline import run, run_incremental
    from viewlog.session import get_spark
    from viewlog.sources.sinks import jdbc_settings

    jdbc = jdbc_settings(os.environ, url=args.jdbc_url, user=args.jdbc_user, driver=args.jdbc_driver,
                         num_partitions=args.jdbc_num_partitions)
    spark = get_spark(args.master, app_name="viewlog-pipeline")
    if args.incremental:
        result = run_incremental(spark, args.raw, args.out, glob=args.glob,
                                 table_prefix=args.table_prefix, jdbc=jdbc,
                                 max_files_per_batch=args.max_files_per_batch)
    else:
        result = run(spark, args.raw, args.out, glob=args.glob, steps=steps,
                     table_prefix=args.table_prefix, jdbc=jdbc)
    for step, seconds, rows in result.steps:
        print(json.dumps({"run_id": result.run_id, "step": step,
                          "seconds": round(seconds, 3), "rows": rows}))
    if result.skipped:
        print(json.dumps({"run_id": result.run_id, "skipped": "no matching log files"}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
