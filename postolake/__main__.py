"""Command line: ``python -m postolake run --bronze DIR --out DIR``.

Runs the batch (bronze -> quality -> silver -> gold) on the given session
settings and prints the quality results, the load report and stage timings.
"""

from __future__ import annotations

import argparse
import json

from postolake.plans.batch import run_lake
from postolake.session import build_session


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="postolake")
    sub = parser.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="bronze tree -> silver and gold Parquet tables")
    run.add_argument("--bronze", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--sample", choices=["first", "all"], default="first")
    run.add_argument("--no-archives", action="store_true", help="leave *.zip archives unread")
    run.add_argument("--on-reject", choices=["raise", "skip"], default="raise", help="files without any expected column")
    run.add_argument("--encoding", default=None, help="known charset; skips per-file detection")
    run.add_argument("--master", default="local[*]")
    args = parser.parse_args(argv)

    spark = build_session(args.master)
    result = run_lake(
        spark,
        args.bronze,
        args.out,
        sample=args.sample,
        include_archives=not args.no_archives,
        encoding=args.encoding,
        on_reject=args.on_reject,
    )
    result.quality.show(truncate=False)
    result.rejects.show(truncate=False)
    result.load_report.show(truncate=False)
    print(json.dumps(result.seconds))
    spark.stop()


if __name__ == "__main__":
    main()
