"""Run registered jobs from the command line (spark-submit friendly).

    python -m tickforge list
    python -m tickforge run ltp --data /data/sf1 --out /shared/out/ltp
    python -m tickforge explain historical --data /data/sf1

``run`` writes the job's result as Parquet (overwrite); ``explain`` prints the
formatted physical plan.  On a cluster the master and ``spark.checkpoint.dir``
come from spark-submit.
"""

from __future__ import annotations

import argparse
import sys

from tickforge.plans.catalog import queries
from tickforge.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tickforge")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered jobs")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("job")
        p.add_argument("--data", required=True, help="folder holding the input tables")
        p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
        if name == "run":
            p.add_argument("--out", required=True, help="output folder (Parquet)")
    args = ap.parse_args(argv)
    jobs = queries()
    if args.cmd == "list":
        print("\n".join(sorted(jobs)))
        return 0
    if args.job not in jobs:
        print(f"unknown job {args.job!r}; see `python -m tickforge list`", file=sys.stderr)
        return 2
    spark = build_session(args.master)
    df = jobs[args.job](spark, args.data)
    if args.cmd == "explain":
        df.explain("formatted")
    else:
        df.write.mode("overwrite").parquet(args.out)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
