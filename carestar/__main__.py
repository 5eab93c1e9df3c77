"""Command line: run the pipeline steps or any registered query.

    python -m carestar build  --sf /root/testdata/sf0.1            # publish the warehouse build
    python -m carestar query  --sf /root/testdata/sf0.1 kpi_sex_split [--out DIR] [--show N]
    python -m carestar daily  --sf /root/testdata/sf0.1 --out DIR   # audit -> build -> mart -> KPIs -> exports
    python -m carestar list                                         # registered query keys

The session comes from the environment (``spark-submit`` / cluster defaults);
``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="carestar")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--sf", required=True)
    q = sub.add_parser("query")
    q.add_argument("--sf", required=True)
    q.add_argument("names", nargs="+")
    q.add_argument("--out", default=None, help="write each result as Parquet below this folder")
    q.add_argument("--show", type=int, default=20)
    d = sub.add_parser("daily")
    d.add_argument("--sf", required=True)
    d.add_argument("--out", required=True, help="shared folder for the mart, KPI cache, exports and run log")
    sub.add_parser("list")
    args = ap.parse_args(argv)

    from .plans.catalog import all_queries
    if args.cmd == "list":
        print("\n".join(sorted(all_queries())))
        return 0

    from .session import build_session
    spark = build_session(args.master)
    if args.cmd == "build":
        from .plans.build import warehouse_for
        wh = warehouse_for(spark, args.sf).publish()
        print(json.dumps({"warehouse": wh.path}))
        return 0
    if args.cmd == "daily":
        from .plans.build import run_daily
        run_daily(spark, args.sf, args.out).select("task_name", "status", "records").show(truncate=False)
        return 0
    qs = all_queries()
    for name in args.names:
        df = qs[name](spark, args.sf)
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        else:
            df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
