"""Command line: ``python -m siftlane query|build|compact ...``; 0 done, 1 failed, 2 wrong use, 3 halted until people have looked."""

from __future__ import annotations

import argparse
import sys

from siftlane.plans.pipeline import Halt
from siftlane.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siftlane")
    parser.add_argument("--master", help="Spark master; the cluster's own where it is not given")
    sub = parser.add_subparsers(dest="what", required=True)
    q = sub.add_parser("query", help="run a registered core query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--out", help="folder for the result; shown where it is not given")
    b = sub.add_parser("build", help="curate, balance and split a set")
    b.add_argument("--data", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--stage", help="run this stage alone")
    b.add_argument("--start", help="run this stage and all behind it")
    b.add_argument("--force", action="store_true")
    b.add_argument("--leave-out")
    b.add_argument("--wild", action="append", default=[])
    b.add_argument("--cap", type=int, default=1500)
    b.add_argument("--val", type=float, default=0.15)
    b.add_argument("--ack-review", action="store_true", help="people have seen the review queue")
    c = sub.add_parser("compact", help="take up new small files into few large ones")
    c.add_argument("--files", required=True)
    c.add_argument("--items", required=True)
    c.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    spark = build_session(master=args.master)
    spark.sparkContext.setLogLevel("ERROR")
    try:
        if args.what == "query":
            from siftlane.plans.queries import QUERIES

            if args.name not in QUERIES:
                print(f"no query {args.name}; there are {', '.join(sorted(QUERIES))}", file=sys.stderr)
                return 2
            df = QUERIES[args.name](spark, args.data)
            df.write.mode("overwrite").parquet(args.out) if args.out else df.show(50, False)
        elif args.what == "build":
            from siftlane.plans.build import BuildConfig, build

            build(spark, args.data, args.out, BuildConfig(cap=args.cap, val_fraction=args.val, leave_out=args.leave_out, wild=tuple(args.wild), ack_review=args.ack_review), args.stage, args.force, start=args.start)
        else:
            from siftlane.sources.tables import canonical_items
            from siftlane.streaming import compactor

            log = compactor.stored_record_log(spark, args.files, canonical_items(spark.read.parquet(args.items)), f"{args.out}/log", f"{args.out}/progress")
            compactor.seal(log).write.mode("overwrite").parquet(f"{args.out}/records")
        return 0
    except Halt as e:
        print(f"halted: {e}", file=sys.stderr)
        return 3
    except Exception as e:
        print(f"failed: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
