"""Command line: ``python -m strata run|watch ...``.

``run``   one full load of every table, layer by layer (J4); prints the run log.
``watch`` incremental loads from landing folders with Structured Streaming (J5).
"""

from __future__ import annotations

import argparse
import sys

from strata import specs as S


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="load all tables once: raw, trusted, refined")
    watch = sub.add_parser("watch", help="stream new landing files into the layers")
    for p in (run, watch):
        p.add_argument("--landing", required=True, help="folder with one entry per feed file")
        p.add_argument("--lake", required=True, help="base folder of the layer tables")
        p.add_argument("--tables", default=",".join(S.SPECS), help="comma-separated table names")
        p.add_argument("--key", default="natural", choices=["natural", "reference"])
        p.add_argument("--cast-mode", default="strict", choices=["strict", "coerce"])
        p.add_argument("--master", default=None, help="Spark master (default: the session's)")
        p.add_argument("--shuffle-partitions", type=int, default=None,
                       help="with --master: 20000 on a cluster, 8 on one machine by default")
    run.add_argument("--write-mode", default="append", choices=["append", "overwrite"])
    run.add_argument("--on-error", default="skip", choices=["skip", "continue"])
    run.add_argument("--database", default=None,
                     help="also register refined tables as <database>.<table>")
    run.add_argument("--full-snapshot", action="store_true",
                     help="landing files re-deliver whole tables (merge shuffles keys only)")
    run.add_argument("--on-malformed", default="keep", choices=["keep", "reject"],
                     help="short and long landing rows: pad and cut, or write to <lake>/_rejects")
    watch.add_argument("--every", default=None, help='processing-time trigger, e.g. "20 minutes"')
    watch.add_argument("--checkpoint", default=None, help="stream checkpoints (default: below lake)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from strata.plans import jobs
    from strata.session import build_session

    spark = (build_session(args.master, args.shuffle_partitions) if args.master
             else SparkSession.builder.getOrCreate())
    specs = tuple(S.SPECS[t] for t in args.tables.split(","))
    if args.cmd == "run":
        result = jobs.run_all(spark, args.landing, args.lake, specs=specs, key=args.key,
                              cast_mode=args.cast_mode, write_mode=args.write_mode,
                              on_error=args.on_error, full_snapshot=args.full_snapshot,
                              database=args.database, on_malformed=args.on_malformed)
        result.log.select("layer", "table_name", "status", "rows", "message") \
            .show(len(specs) * 3, truncate=80)
        failed = result.log.filter("status != 'ok'").count()
        return 1 if failed else 0
    from strata.streaming.incremental import watch_tables

    out = watch_tables(spark, args.landing, args.lake, specs,
                       args.checkpoint or f"{args.lake.rstrip('/')}/_streams",
                       processing_time=args.every, key=args.key, cast_mode=args.cast_mode)
    if args.every:
        _, errors = out
        for name, err in errors.items():
            print(f"{name}: {err}", file=sys.stderr)
        spark.streams.awaitAnyTermination()
        return 1
    for name, err in out.items():
        print(f"{name}: {err}", file=sys.stderr)
    return 1 if out else 0


if __name__ == "__main__":
    sys.exit(main())
