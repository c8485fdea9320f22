"""``spark-submit``-able run: ``python -m tallywork {run,ingest,check,build,test} OUT [SRC ...]``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tallywork.plans import pipeline


def main() -> int:
    """Run one step; 1 if a declared test fails, so that a scheduled chain stops there."""
    parser = argparse.ArgumentParser(prog="tallywork", description=__doc__)
    parser.add_argument("step", choices=["run", "ingest", "check", "build", "test"])
    parser.add_argument("out", help="folder of the stored tables")
    parser.add_argument("src", nargs="*", help="CSV files or folders (run, ingest)")
    parser.add_argument("--records", choices=["auto", "line", "block"], default="auto", help="how CSV records are found")
    parser.add_argument("--on-error", choices=["null", "fail"], default="null", help="text that is no number")
    args = parser.parse_args()
    if args.step in ("run", "ingest") and not args.src:
        parser.error(f"{args.step} needs at least one source")

    spark = SparkSession.builder.appName("tallywork").getOrCreate()
    if args.step == "run":
        shown = pipeline.run(spark, args.src, args.out, records=args.records, on_error=args.on_error)
        shown["issues"].show(truncate=False)
        return _passed(shown["tests"])
    elif args.step == "ingest":
        pipeline.ingest(spark, args.src, args.out, records=args.records)
    elif args.step == "check":
        pipeline.check(spark, args.out).show(truncate=False)
    elif args.step == "build":
        pipeline.build(spark, args.out, args.on_error)
    else:
        return _passed(pipeline.test(spark, args.out))
    return 0


def _passed(tests: DataFrame) -> int:
    tests.show(truncate=False)
    return 0 if tests.filter("should_error").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
