"""Command line: python -m aislewise INPUT... --output FOLDER."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from aislewise.plans import follow, run
from aislewise.session import build_session
from aislewise.sinks import preview


def main() -> None:
    parser = argparse.ArgumentParser(prog="aislewise", description=__doc__)
    parser.add_argument("inputs", nargs="+", help="CSV files or folders")
    parser.add_argument("--output", required=True, help="folder for validated events and results")
    parser.add_argument("--pattern", help="file name pattern within folders, such as 2019-*.csv")
    parser.add_argument("--sample", action="store_true", help="first two blocks only")
    parser.add_argument("--compact", action="store_true", help="shuffle to even out file sizes")
    parser.add_argument("--pack", action="store_true", help="pack event types in many small files")
    parser.add_argument("--rejects", action="store_true", help="store the malformed lines as well")
    parser.add_argument("--multiline", action="store_true", help="quoted fields may hold line breaks")
    parser.add_argument("--follow", action="store_true", help="read files only that are new since the last run")
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    args = parser.parse_args()

    spark = build_session(master=args.master)
    try:
        if args.follow:
            paths = follow(spark, args.inputs, args.output, args.pattern, args.multiline)
            done = spark.read.parquet(paths["sync_outcome"]).first()
            print(
                f"files added {done.files_added}, removed {done.files_removed}, kept {done.files_kept}; "
                f"lines read {done.lines_read}, rejected {done.lines_rejected}, "
                f"rows written {done.rows_written}"
            )
        else:
            paths = run(
                spark, args.inputs, args.output, args.pattern, args.sample, args.compact, args.rejects,
                args.multiline, args.pack,
            )
            outcome = spark.read.parquet(paths["ingest_outcome"]).first()
            if outcome.skipped:
                print("ingest skipped: the output holds these inputs already")
            else:
                print(
                    f"lines read {outcome.lines_read}, rejected {outcome.lines_rejected}, "
                    f"rows written {outcome.rows_written}"
                )
        previews = {
            "revenue_by_category": [F.desc("total_revenue"), F.col("top_category")],
            "top_brands": [F.desc("total_revenue"), F.col("brand")],
            "conversion_funnel": [F.desc("view"), F.col("top_category")],
            "session_sample": [F.col("user_session")],
        }
        for name, order in previews.items():
            if name not in paths:
                continue
            print(name)
            preview(spark, paths[name], *order).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
