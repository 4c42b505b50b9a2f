"""Command line for the two jobs:

    python -m tidemark macro --extracts /data/landed/macro --lake /data/lake
    spark-submit --py-files tidemark.zip tidemark/cli.py equities --extracts ... --lake ...

The session comes from the submitter's configuration (master, memory, checkpoint folder).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("job", choices=["macro", "equities"])
    ap.add_argument("--extracts", required=True, help="folder of landed extract files")
    ap.add_argument("--lake", required=True, help="folder of the stored raw/silver/gold or fact tables")
    ap.add_argument("--lookback", default="last", choices=["none", "last"], help="macro: LAG seeding (Q8)")
    ap.add_argument("--scope", default="series", choices=["global", "series"], help="macro: watermark scope (Q6)")
    ap.add_argument("--start", help="macro: backfill the days after this one, whatever is stored already (yyyy-mm-dd)")
    ap.add_argument("--end", help="macro: last day of the backfill (default: a fixed span per kind)")
    ap.add_argument("--db", help="equities: database of the fact tables, swapped in whole (default: folders under --lake); "
                                 "macro: database of the raw tables, created if missing")
    args = ap.parse_args(argv)
    if args.end and not args.start:
        ap.error("--end needs --start")
    spark = SparkSession.builder.appName(f"tidemark-{args.job}").getOrCreate()
    from .session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    if args.job == "macro":
        from .plans.macro import run_job_from_extracts
        out = run_job_from_extracts(spark, args.extracts, args.lake, lookback=args.lookback, scope=args.scope,
                                    start=args.start, end=args.end, raw_db=args.db)
    else:
        from .plans.equities import run_job_from_extracts
        out = run_job_from_extracts(spark, args.extracts, args.lake, db=args.db)
    print(json.dumps({k: (int(v) if isinstance(v, bool) else v) for k, v in out.items()}))
    return out


if __name__ == "__main__":
    main()
