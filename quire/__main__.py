"""Run the daily job from the command line.

    python -m quire --sf-dir /root/testdata/sf0.01 --out /shared/catalogue [--from-pages] [--corrected]

Stages one batch per entity (bronze-shaped views of the driver tables, or
records extracted from book / author / publisher pages rendered from them),
merges it into bronze, builds silver, validates and publishes gold. Prints
the validation summary; exits 1 when a suite blocks publishing.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from quire.operators.validate import ValidationFailed
from quire.plans import pages as P
from quire.plans import daily
from quire.session import build_session
from quire.sources import blocks
from quire.sources.bronze_views import bronze


def staged_batches(spark, sf_dir: str, from_pages: bool) -> dict:
    if not from_pages:
        return {e: bronze(spark, sf_dir, e) for e in daily.ENTITIES}
    return {
        "books": P.accepted_books(blocks.book_pages(spark, sf_dir)),
        "authors": P.author_records(blocks.author_pages(spark, sf_dir)).where(F.col("authorid").isNotNull()),
        "publishers": P.publisher_records(blocks.publisher_pages(spark, sf_dir)).where(F.col("books").isNotNull()),
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="quire")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True, help="output root (shared storage on a cluster)")
    ap.add_argument("--from-pages", action="store_true")
    ap.add_argument("--corrected", action="store_true")
    ap.add_argument("--master", default=None, help="only for local runs; spark-submit's master is kept")
    args = ap.parse_args(argv)
    spark = build_session(master=args.master, shuffle_partitions=8 if args.master else None)
    try:
        results = daily.run(spark, staged_batches(spark, args.sf_dir, args.from_pages), args.out, args.corrected)
        results.groupBy("suite").agg(F.count_if(~F.col("success")).alias("failed")).show()
        return 0
    except ValidationFailed as e:
        print(f"publishing blocked: {e}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
