"""Command line: ``spark-submit -m ledgerlake <job> --base <folder> --months 202501 202502``.

Jobs: ``bronze`` (raw monthly files -> bronze; ``--spread`` tasks parse compressed files), ``silver``
(bronze -> silver + quarantine, reconciled), ``labels`` (a finished label file, or code lists, lexicon
sheets and complements -> label table), ``gold`` (marts + checks; with ``--months``
only those months are rebuilt). The Spark session is the one the cluster provides.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ledgerlake.contract import CLAIMS
from ledgerlake.plans import bronze, gold, silver
from ledgerlake.plans.labels import write_labels
from ledgerlake.plans.layout import Lakehouse
from ledgerlake.session import configure
from ledgerlake.sinks.partitions import overwrite_table
from ledgerlake.sources.claims_labels import CLAIMS_CODE_COLUMNS, claims_sources
from ledgerlake.sources.labels import read_complements, read_dimension
from ledgerlake.sources.monthly_files import DEFAULT_TEMPLATE


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerlake")
    parser.add_argument("job", choices=["bronze", "silver", "labels", "gold"])
    parser.add_argument("--base", required=True, help="folder holding raw/, bronze/, silver/ ...")
    parser.add_argument("--months", nargs="*", default=[], help="YYYYMM months")
    parser.add_argument("--raw-dir", help="raw files folder (default <base>/raw)")
    parser.add_argument("--template", default=DEFAULT_TEMPLATE)
    parser.add_argument("--spread", type=int, help="tasks that parse compressed files (bronze job)")
    parser.add_argument("--label-file", help="finished label file (labels job)")
    parser.add_argument("--code-lists", help="folder of the code lists (labels job)")
    parser.add_argument("--lexicon", help="folder of the lexicon sheets (labels job)")
    parser.add_argument("--complements", help="complement file (labels job)")
    parser.add_argument("--warn-only", action="store_true", help="gold: do not fail on errors")
    args = parser.parse_args(argv)
    if args.job in ("bronze", "silver") and not args.months:
        parser.error(f"{args.job} needs --months")
    sources = (args.code_lists, args.lexicon, args.complements)
    if args.job == "labels" and bool(args.label_file) == all(sources):
        parser.error("labels needs either --label-file or --code-lists, --lexicon and --complements")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = configure(spark or SparkSession.builder.appName(f"ledgerlake-{args.job}").getOrCreate())
    house = Lakehouse(args.base.rstrip("/"), CLAIMS)
    if args.job == "bronze":
        rows = bronze.ingest_months(
            spark, args.raw_dir or house.raw_dir, house.bronze, args.months, template=args.template,
            spread=args.spread,
        )
        print(" ".join(f"{m}={n}" for m, n in rows.items()))
    elif args.job == "silver":
        result = silver.build_silver(
            spark, house.bronze, house.silver, house.quarantine, args.months, CLAIMS, codes=house.codes
        )
        print(
            f"bronze={result.rows['bronze']} silver={result.rows['silver']} "
            f"quarantine={result.rows['quarantine']} amount={result.amounts['bronze']}"
        )
        for reason, n in result.reasons:
            print(f"  {reason}: {n}")
    elif args.job == "labels" and args.code_lists:
        rows, absent = write_labels(
            claims_sources(spark, args.code_lists, args.lexicon),
            read_complements(spark, args.complements), CLAIMS_CODE_COLUMNS, house.labels,
        )
        print(f"labels={rows}")
        for column in absent:
            print(f"  no label for any code of {column}")
    elif args.job == "labels":
        print(f"labels={overwrite_table(read_dimension(spark, args.label_file), house.labels)}")
    else:
        results = gold.build_gold(
            spark, house.silver, house.labels, house.gold(gold.SERVICE_MART),
            house.gold(gold.REGION_MART), CLAIMS, fail_on_error=not args.warn_only,
            months=args.months or None, codes=house.codes,
        )
        for r in results:
            print(f"{r.severity:5s} {r.name}: {r.rows}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
