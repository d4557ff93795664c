"""spark-submit jobs/report.py --tables OUT --out REPORT [--part orders|sales|catalogue]

Writes every answer whole, as Parquet under REPORT, and prints its first rows.
"""

import argparse
import re

from basketry.plans.report import REPORTS
from basketry.session import build_session
from basketry.sources.catalog import Catalog
from basketry.sources.sink import write_table


def main() -> None:
    parser = argparse.ArgumentParser(description="Print the exploratory report")
    parser.add_argument("--tables", required=True, help="folder of the tables")
    parser.add_argument("--out", help="folder of the answers; none: only print")
    parser.add_argument("--part", choices=sorted(REPORTS), action="append")
    parser.add_argument("--rows", type=int, default=40, help="rows shown per answer")
    parser.add_argument("--shuffle-partitions", type=int, help="starting shuffle width")
    args = parser.parse_args()
    spark = build_session("report", shuffle_partitions=args.shuffle_partitions)
    tables = Catalog(spark, args.tables)
    for part in args.part or REPORTS:
        for title, answer in REPORTS[part](tables).items():
            print(f"== {title}")
            if args.out:
                name = re.sub(r"\W+", "_", title.lower()).strip("_")
                write_table(answer, f"{args.out.rstrip('/')}/{part}/{name}")
            answer.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
