"""spark-submit jobs/preprocess_data.py --raw RAW --out OUT [--dataset all]"""

import argparse
import logging

from basketry.plans.ingest import DATASETS, run
from basketry.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(description="Raw files to Parquet tables")
    parser.add_argument("--raw", required=True, help="folder of the raw files")
    parser.add_argument("--out", required=True, help="folder of the tables")
    parser.add_argument("--dataset", choices=DATASETS, default="all")
    parser.add_argument("--shuffle-partitions", type=int, help="starting shuffle width")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session("preprocess", shuffle_partitions=args.shuffle_partitions)
    run(spark, args.raw, args.out, args.dataset)


if __name__ == "__main__":
    main()
