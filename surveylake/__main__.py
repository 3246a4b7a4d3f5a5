"""`python -m surveylake DROPS LAKE`: refresh a lake from a folder of monthly archives."""

from __future__ import annotations

import argparse

from surveylake.contract import SILVER_SCHEMA
from surveylake.operators.periods import ALL_MONTHS, ALLOWED_MONTHS
from surveylake.operators.quality import render_report, silver_suite
from surveylake.plans.lake import refresh_lake
from surveylake.session import build_session
from surveylake.sources.catalog import ensure_database, register_published
from surveylake.sources.layers import read_silver


def main() -> None:
    parser = argparse.ArgumentParser(prog="surveylake", description="Refresh a survey lake from monthly archives.")
    parser.add_argument("drops", help="folder of *_MMYYYY.zip archives")
    parser.add_argument("lake", help="folder that holds the layers")
    parser.add_argument("--months", nargs="+", default=ALLOWED_MONTHS, help="two-digit months to read, or `all`")
    parser.add_argument("--years", nargs="+", help="years to read (default: any)")
    parser.add_argument("--delimiter", default=",")
    parser.add_argument("--unique", nargs="+", default=(), help="silver columns that no two rows should share")
    parser.add_argument("--database", help="register the gold tables in this database as gold_*")
    args = parser.parse_args()

    months = ALL_MONTHS if args.months == ["all"] else args.months

    spark = build_session()
    done = refresh_lake(spark, args.drops, args.lake, months, args.years, args.delimiter, unique=args.unique)
    print(f"landed: {done.landed}\nretracted: {done.retracted}\nbrought into silver: {done.silver}")
    if args.database:
        ensure_database(spark, args.database)
        print(f"registered: {register_published(spark, args.database, f'{args.lake}/gold', 'gold_')}")
    print(render_report(silver_suite(read_silver(spark, f"{args.lake}/silver", SILVER_SCHEMA))))


if __name__ == "__main__":
    main()
