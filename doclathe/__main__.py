"""python -m doclathe QUERY FOLDER OUT: run a query over the tables of a folder and write its result as parquet; without arguments, list the queries."""

from __future__ import annotations

import sys

from doclathe.plans.queries import QUERIES


def main(args: list[str]) -> int:
    if len(args) != 3 or args[0] not in QUERIES:
        print(__doc__, *sorted(QUERIES), sep="\n")
        return 1 if args else 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(args[0]).getOrCreate()
    QUERIES[args[0]](spark, args[1]).write.mode("errorifexists").parquet(args[2])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
