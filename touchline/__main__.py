"""python -m touchline list | show QUERY --tables DIR | run QUERY --tables DIR --out URI"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import catalog


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("touchline")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    for name, told in (("show", "print the plan and the first rows"), ("run", "write a query's result as Parquet")):
        p = commands.add_parser(name, help=told)
        p.add_argument("query", choices=sorted(catalog.queries()))
        p.add_argument("--tables", required=True, help="the folder of the Parquet tables")
        if name == "run":
            p.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join(catalog.queries()))
        return 0
    found = catalog.queries()[args.query](SparkSession.builder.appName("touchline").getOrCreate(), args.tables)
    if args.command == "show":
        found.explain("formatted")
        found.show(20, truncate=False)
    else:
        found.write.mode("errorifexists").parquet(args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
