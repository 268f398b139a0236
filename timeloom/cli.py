"""python -m timeloom.cli replay|gold|query|export --root DIR …"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from timeloom.plans import gold
from timeloom.sources import store


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="timeloom")
    out.add_argument("--root", default=os.environ.get("TIMELOOM_ROOT", "warehouse"), help="folder of the tables; argument, then TIMELOOM_ROOT, then ./warehouse")
    commands = out.add_subparsers(dest="command", required=True)
    commands.add_parser("replay", help="Silver again from all of Bronze")
    commands.add_parser("gold", help="all Gold tables")
    query = commands.add_parser("query", help="SQL over a table, shown")
    query.add_argument("table")
    query.add_argument("sql", help="names the table as t")
    export = commands.add_parser("export", help="a table as CSV")
    export.add_argument("table")
    export.add_argument("to")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("timeloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    house = store.Warehouse(spark, os.path.abspath(args.root) if "://" not in args.root else args.root)
    if args.command == "replay":
        store.replay(house)
    elif args.command == "gold":
        run = gold.build_gold(spark, house)
        print(json.dumps({"verdict": run.verdict, "seconds": run.seconds, "failed": run.failed}))
        return int(bool(run.failed))
    elif args.command == "query":
        house.read(args.table).createOrReplaceTempView("t")
        house.query(args.sql, "cli").show(truncate=False)
    else:
        house.export_csv(house.read(args.table), args.to)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
