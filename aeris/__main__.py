"""Run the daily ETL: ``python -m aeris --landing DIR --warehouse DIR --run-date YYYY-MM-DD``.

The landing folder holds ``parameters/ countries/ providers/ locations/
measurements/`` page folders (and optionally a ``communes/`` Parquet table);
the warehouse is a folder of Parquet tables (``--warehouse``) or a catalog
database (``--database``). Prints one line per step (action, seconds) and
exits non-zero when a step fails, instead of reporting success regardless.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from aeris.plans.etl import Landing, run_daily_etl
from aeris.plans.load import Warehouse
from aeris.session import cluster_conf, ensure_checkpoint_dir
from aeris.sources.landed import LAYOUTS


def landing_from_root(root: str, layout: str = "auto") -> Landing:
    root = root.rstrip("/")
    local = root[len("file:"):] if root.startswith("file:") else root
    communes = f"{root}/communes" if "://" in root or os.path.isdir(f"{local}/communes") else None
    return Landing(parameters=f"{root}/parameters", countries=f"{root}/countries", providers=f"{root}/providers",
                   locations=f"{root}/locations", measurements=f"{root}/measurements", communes=communes, layout=layout)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="aeris", description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--warehouse", help="root folder of Parquet tables")
    where.add_argument("--database", help="Spark catalog database")
    ap.add_argument("--run-date", required=True)
    ap.add_argument("--start", help="first local day to load (default: the day before --run-date)")
    ap.add_argument("--end", help="day after the last local day to load (default: --run-date)")
    ap.add_argument("--country-id", type=int, default=22)
    ap.add_argument("--since", default="2025-01-01")
    ap.add_argument("--cell-size", type=float, default=0.05)
    ap.add_argument("--refresh-dimensions", action="store_true")
    ap.add_argument("--layout", choices=LAYOUTS, default="auto", help="how landed pages lie in files")
    ap.add_argument("--fact-mode", choices=("replace", "merge", "append"), default="replace")
    args = ap.parse_args(argv)
    if bool(args.start) != bool(args.end):
        ap.error("--start and --end go together")

    if spark is None:
        builder = SparkSession.builder.appName("aeris-daily")
        spark = builder.getOrCreate()
        # existence probes of absent tables are expected; keep their warnings out of the log
        spark.sparkContext.setLogLevel("ERROR")
        explicit = spark.sparkContext.getConf()
        for key, value in cluster_conf().items():  # fill only what the cluster config left unset
            if not explicit.contains(key):
                spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    wh = (Warehouse(spark, "path", root=args.warehouse) if args.warehouse
          else Warehouse(spark, "catalog", database=args.database))
    window = (args.start, args.end) if args.start else None
    results = run_daily_etl(spark, landing_from_root(args.landing, args.layout), wh, run_date=args.run_date, window=window,
                            country_id=args.country_id, since=args.since, cell_size=args.cell_size,
                            refresh_dimensions=args.refresh_dimensions, fact_mode=args.fact_mode)
    for r in results.values():
        print(f"{r.name:24s} {r.action:10s} {r.seconds:8.2f}s")
    return 0


if __name__ == "__main__":
    sys.exit(main())
