"""Print the physical plans of the key operators over stored warehouse tables.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
Lands the stand-in sources, runs the daily ETL once, then explains each
operator as the ETL runs it (reading stored Parquet tables).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from aeris import adapters as A  # noqa: E402
from aeris import operators as op  # noqa: E402
from aeris.operators.limits import limit_rows  # noqa: E402
from aeris.plans.etl import run_daily_etl  # noqa: E402
from aeris.plans.load import Warehouse  # noqa: E402
from aeris.session import local_session, scratch_path  # noqa: E402


def _explain(df, mode: str) -> str:
    import re

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return re.sub(r"#\d+L?", "", buf.getvalue())


def physical(df) -> str:
    """The operator tree (scan lines shortened), plus each scan's pushed and
    partition filters and read schema from the formatted plan."""
    import re

    tree = [re.sub(r"(FileScan parquet \[[^\]]*\]).*", r"\1 …", line)
            for line in _explain(df, "simple").strip().splitlines()]
    details = _explain(df, "formatted").partition("\n\n\n")[2]
    keep, scan = [], None
    for line in details.splitlines():
        if re.match(r"^\(\d+\) Scan ", line):
            scan = line.strip()
        elif scan and line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema")):
            keep.append(f"{scan}: {line}")
        elif not line.strip():
            scan = None
    return "\n".join(tree) + ("\n\n" + "\n".join(keep) if keep else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    landing = A.land_all(spark, sf, scratch_path(spark, "plans-landing"))
    wh = Warehouse(spark, "path", root=scratch_path(spark, "plans-wh"))
    run_daily_etl(spark, landing, wh, run_date="2024-02-01", window=("2024-01-01", "2024-02-01"),
                  country_id=22, since="2001-01-01", cell_size=0.5)
    raw = wh.read("raw_measurements")
    cases = [
        ("FIL1 active locations (pushed filters)",
         op.active_locations(wh.read("world_locations"), 22, "2001-01-01")),
        ("J1 sensors of the selected stations (size-checked broadcast)",
         op.country_sensors(wh.read("world_sensors"), wh.read("france_locations"))),
        ("J3 measurements of the selected sensors (semi join)",
         op.measurements_of_sensors(raw, wh.read("france_sensors"))),
        ("AGG1 daily statistics of one day of the raw fact (partition pruning, partial aggregation)",
         op.daily_stats_of_raw_fact(op.measurements_between(raw, "2024-01-10", "2024-01-11", column="day"))),
        ("AGG2 profile (two-phase distinct count)",
         op.parameter_profile(wh.read("agg_measurements"), wh.read("world_sensors"))),
        ("J4 stations to communes (grid lookup, no cross join)",
         op.assign_communes(op.location_points(wh.read("france_locations")),
                            spark.read.parquet(landing.communes), cell_size=0.5)),
        ("J5 star read path",
         op.enrich_measurements(wh.read("agg_measurements"), wh.read("world_sensors"),
                                locations=wh.read("world_locations"), parameters=wh.read("parameters"))),
        ("WIN1 / TXT limits rows (bucketed fill-forward, title join)",
         limit_rows(A.limit_cells(spark, sf))),
        ("J6 sensors per sensor id occurring twice", op.duplicate_keys(wh.read("world_sensors"), "sensor_id")),
        ("fact read for one sensor (row-group statistics)",
         wh.read("agg_measurements").where(F.col("sensor_id") == 1)),
    ]
    print("# Physical plans\n")
    print(f"Generated by `python tools/show_plans.py {sf}` over the tables the daily ETL stored "
          "(Parquet, `day`-partitioned facts). AQE re-plans at runtime; these are the initial plans.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{physical(df)}\n```\n")


if __name__ == "__main__":
    main()
