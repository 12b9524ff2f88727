"""Mean turnaround of a job log (arrival and finish time per job).

    python -m keystat.plans.turnaround JOBS [--format parquet|csv] [--header]

``JOBS`` holds ``job_id, arrival, finish`` (timestamps); the result is the
number of jobs and the mean of ``finish - arrival`` in days, printed as one
line.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from keystat import schemas
from keystat.operators.turnaround import mean_turnaround
from keystat.session import get_session


def read_jobs(spark: SparkSession, path: str, fmt: str = "parquet", header: bool = False) -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schemas.JOBS).option("header", header).csv(path)
    return spark.read.parquet(path).select("job_id", "arrival", "finish")


def run(spark: SparkSession, path: str, fmt: str = "parquet", header: bool = False) -> dict:
    return mean_turnaround(read_jobs(spark, path, fmt, header)).first().asDict()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("jobs")
    ap.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    ap.add_argument("--header", action="store_true")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = get_session(args.master, "keystat-turnaround")
    r = run(spark, args.jobs, args.format, args.header)
    print(f">> jobs: {r['n_jobs']}  mean turnaround (seconds): {r['mean_turnaround_seconds']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
