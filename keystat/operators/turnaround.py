"""Mean turnaround of a job log: ``finish - arrival`` averaged over all jobs.

The scheduler program ends with this average after its (single-machine)
simulation; here it is computed over a job log table, in seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_turnaround(jobs: DataFrame) -> DataFrame:
    """One row: ``n_jobs``, the jobs with both times, and their ``mean_turnaround_seconds``."""
    seconds = F.timestamp_diff("MICROSECOND", F.col("arrival"), F.col("finish")) / 1e6
    return jobs.agg(F.count(seconds).alias("n_jobs"),
                    F.avg(seconds).alias("mean_turnaround_seconds"))
