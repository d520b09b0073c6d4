"""Tutorial topics in rotation over the run calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topic_rotation(runs: DataFrame, topics: Sequence[str], profile: Sequence[str] = ("profile",)) -> DataFrame:
    """Topic of every run: each profile goes through the list, run by run.

    Runs are reduced to (profile, run_date) first, so what is numbered within a
    profile is days.
    """
    days = runs.select(*profile, "run_date").distinct()
    number = F.row_number().over(Window.partitionBy(*profile).orderBy("run_date")) - 1
    if not topics:
        return days.withColumn("topic", F.lit(None).cast("string"))
    listed = F.array(*[F.lit(t) for t in topics])
    return days.withColumn("topic", F.get(listed, F.pmod(number, F.lit(len(topics)))))
