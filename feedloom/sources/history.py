"""Addresses used in earlier digests, with a window that expires by itself."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.params import utc
from feedloom.schemas import HISTORY


def history_parse(documents: DataFrame, value: str = "value") -> DataFrame:
    """JSON objects ``{url: ISO time}`` to (url, ts); entries without a valid time are left out."""
    entries = documents.select(F.explode(F.from_json(value, "map<string,string>")).alias("url", "text"))
    return entries.select("url", F.try_to_timestamp("text").alias("ts")).filter("ts IS NOT NULL")


def history_load(spark: SparkSession, path: str) -> DataFrame:
    """Import a history file; a missing file is an empty history."""
    try:
        return history_parse(spark.read.text(path, wholetext=True))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)


def _valid(url: Column) -> Column:
    return url.isNotNull() & (url != "")


def _merged(history: DataFrame, used: DataFrame, now: dt.datetime) -> DataFrame:
    fresh = used.filter(_valid(F.col("url"))).select("url", F.lit(utc(now)).alias("ts"))
    return history.select("url", "ts").unionByName(fresh)


def history_upsert(history: DataFrame, used: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Set the time of every used url to ``now``, drop what is older than the window.

    Old rows go before the aggregation: a url whose latest time is inside the
    window keeps that time, any other loses all its rows.
    """
    cutoff = F.lit(utc(now) - dt.timedelta(days=days))
    return _merged(history, used, now).filter(F.col("ts") >= cutoff).groupBy("url").agg(F.max("ts").alias("ts"))


def history_counts(history: DataFrame, used: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """How many urls an upsert keeps and removes."""
    cutoff = F.lit(utc(now) - dt.timedelta(days=days))
    latest = _merged(history, used, now).groupBy("url").agg(F.max("ts").alias("ts"))
    return latest.agg(
        F.count_if(F.col("ts") >= cutoff).alias("kept"), F.count_if(F.col("ts") < cutoff).alias("removed")
    )


class HistoryLog:
    """History as an append-only table by day of use, for many urls.

    A run adds its own urls and rewrites nothing; days before the window are
    not opened, so they expire by themselves. A replayed append repeats rows,
    which no reader minds: what counts is whether a url was used, and when last.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")

    def read(self, now: dt.datetime, days: int = 7) -> DataFrame:
        """Uses inside the window, possibly several per url."""
        try:
            log = self._spark.read.schema(f"{HISTORY}, used_date DATE").parquet(self._root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], HISTORY)
        cutoff = utc(now) - dt.timedelta(days=days)
        return log.filter((F.col("used_date") >= F.lit(cutoff.date())) & (F.col("ts") >= F.lit(cutoff))).select("url", "ts")

    def upsert(self, used: DataFrame, now: dt.datetime, days: int = 7) -> None:
        moment = utc(now).astimezone(dt.timezone.utc)
        fresh = used.filter(_valid(F.col("url"))).select("url").distinct()
        fresh.select("url", F.lit(moment).alias("ts"), F.lit(moment.date()).alias("used_date")).write.mode("append").partitionBy(
            "used_date"
        ).parquet(self._root)


class HistoryStore:
    """History as numbered Parquet versions, one row per url.

    A version is written whole into its own folder and counts only once the
    commit log names it, so a reader never sees half of one and a failed run
    leaves the last one in force. One writer at a time.
    """

    _LOG = "version BIGINT, rows BIGINT"

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")

    def _version_path(self, version: int) -> str:
        return f"{self._root}/version={version}"

    def version(self) -> int:
        try:
            log = self._spark.read.schema(self._LOG).json(f"{self._root}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return log.agg(F.max("version")).first()[0] or 0

    def read(self, now: dt.datetime | None = None, days: int = 7) -> DataFrame:
        """The version in force; it was pruned when it was written."""
        version = self.version()
        if version == 0:
            return self._spark.createDataFrame([], HISTORY)
        return self._spark.read.schema(HISTORY).parquet(self._version_path(version))

    def write(self, history: DataFrame) -> int:
        """Write the next version, then name it in the log. Returns its number."""
        version = self.version() + 1
        path = self._version_path(version)
        history.select("url", "ts").write.mode("overwrite").parquet(path)
        commit = self._spark.read.schema(HISTORY).parquet(path).agg(
            F.lit(version).cast("bigint").alias("version"), F.count(F.lit(1)).alias("rows")
        )
        commit.coalesce(1).write.mode("append").json(f"{self._root}/commits")
        return version

    def upsert(self, used: DataFrame, now: dt.datetime, days: int = 7) -> int:
        return self.write(history_upsert(self.read(), used, now, days))
