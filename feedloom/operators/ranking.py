"""Top-k per key without gathering a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALT = "_salt"
SALTS = 64


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", salts: int = SALTS
) -> DataFrame:
    """The first ``k`` rows of every key in ``order``, which must be a total order.

    Spark cuts each map task to ``k`` rows per key before the shuffle. With many
    tasks and few keys that still leaves ``tasks * k`` rows for one reducer, so
    a first round ranks within (key, salt). The salt is the map task's number:
    a task keeps no more than ``k`` rows of a key, and the result does not
    depend on it. Use ``salts=1`` when keys are mostly distinct.
    """
    if salts > 1:
        salted = df.withColumn(_SALT, F.spark_partition_id() % salts)
        df = _first_k(salted, [*keys, _SALT], order, k, rank).drop(rank, _SALT)
    return _first_k(df, keys, order, k, rank)


def _first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def first_per(df: DataFrame, key: Column, order: Sequence[Column], identity: Sequence[str | Column]) -> DataFrame:
    """First row per key. Rows whose key is NULL are all kept.

    A NULL key is replaced by the row's ``identity`` (columns no two rows
    share), so those rows spread over all tasks instead of meeting in one, and
    a recomputed task sends each row to the same place again.
    """
    alone = F.concat(F.lit("\x00"), F.to_json(F.struct(*identity)))
    keyed = df.withColumn("_key", F.coalesce(key, alone))
    return top_k(keyed, ["_key"], order, 1, rank="_first", salts=1).drop("_key", "_first")


def group_limit_bound(df: DataFrame) -> int:
    """Largest k for which Spark cuts groups before the shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def rank_by_slot(
    df: DataFrame, key: str, part: Column, slot: Column, order: Sequence[Column], limit: Column, rank: str = "rank"
) -> DataFrame:
    """Exact rank within a key for any limit, however large.

    Rows are counted per (key, part, slot), where ``part`` and ``slot`` ascend
    along ``order``. A running sum of those few counts tells where each slot
    starts; slots that start past the limit are dropped unread, and only rows
    of one slot are ranked against each other.
    """
    slotted = df.withColumn("_part", part).withColumn("_slot", slot)
    along = (
        Window.partitionBy(key).orderBy("_part", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        slotted.groupBy(key, "_part", "_slot")
        .agg(F.count(F.lit(1)).alias("_n"), F.any_value(limit).alias("_limit"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(along), F.lit(0)))
        .filter(F.col("_start") < F.col("_limit"))
        .select(key, "_part", "_slot", "_start", "_limit")
    )
    within = Window.partitionBy(key, "_part", "_slot").orderBy(*order)
    return (
        slotted.join(starts, [key, "_part", "_slot"])
        .withColumn(rank, (F.col("_start") + F.row_number().over(within)).cast("int"))
        .filter(F.col(rank) <= F.col("_limit"))
        .drop("_part", "_slot", "_start", "_limit")
    )
