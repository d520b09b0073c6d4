"""What the operators share: reading, identity, words, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[ \t-\r]"
NOT_BLANK = r"[^ \t-\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text itself, empty for NULL."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def worded_lines(text: Column) -> Column:
    """Lines (split at line feeds) that hold a word, as they stand."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))


def match(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """Join on equality that also holds between NULLs; the key columns of ``right`` are not returned."""
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(other, on, how).drop(*[f"_right_{c}" for c in columns])
