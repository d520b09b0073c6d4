"""Project context and list settings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import list_from_text, or_default

# Shown to the model until the reader describes their own projects.
PLACEHOLDER_CONTEXT = "# Projects\n\nDescribe your projects here: goal, technology, stage."


def context_load(spark: SparkSession, path: str, default: str = PLACEHOLDER_CONTEXT) -> DataFrame:
    """The whole context file as one row; a placeholder when it is missing."""
    try:
        return context_parse(spark.read.text(path, wholetext=True), default)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(F.lit(default).alias("context"))


def context_parse(documents: DataFrame, default: str = PLACEHOLDER_CONTEXT) -> DataFrame:
    """Documents with their ``value`` as ``context``; other columns stay."""
    others = [c for c in documents.columns if c != "value"]
    return documents.select(*others, or_default(F.col("value"), F.lit(default)).alias("context"))


def config_lists(settings: DataFrame, value: str = "value") -> DataFrame:
    """One row per entry of a comma-separated setting, in order."""
    others = [c for c in settings.columns if c != value]
    return settings.select(*others, F.posexplode(list_from_text(F.col(value))).alias("pos", "entry"))
