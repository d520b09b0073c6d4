"""Feed archives of any size, read entry by entry: one large file is the work of many tasks.

Spark's text source cuts a file at any separator and deals its blocks over tasks. The end tag of an entry is such
a separator, so a record ends with an entry, and no file is ever held as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions import chain
from feedloom.operators.items import item_normalize
from feedloom.sources.feeds import _fields, _parse, _pieces, _plain_sections, _unprefixed, feed_scan, read_bodies

#: Files above this are read by records, others as a whole.
LARGE = 32 << 20
#: Longest record; what stands between two end tags beyond it is no entry a parser could take.
RECORD = 256 << 20
#: Bytes of a tag that may stand before the outermost one.
_HEAD = 1 << 16
_LINE = "mapreduce.input.linerecordreader.line.maxlength"
# Where an entry begins, with or without a prefix.
_OPENED = r"<(?:[A-Za-z_][\w.-]*:)?(?:item|entry)[\s>]"
# Declarations, comments and instructions come before the outermost tag.
_FIRST = r"\A[\s\x{FEFF}]*<(?:([A-Za-z_][\w.-]*):)?([A-Za-z][\w.-]*)"


def feed_files(spark: SparkSession, root: str, stream: bool = False, per_batch: int = 1000) -> DataFrame:
    """path, length of every landed file; contents are not opened. As a stream, ``per_batch`` files at a time."""
    if not stream:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_batch)
    return reader.load(root).select("path", "length")


def end_tags(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by the end tag of their entries, told by the outermost tag: ``feed`` holds entries under its own prefix, anything else items.

    One job for all files, of which only first blocks are looked at; one row of each file comes to the driver.
    """
    raw = spark.read.option("lineSep", ">").option(_LINE, _HEAD).text(list(paths))
    heads = raw.filter(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("id"), F.substring("value", 1, 4096).alias("tag"))
    named = heads.filter(F.col("tag").rlike(_FIRST)).groupBy("path").agg(F.min_by("tag", "id").alias("tag"))
    prefix, name = (F.regexp_extract("tag", _FIRST, n) for n in (1, 2))
    entry = F.concat(F.lit("</"), F.when(prefix == "", "").otherwise(F.concat(prefix, F.lit(":"))), F.lit("entry>"))
    found = {_bare(unquote(r["path"])): r["end"] for r in named.select("path", F.when(name == "feed", entry).otherwise("</item>").alias("end")).collect()}
    by_tag: dict[str, list[str]] = {}
    for path in paths:
        by_tag.setdefault(found.get(_bare(path), "</item>"), []).append(path)
    return by_tag


def _bare(path: str) -> str:
    """A path without its scheme, which a caller may leave out."""
    return re.sub(r"\A[A-Za-z][\w+.-]*:/*", "/", path)


def end_tag(spark: SparkSession, path: str) -> str:
    """End tag of the entries of one file."""
    return next(iter(end_tags(spark, [path])))


def records(spark: SparkSession, paths: Sequence[str], tag: str, root: str) -> DataFrame:
    """feed_url, feed_rank, piece, entry_pos: the complete entries of files whose entries end with ``tag``, numbered in document order.

    Entries are counted block by block in a first pass that sends on one row for each block; the second pass adds what
    lies before a block to an entry's own place in it. Blocks are told by where they start, so it does not matter which task reads which.
    """
    reader = spark.read.format("text").schema("value STRING, feed_rank INT, feed_url STRING").option("basePath", root)
    raw = reader.option("lineSep", tag).option(_LINE, RECORD).load(list(paths))
    block = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pieces = chain(F.concat("value", F.lit(tag)), _plain_sections, _unprefixed, _pieces)
    # Behind a generator, so that the test for an entry does not cut it out a second time.
    complete = raw.select("feed_url", "feed_rank", block.alias("block"), F.explode(F.slice(pieces, 1, 1)).alias("piece"))
    # Numbered behind the filter: within a block, entries count up one by one.
    numbered = complete.withColumn("id", F.monotonically_increasing_id())
    counts = numbered.groupBy("block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    of_file = Window.partitionBy("block.file")
    before = of_file.orderBy("block.start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(of_file).alias("total"))
    known = offsets.join(_cut_off(raw, tag).withColumnRenamed("file", "_file"), F.col("block.file") == F.col("_file"), "left")
    placed = numbered.join(known.drop("_file"), "block").withColumn("entry_pos", F.col("before") + F.col("id") - F.col("first"))
    closed = ~(F.coalesce("cut", F.lit(False)) & (F.col("entry_pos") == F.col("total") - 1))
    return placed.filter(closed).select("feed_url", "feed_rank", "piece", "entry_pos")


def _cut_off(raw: DataFrame, tag: str) -> DataFrame:
    """file, cut: files that break off within an entry. The reader does not tell whether a last record was ended; the sum of the bytes does."""
    opened = F.col("value").rlike(_OPENED)
    rows = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.octet_length("value").cast("long").alias("bytes"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), opened.alias("opened")).alias("last"))
    length = len(tag.encode())
    files = rows.groupBy("file", "size").agg((F.sum("bytes") + F.count(F.lit(1)) * length).alias("bytes"), F.max("last").alias("last"))
    return files.select("file", (F.col("last.opened") & (F.col("bytes") - length == F.col("size"))).alias("cut"))


def record_items(spark: SparkSession, paths: Sequence[str], root: str) -> DataFrame:
    """Items of large feed files, as ``feed_scan`` gives them; RSS and Atom files are united by the names of their fields."""
    out = None
    for tag, of_tag in end_tags(spark, paths).items():
        parsed = records(spark, of_tag, tag, root).select(
            F.col("feed_url").alias("source_feed"), "feed_rank", F.col("entry_pos").cast("int").alias("entry_pos"), _once(_parse(F.col("piece"))))
        items = item_normalize(_fields(parsed))
        out = items if out is None else out.unionByName(items)
    return out


def _once(entry: Column) -> Column:
    """The parsed entry behind a generator, so that no field parses it again."""
    return F.explode(F.array(entry)).alias("e")


def feed_items(spark: SparkSession, root: str, paths: Sequence[str] | None = None, large: int = LARGE) -> DataFrame:
    """Items of all landed feed files: small ones as a whole, those above ``large`` bytes record by record, with the same result.

    Only the paths of large files come to the driver, and a head of each is read to tell its kind. An end tag that stands as
    text in a CDATA section ends the entry in a large file.
    """
    files = feed_files(spark, root) if paths is None else _listed(spark, paths)
    big = [row["path"] for row in files.filter(F.col("length") > large).select("path").collect()]
    if paths is None and not big:
        return feed_scan(read_bodies(spark, root))
    small = _bodies(spark, root, [row["path"] for row in files.filter(F.col("length") <= large).select("path").collect()])
    parts = ([feed_scan(small)] if small is not None else []) + ([record_items(spark, big, root)] if big else [])
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length")


def _bodies(spark: SparkSession, root: str, paths: list[str]) -> DataFrame | None:
    if not paths:
        return None
    reader = spark.read.format("text").schema("value STRING, feed_rank INT, feed_url STRING").option("wholetext", True).option("basePath", root)
    return reader.load(paths).select("feed_url", "feed_rank", F.col("value").alias("body"))


def arriving_items(spark: SparkSession, root: str, target: str, large: int = LARGE) -> Callable[[DataFrame, int], None]:
    """Batch writer for a stream of ``feed_files``: items of the files of each micro-batch go to a folder of its own.

    The stream carries names and sizes only; a replayed micro-batch replaces its folder.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.select("path").collect()]
        if paths:
            feed_items(batch.sparkSession, root, paths, large).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return commit
