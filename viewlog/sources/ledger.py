"""Input ledger: what each source file held at the last run, and what has changed since.

A streaming file source looks at a file once. A file that is rewritten,
shortened or removed afterwards goes unnoticed; the ledger notices. Per file it
holds length, time, number of lines and a digest of the lines (sum and XOR of
their 64-bit hashes, which combine in any order). A run compares the listing
with the ledger first and reads the lines of those files only whose length or
time differs, so an unchanged folder costs its listing. Files without a byte do not count,
as Spark's readers pass them over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.sources.sinks import path_exists, publish
from viewlog.sources.text import LOG_GLOB

LEDGER = "file string, length long, modified timestamp, lines long, digest_sum decimal(38,0), digest_xor long"
CONTENT = ["lines", "digest_sum", "digest_xor"]


def line_digests(lines: DataFrame, file: Column, col: str = "value") -> DataFrame:
    """``file, lines, digest_sum, digest_xor`` of text lines; combines map-side, so a huge file is read by many tasks."""
    h = F.xxhash64(F.col(col))
    return lines.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest_sum"), F.bit_xor(h).alias("digest_xor"))


def listing(spark: SparkSession, path: str, glob: str = LOG_GLOB) -> DataFrame:
    """``file, path, length, modified`` of the files that a run would read; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "length", F.col("modificationTime").alias("modified")))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger at ``ledger``; empty if there is none."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def current_ledger(spark: SparkSession, path: str, last: DataFrame, glob: str = LOG_GLOB) -> DataFrame:
    """The ledger of the files now: entries of files with the length and time of ``last`` are taken over, others are read."""
    now, known = listing(spark, path, glob), last.withColumnsRenamed({"length": "_length", "modified": "_modified"})
    entries = now.join(known, "file", "left").withColumn(
        "same", F.coalesce((F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified")), F.lit(False)))
    names = ["file", "length", "modified", *CONTENT]
    kept = entries.where("same").select(*names)
    # File names only: Spark's driver holds the whole listing anyway.
    paths = [r.path for r in entries.where(~F.col("same")).select("path").collect()]
    if not paths:
        return kept
    read = line_digests(spark.read.text(paths), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return kept.union(entries.where(~F.col("same")).select("file", "length", "modified").join(read, "file").select(*names))


def source_changes(current: DataFrame, last: DataFrame) -> DataFrame:
    """``file, status, lines_before, lines_after`` for files that are ``new``, ``gone``, or ``changed`` in content.

    A file with other times but the same lines has not changed.
    """
    before = last.select("file", *[F.col(c).alias(f"_{c}") for c in CONTENT], F.lit(True).alias("_was"))
    after = current.select("file", *CONTENT, F.lit(True).alias("_is"))
    differs = F.lit(False)
    for c in CONTENT:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    status = F.when(F.col("_was").isNull(), "new").when(F.col("_is").isNull(), "gone").when(differs, "changed")
    return (after.join(before, "file", "full").withColumn("status", status).where("status is not null")
            .select("file", "status", F.col("_lines").alias("lines_before"), F.col("lines").alias("lines_after")))


def write_ledger(current: DataFrame, ledger: str) -> int:
    """Publish the ledger; called when a run has done all its steps."""
    return publish(current, ledger)
