"""Text log files: the line scan and the source presence check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_GLOB = "logt*.txt"


def read_text_logs(spark: SparkSession, path: str, glob: str = LOG_GLOB) -> DataFrame:
    """One row per line (column ``value``) of every file matching ``glob``.

    Lines split on LF, CRLF and CR. Raises if no file matches; the check
    uses the file index Spark builds on the driver anyway, no data is read.
    """
    df = spark.read.option("pathGlobFilter", glob).text(path)
    if not df.inputFiles():
        raise FileNotFoundError(f"no {glob} files under {path!r}")
    return df


def source_check(spark: SparkSession, path: str, glob: str = LOG_GLOB) -> DataFrame:
    """Files matching ``glob``: count, total MB, and whether there is work.

    Looks where the scan looks: in ``path`` itself, not in folders below it.
    Only file metadata (path, length) is selected, so the binary-file source
    does not read file contents.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .load(path).select("path", "length"))
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024), 3).alias("total_mb"),
        (F.count(F.lit(1)) > 0).alias("has_files"),
    )


def list_sources(spark: SparkSession, path: str, glob: str = LOG_GLOB) -> DataFrame:
    """Per-file name and size in MB, sorted by name."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("file"),
                    F.round(F.col("length") / (1024 * 1024), 3).alias("size_mb"))
            .orderBy("file"))
