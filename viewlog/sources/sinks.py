"""Sinks: Parquet files, catalog tables and JDBC, plus load verification.

Writes are full refreshes, as in the original pipeline, but never in place: an
output is written beside the old one, its rows are verified, and only then it
takes the old one's name. A run that dies before leaves the old output as it
was, and a plan may read the output that it replaces. Row counts come from the
written files' metadata, never from running the plan a second time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from viewlog.schema import LOAD_BATCH_ROWS

# Upper bound on rows per output file, so a hot partition value (one app with
# most events) is split into many files instead of one huge one.
MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition_col: str | None = "AppName",
                      max_records: int = MAX_RECORDS_PER_FILE,
                      cluster_by: tuple[str, ...] = ("session_date", "session_timestamp")) -> str:
    """Publish ``df`` at ``path`` as Parquet, partitioned by ``partition_col`` if present.

    No repartition before the write: each task writes its own rows into
    the partition folders, so a value holding most rows is still written
    by all tasks in parallel. Inside each task the rows are sorted by the
    partition column (which the partitioned writer needs anyway) and then
    by time, so Parquet min/max statistics let date filters skip row groups.
    """
    part = [partition_col] if partition_col and partition_col in df.columns else []
    order = part + [c for c in cluster_by if c in df.columns][:1]
    if order:
        df = df.sortWithinPartitions(*order)
    publish(df, path, lambda w: (w.partitionBy(*part) if part else w).option("maxRecordsPerFile", max_records))
    return path


def write_parquet(df: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE) -> int:
    """Publish ``df`` at ``path`` as Parquet and return the number of rows written."""
    return publish(df, path, lambda w: w.option("maxRecordsPerFile", max_records))


class PublishError(RuntimeError):
    """An output could not be verified or moved; the old one is in place."""


def _place(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, fs = _place(spark, path)
    return fs.exists(place)


def _beside(path: str, kind: str, name: str = "") -> str:
    """A hidden sibling of ``path``: Spark's readers pass over names that begin with an underscore."""
    parent, _, base = path.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}/{base}{name}"


def publish(df: DataFrame, path: str, options: Callable[[DataFrameWriter], DataFrameWriter] = lambda w: w) -> int:
    """Write ``df`` beside ``path``, verify its rows, then put it in the place of what is there.

    The rows counted while writing must be those in the files' footers. Two
    renames make the exchange; if the second fails the old output is put back.
    Should the run die between them, the next ``publish`` or ``recover`` does so.
    """
    spark = df.sparkSession
    recover(spark, path)
    staged, seen = _beside(path, "staged", f"-{uuid.uuid4().hex}"), Observation(f"published-{uuid.uuid4().hex}")
    options(df.observe(seen, F.count(F.lit(1)).alias("rows")).write).parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged).count()
    if rows != seen.get["rows"]:
        raise PublishError(f"{staged} has {rows} rows, {seen.get['rows']} were written")
    _exchange(spark, staged, path)
    spark.catalog.refreshByPath(path)
    return rows


def publish_split(df: DataFrame, column: str, paths: Mapping[str, str],
                  options: Callable[[DataFrameWriter], DataFrameWriter] = lambda w: w, then_by: tuple[str, ...] = ()) -> dict[str, int]:
    """Publish the rows of each value of ``column`` at a path of its own, all written by one job.

    The folders that the partitioned write makes for the values are what takes
    the old outputs' places; below them it goes on by ``then_by``.
    """
    spark, first = df.sparkSession, next(iter(paths.values()))
    for path in paths.values():
        recover(spark, path)
    staged, seen = _beside(first, "staged", f"-{uuid.uuid4().hex}"), Observation(f"published-{uuid.uuid4().hex}")
    counts = [F.count_if(F.col(column) == value).alias(value) for value in paths]
    options(df.observe(seen, *counts).write).partitionBy(column, *then_by).parquet(staged)
    rows, schema = {}, df.drop(column).schema
    for value in paths:
        folder, fs = _place(spark, f"{staged}/{column}={value}")
        fs.mkdirs(folder)  # of a value without rows
        rows[value] = spark.read.schema(schema).parquet(f"{staged}/{column}={value}").count()
        if rows[value] != seen.get[value]:
            raise PublishError(f"{staged} has {rows[value]} rows of {value}, {seen.get[value]} were written")
    for value, path in paths.items():
        _exchange(spark, f"{staged}/{column}={value}", path)
        spark.catalog.refreshByPath(path)
    return rows


def write_judged(df: DataFrame, accepted: str, rejected: str, partition_col: str = "AppName",
                 max_records: int = MAX_RECORDS_PER_FILE) -> dict[str, int]:
    """Ingested rows to ``accepted`` by ``partition_col``, as ``write_partitioned`` does, and rejected lines to ``rejected``."""
    rows = df.sortWithinPartitions("verdict", partition_col, "session_timestamp")
    return publish_split(rows, "verdict", {"accepted": accepted, "rejected": rejected},
                         lambda w: w.option("maxRecordsPerFile", max_records), (partition_col,))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """``reject_reason, line`` of the rejected lines."""
    return spark.read.schema("reject_reason string, line string").parquet(path).select("reject_reason", "line")


def _exchange(spark: SparkSession, staged: str, path: str) -> None:
    (new, fs), (target, _) = _place(spark, staged), _place(spark, path)
    aside, _ = _place(spark, _beside(path, "replaced"))
    fs.mkdirs(target.getParent())
    replaced = fs.exists(target)
    if replaced:
        fs.mkdirs(aside.getParent())
        if not fs.rename(target, aside):
            raise PublishError(f"{path} cannot be moved aside")
    if not fs.rename(new, target):
        if replaced:
            fs.rename(aside, target)
        raise PublishError(f"{staged} cannot be moved to {path}")
    if replaced:
        fs.delete(aside, True)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an exchange that was cut off: the replaced output returns if nothing took its place; else it goes."""
    target, fs = _place(spark, path)
    aside, _ = _place(spark, _beside(path, "replaced"))
    if not fs.exists(aside):
        return False
    if fs.exists(target):
        fs.delete(aside, True)
        return False
    if not fs.rename(aside, target):
        raise PublishError(f"{path} cannot be restored")
    return True


def save_table(df: DataFrame, name: str, path: str | None = None,
               partition_col: str | None = None) -> str:
    """Replace catalog table ``name`` with ``df`` (Parquet).

    With ``path`` the table is external and its files live there (a shared
    folder); otherwise under the session's warehouse directory.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if partition_col and partition_col in df.columns:
        writer = writer.partitionBy(partition_col)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def external_table(spark: SparkSession, name: str, df: DataFrame, path: str, partition_col: str | None = None) -> str:
    """Make catalog table ``name`` an external one over the files at ``path``, which ``df`` reads.

    No data is copied: the table is the written output. A table that is there
    with these columns stays: its location follows the output, its folders are
    synchronised, and readers always find it. It is made anew only if its
    columns or partitioning differ, or a partitioned one moved.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    by = f" PARTITIONED BY (`{partition_col}`)" if partition_col else ""
    if _same_table(spark, name, df, path, partition_col):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        if partition_col:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet{by} LOCATION '{path}'")
        if partition_col:
            spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def _same_table(spark: SparkSession, name: str, df: DataFrame, path: str, partition_col: str | None) -> bool:
    """Whether the table has the columns and partitioning of ``df`` and, if partitioned, lies at ``path``."""
    if not spark.catalog.tableExists(name):
        return False
    columns = spark.catalog.listColumns(name)
    if {(c.name, c.dataType) for c in columns} != {(f.name, f.dataType.simpleString()) for f in df.schema}:
        return False
    if [c.name for c in columns if c.isPartition] != ([partition_col] if partition_col else []):
        return False
    place, fs = _place(spark, path)
    location = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")
    return not partition_col or _place(spark, location)[0].equals(fs.makeQualified(place))


#: Environment variables that name a target database; command-line options win over them.
JDBC_ENV = {"url": "VIEWLOG_JDBC_URL", "user": "VIEWLOG_JDBC_USER", "password": "VIEWLOG_JDBC_PASSWORD",
            "driver": "VIEWLOG_JDBC_DRIVER", "num_partitions": "VIEWLOG_JDBC_CONNECTIONS"}


def jdbc_settings(environ: Mapping[str, str], **given: str | None) -> dict[str, str] | None:
    """JDBC options from ``given`` values, else from the environment; None without a url."""
    found = {k: given.get(k) or environ.get(name) for k, name in JDBC_ENV.items()}
    if not found["url"]:
        return None
    n = found.pop("num_partitions")
    return jdbc_options(found.pop("url"), "", num_partitions=int(n) if n else None, **found)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_rows: int = LOAD_BATCH_ROWS,
                 num_partitions: int | None = None) -> dict[str, str]:
    """Options for ``df.write.format("jdbc")``; inserts go in batches of ``batch_rows``.

    ``truncate`` keeps the target's DDL (keys, indexes) on overwrite instead
    of dropping and recreating the table. ``numPartitions`` caps concurrent
    connections to the database.
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "truncate": "true"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    return opts


def jdbc_probe(spark: SparkSession, options: dict[str, str]) -> bool:
    """Run ``SELECT 1`` on the target database; raises if it is unreachable.

    Call before a load so a bad connection fails the run up front instead of
    after the upstream steps have finished.
    """
    probe = {k: v for k, v in options.items() if k not in ("dbtable", "batchsize", "truncate")}
    row = spark.read.format("jdbc").options(**probe).option("query", "SELECT 1 AS ok").load().first()
    return row is not None and row[0] == 1


def write_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """Distributed load into a database table: each task inserts its rows.

    Fails loudly when the database is unreachable.
    """
    df.write.format("jdbc").mode("overwrite").options(**options).save()


def jdbc_count(spark: SparkSession, options: dict[str, str]) -> int:
    """Rows of the target table, counted by the database."""
    query = {k: v for k, v in options.items() if k not in ("dbtable", "batchsize", "truncate")}
    return int(spark.read.format("jdbc").options(**query)
               .option("query", f"SELECT count(*) AS n FROM {options['dbtable']}").load().first()[0])


def verify_load(spark: SparkSession, table: str, source: DataFrame) -> DataFrame:
    """One row: rows in the loaded table vs rows in the source, and whether they match."""
    loaded = spark.table(table).select(F.count(F.lit(1))).scalar()
    expected = source.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        F.lit(table).alias("table_name"),
        expected.alias("source_rows"),
        loaded.alias("loaded_rows"),
        (loaded == expected).alias("matches"),
    )
