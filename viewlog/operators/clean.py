"""Cleaning: not-null filters, deduplication, fills and text normalisation.

``clean`` keeps the original order of steps (dedup, filters, fill, normalise),
except that the not-null filters run first: both filter columns are dedup
keys, so a group is either wholly dropped or wholly kept and the result is
the same, while less data reaches the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.schema import DEDUP_KEYS
from viewlog.session import written

#: Repeated key hashes (8 bytes each) up to which they are broadcast.
BROADCAST_KEYS = 1_000_000


def filter_not_null(df: DataFrame, cols: tuple[str, ...] = ("Mac", "session_timestamp")) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def _survivor_order(cols: list[str]) -> Column:
    # Ascending on every column, NULLs after values: (is_null, value) per column.
    fields = []
    for i, c in enumerate(cols):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def dedup(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key tuple; the survivor is the least row by all other columns.

    Written as ``groupBy(keys).agg(min(struct(...)))`` rather than a
    ``row_number`` window: the aggregate combines map-side, so a key holding a
    huge group of copies is reduced in every map task before the shuffle,
    and no task ever has to hold or sort a whole group. NULL keys group
    together, as in ``dropDuplicates``. Column order is kept.
    """
    keys = list(keys or DEDUP_KEYS)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    best = df.groupBy(*keys).agg(F.min(_survivor_order(others)).alias("_best"))
    picked = {c: F.col(f"_best.v{i}").alias(c) for i, c in enumerate(others)}
    return best.select(*[picked.get(c, F.col(c)) for c in df.columns])


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def repeated_keys(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``key``: the hashes of the key tuples that occur more than once, written.

    Reads the key columns only and shuffles one number per tuple. Two tuples
    of one hash count as repeated, which is harmless.
    """
    keys = list(keys or DEDUP_KEYS)
    found = df.select(_key_hash(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return written(found.where("n > 1").select("key"), "repeated-keys")


def dedup_hashed(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``dedup`` that leaves rows of unrepeated keys where they are: no sort and no shuffle for them.

    A first pass over the keys alone counts key hashes. Rows whose key occurs
    once pass through; the others take ``dedup``. They are told apart by a
    broadcast of the repeated hashes if a count proves these to be few; if they
    are many, all rows take ``dedup``.

    ``df`` is read up to three times, so it should be a scan of files, not an
    expensive plan. The first pass runs when called. Where a report needs the
    keys alone, ``dedup`` is cheaper: Catalyst prunes its other columns away.
    """
    keys = list(keys or DEDUP_KEYS)
    found = repeated_keys(df, keys)
    n = found.limit(BROADCAST_KEYS + 1).count()
    if not n:
        return df
    if n > BROADCAST_KEYS:
        return dedup(df, keys)
    found = F.broadcast(found.withColumnRenamed("key", "_repeated"))
    same = _key_hash(keys) == F.col("_repeated")
    return df.join(found, same, "left_anti").unionByName(dedup(df.join(found, same, "left_semi"), keys))


def fill_nulls(df: DataFrame) -> DataFrame:
    """Watch time and elapsed time default to zero; Duration stays NULL.

    ``fillna`` on a FLOAT column also replaces NaN.
    """
    return df.fillna({"RealTimePlaying": 0.0, "ElapsedTimePlaying": 0})


def normalize_text(df: DataFrame, cols: tuple[str, ...] = ("AppName", "Event")) -> DataFrame:
    # Spark's trim strips spaces only, not tabs or newlines.
    return df.withColumns({c: F.upper(F.trim(F.col(c))) for c in cols})


def clean(df: DataFrame, unique: Callable[[DataFrame], DataFrame] = dedup) -> DataFrame:
    """``unique`` is the deduplication: ``dedup``, or ``dedup_hashed`` over written rows."""
    return (df.transform(filter_not_null)
              .transform(unique)
              .transform(fill_nulls)
              .transform(normalize_text))


def clean_audit(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, as a one-row report.

    Both counts come from one scan and one shuffle: raw rows are counted per
    dedup group on the way into the group-by, kept rows are the groups.
    """
    kept_flag = F.col("Mac").isNotNull() & F.col("session_timestamp").isNotNull()
    per_group = df.groupBy(*DEDUP_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(kept_flag.cast("int")).alias("kept"))
    return per_group.agg(
        F.sum("n").cast("bigint").alias("rows_before"),
        F.sum("kept").cast("bigint").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def clean_observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``clean`` of written rows, with the rows it gives counted by the first action.

    Read the count with ``after.get["rows"]`` once the output is written, so
    that the audit runs no plan again; the rows before are in the footers of
    the files that ``df`` scans.
    """
    after = Observation("clean_after")
    return clean(df, dedup_hashed).observe(after, F.count(F.lit(1)).alias("rows")), after
