"""Ingest: text lines -> parsed records -> the fixed 16-column ``logs_clean``.

The output schema never depends on which keys the data happened to contain:
the parser returns the canonical columns, and only column discovery looks at
whole records (a MAP<STRING,STRING> column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.functions.casts import legacy_long, session_timestamp, try_float
from viewlog.functions.parse import parse_columns, parse_judged, parse_records
from viewlog.schema import COLUMN_ALIASES, KEEP_FIELDS, REQUIRED_KEYS


def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Text lines -> ``rec`` map; lines that are not dict literals are dropped."""
    return parse_records(lines, col).where(F.col("rec").isNotNull())


def has_required_key(rec: str = "rec") -> Column:
    cond = None
    for k in REQUIRED_KEYS:
        c = F.map_contains_key(rec, k)
        cond = c if cond is None else cond | c
    return cond


def keep_required(records: DataFrame) -> DataFrame:
    """Keep records with an exact ``Mac`` or ``MAC`` key, even if its value is None."""
    return records.where(has_required_key())


def _spellings() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {c: [c] for c in KEEP_FIELDS}
    for alias, canonical in COLUMN_ALIASES:
        if canonical in out and alias not in out[canonical]:
            out[canonical].append(alias)
    return out


def normalize_columns(records: DataFrame, rec: str = "rec") -> DataFrame:
    """Map -> one STRING column per kept field, aliases folded in.

    The canonical key wins, then aliases in their listed order; a field
    absent from a record is NULL.
    """
    cols = []
    for canonical, keys in _spellings().items():
        vals = [F.try_element_at(rec, F.lit(k)) for k in keys]
        cols.append((vals[0] if len(vals) == 1 else F.coalesce(*vals)).alias(canonical))
    return records.select(*cols)


def parse_session_timestamp(df: DataFrame) -> DataFrame:
    return df.withColumn("session_timestamp", session_timestamp(F.col("SessionMainMenu")))


def select_and_cast(df: DataFrame, *more: Column) -> DataFrame:
    """The 16 ``logs_clean`` columns, and ``more``."""
    extra = df.select(*more).columns
    return df.select(
        *[F.col(c) for c in KEEP_FIELDS if c not in ("RealTimePlaying", "ElapsedTimePlaying", "Duration")],
        try_float(F.col("RealTimePlaying")).alias("RealTimePlaying"),
        legacy_long(F.col("ElapsedTimePlaying")).alias("ElapsedTimePlaying"),
        legacy_long(F.col("Duration")).alias("Duration"),
        "session_timestamp", *more,
    ).select(*KEEP_FIELDS, "session_timestamp", *extra)


def ingest_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Whole ingest of a text-line DataFrame -> ``logs_clean`` rows."""
    return (parse_columns(lines, _spellings(), tuple(REQUIRED_KEYS), col)
            .transform(parse_session_timestamp).transform(select_and_cast))


def ingest_judged(lines: DataFrame, col: str = "value") -> DataFrame:
    """``logs_clean`` rows and rejected lines of one parse: ``verdict`` (accepted, rejected), ``reject_reason``, ``line``."""
    rows = parse_judged(lines, _spellings(), tuple(REQUIRED_KEYS), col).transform(parse_session_timestamp)
    verdict = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected").alias("verdict")
    return select_and_cast(rows, F.col("reject_reason"), F.col("line"), verdict)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected lines per reason."""
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines")).orderBy("reject_reason")


def discover_columns(lines: DataFrame, col: str = "value") -> DataFrame:
    """Every key seen in parsed, kept records and how many records carry it."""
    return (parse_lines(lines, col).transform(keep_required)
            .select(F.explode(F.map_keys("rec")).alias("column"))
            .groupBy("column").agg(F.count(F.lit(1)).alias("records"))
            .orderBy("column"))


def ingest_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines read, parsed, kept and rejected, in one pass over the text."""
    recs = parse_records(lines, col)
    staged = recs.select(F.col("rec").isNotNull().alias("parsed"),
                         F.coalesce(has_required_key(), F.lit(False)).alias("kept"))
    return staged.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("parsed").alias("parsed"),
        F.count_if("kept").alias("kept"),
        F.count_if(~F.col("kept")).alias("rejected"),
    )


def null_counts(logs: DataFrame, cols: tuple[str, ...] = (
        "Mac", "session_timestamp", "RealTimePlaying", "Event")) -> DataFrame:
    return logs.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
