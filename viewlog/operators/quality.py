"""Data-quality report over the fact table and profiles, and the pipeline gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.schema import NULL_MAC_WARN_PCT


class QualityError(RuntimeError):
    """Raised by ``gate`` when a blocking check fails."""


def quality_report(fact: DataFrame, profiles: DataFrame,
                   warn_pct: float = NULL_MAC_WARN_PCT) -> DataFrame:
    """One row: table sizes, churned users, NULL-Mac rate, date range, statuses.

    An empty fact table fails; a NULL-Mac share above ``warn_pct`` warns.
    The fact figures come from one aggregate pass; the profile count is a
    scalar subquery.
    """
    profile_rows = profiles.select(F.count(F.lit(1))).scalar()
    # Informational: the churn distribution the original quality task promised.
    churned = (profiles.select(F.count_if(F.col("churn_label") == 1)).scalar()
               if "churn_label" in profiles.columns else F.lit(None).cast("bigint"))
    report = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("Mac").isNull()).alias("null_mac"),
        F.min("session_date").alias("min_date"),
        F.max("session_date").alias("max_date"),
    ).withColumns({"profile_rows": profile_rows, "churned_users": churned})
    pct = F.when(F.col("fact_rows") > 0,
                 F.round(F.col("null_mac") * 100.0 / F.col("fact_rows"), 2)).otherwise(F.lit(0.0))
    row_status = F.when(F.col("fact_rows") == 0, "FAIL").otherwise("OK")
    null_status = F.when(F.col("null_mac_pct") > warn_pct, "WARN").otherwise("OK")
    return (report.withColumn("null_mac_pct", pct)
                  .withColumn("row_count_status", row_status)
                  .withColumn("null_mac_status", null_status)
                  .withColumn("status", F.when(F.col("row_count_status") == "FAIL", "FAIL")
                                         .when(F.col("null_mac_status") == "WARN", "WARN")
                                         .otherwise("OK"))
                  .select("fact_rows", "profile_rows", "churned_users", "null_mac", "null_mac_pct",
                          "min_date", "max_date", "row_count_status", "null_mac_status", "status"))


def gate(report: DataFrame) -> dict:
    """Raise ``QualityError`` if the (one-row) report failed; return it as a dict."""
    row = report.first()
    result = row.asDict() if row is not None else {"status": "FAIL"}
    if result.get("status") == "FAIL":
        raise QualityError(f"data quality checks failed: {result}")
    return result


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows for a human look (schema via ``df.printSchema()``).

    A preview only: the limit is the feature, nothing downstream reads it.
    """
    return df.limit(n)
