"""Temp views over the fact and profile tables, for ad-hoc Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(fact: DataFrame, profiles: DataFrame | None = None,
                   prefix: str = "") -> list[str]:
    """Expose the tables as temp views ``fact_sessions`` / ``user_profiles``."""
    names = [f"{prefix}fact_sessions"]
    fact.createOrReplaceTempView(names[0])
    if profiles is not None:
        names.append(f"{prefix}user_profiles")
        profiles.createOrReplaceTempView(names[1])
    return names
