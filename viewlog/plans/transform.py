"""Lazy plans that chain sources, cleaning, features and profiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from viewlog.operators.clean import clean, dedup
from viewlog.operators.features import fact_sessions, session_features
from viewlog.operators.profiles import profile_core, user_profiles
from viewlog.sources.tables import load_sessions_ev, load_sessions_or


def build_fact(sessions: DataFrame, unique: Callable[[DataFrame], DataFrame] = dedup) -> DataFrame:
    """logs_clean-shaped rows -> the 23-column fact table; ``unique`` as in ``clean``."""
    return sessions.transform(clean, unique).transform(session_features).transform(fact_sessions)


def fact_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(load_sessions_ev(spark, sf_dir))


def fact_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(load_sessions_or(spark, sf_dir))


def profiles_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_profiles(fact_or(spark, sf_dir))


def profile_core_or(spark: SparkSession, sf_dir: str, items: bool = False) -> DataFrame:
    """What the reports on profiles need: no apps, and items only if asked for."""
    return profile_core(fact_or(spark, sf_dir), items=items, apps=False)
