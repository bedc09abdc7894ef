"""Nested records to curated tables, as plain Spark DataFrame jobs."""

from hitloom.operators.nested import array_columns, explode_outer_all, flatten, unpack
from hitloom.plans.medallion import curate, run_topic, run_topics
from hitloom.plans.topics import TOPICS
from hitloom.session import build_session

__all__ = [
    "TOPICS",
    "array_columns",
    "build_session",
    "curate",
    "explode_outer_all",
    "flatten",
    "run_topic",
    "run_topics",
    "unpack",
]
