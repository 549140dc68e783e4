"""The operators and models over the synthetic star-schema tables, each with its SQL."""

from __future__ import annotations

from assayflow.queries import checks, incremental, ingest, models, transforms
from assayflow.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "incremental", "ingest", "models", "transforms"]
