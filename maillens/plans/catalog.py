"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from maillens.plans import (  # noqa: F401
    mail_queries,
    ml_queries,
    model_queries,
    text_queries,
    topic_queries,
    traffic_queries,
)
from maillens.plans.registry import QUERIES

__all__ = ["QUERIES"]
