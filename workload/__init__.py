"""Queries over the driver tables, each with its SQL counterpart where SQL can express it."""

from workload import (  # noqa: F401
    q_evaluation,
    q_learning,
    q_monitor,
    q_records,
    q_retrieval,
    q_text,
)
from workload.registry import ORACLES, QUERIES  # noqa: F401
