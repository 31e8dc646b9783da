"""Registered queries over the given tables, each with SQL for the same result where SQL can say it."""

from flowlens.queries import (  # noqa: F401
    calibrating,
    cleaning,
    evaluating,
    modelling,
    planning,
    preparing,
    scanning,
    streaming,
    tracking,
)
from flowlens.queries.registry import ORACLES, QUERIES  # noqa: F401
