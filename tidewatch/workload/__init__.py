"""The operators applied to the test tables, each next to its SQL equivalent."""

from tidewatch.workload import (
    drifting,
    feature,
    logged,
    quality,
    stored,
    streamed,
    tracked,
    trained,
)

MODULES = (feature, quality, trained, drifting, logged, tracked, stored, streamed)


def queries():
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
