"""Registered queries over the test tables, each with its DuckDB oracle."""

from strongroom.suite.registry import ORACLES, QUERIES  # noqa: F401
