"""Registered queries over the test tables, each with its SQL twin."""

from importlib import import_module

# Modules that register queries.
MODULES = (
    "source_checks",
    "profile_checks",
    "range_checks",
    "conform_checks",
    "manifest_checks",
    "run_checks",
    "sink_checks",
    "stream_checks",
)


def all_checks():
    """Load every module of queries and return the registry."""
    for name in MODULES:
        import_module(f"rangehaul.checks.{name}")
    return import_module("rangehaul.checks.registry")
