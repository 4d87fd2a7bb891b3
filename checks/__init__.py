"""Queries over the given tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from checks import errors, ledger, loads, names, reports, scans, targets, windows

GROUPS = [scans, windows, names, errors, targets, ledger, reports, loads]


def all_queries() -> dict:
    return {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for group in GROUPS for name, sql in group.ORACLES.items()}
