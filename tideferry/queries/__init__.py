"""Registered queries: each operator run over whole Parquet tables.

A module holds ``QUERIES`` (name to function of session and folder) and
``ORACLE`` (name to the SQL that must give the same rows).
"""

from __future__ import annotations

from tideferry.queries import checks, control, files, runs, sales, texts

_MODULES = (checks, texts, control, files, runs, sales)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
