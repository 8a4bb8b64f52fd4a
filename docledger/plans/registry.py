"""Every query over the driver's tables, with the SQL that an independent engine answers it by."""

from __future__ import annotations

from docledger.plans import documents, packages, references, structure, tables

_MODULES = (documents, structure, tables, references, packages)


def queries() -> dict:
    return {name: plan for m in _MODULES for name, (plan, _) in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql}
