"""Queries over the driver tables, each with the SQL that must give the same rows.

The tables stand for a transcript collection: see the docstrings of the modules.
"""

from querybook import chunks, functions, listings, retrieval, storage

_MODULES = (listings, retrieval, functions, chunks, storage)


def queries():
    return {name: run for module in _MODULES for name, (run, _) in module.PAIRS.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, (_, sql) in module.PAIRS.items() if sql}
