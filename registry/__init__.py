"""Registered queries: every operator bound to the given tables, with the SQL that must agree."""

from registry import detections, ingest, inputs, reports, versions

MODULES = (detections, ingest, inputs, reports, versions)


def all_queries():
    return {name: run for m in MODULES for name, (run, _) in m.QUERIES.items()}


def all_sql():
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
