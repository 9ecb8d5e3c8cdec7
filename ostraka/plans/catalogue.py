"""The queries of the core and their SQL."""

from __future__ import annotations

from ostraka.plans import nested, profiles, records, retrieval, storage, texts

MODULES = (retrieval, texts, profiles, records, storage, nested)


def queries():
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}


def flagship(spark, root):
    return retrieval.bm25_topk(spark, root)
