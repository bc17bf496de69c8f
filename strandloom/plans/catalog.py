"""All queries of the library (but for the training-data subpackage) and the SQL that checks them."""

from __future__ import annotations

from strandloom.plans import align, files, qc, quant, records, scans, stats, table

_PARTS = (qc, table, quant, align, stats, files, records, scans)


def queries() -> dict:
    return {k: v[0] for part in _PARTS for k, v in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for part in _PARTS for k, v in part.QUERIES.items() if v[1]}
