"""All queries outside the optional subpackage, with their SQL."""

from __future__ import annotations

from postgrove.plans import dashboard, more, postings, problems

_PARTS = [problems, dashboard, postings, more]

QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLE = {k: v for part in _PARTS for k, v in part.ORACLE.items()}
