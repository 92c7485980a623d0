"""Registered queries: each operator run on the given tables, with the SQL that must agree with it."""

from . import audits, joins, jobs, rows, schemas, scores, streams, texts  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
