"""Registered queries of the library's own operators and their SQL oracles."""

from __future__ import annotations

from . import cases, queries, rendered

FLAGSHIP = "order_doc_roundtrip"
#: A function's query reads values rendered from the tables where SQL can say what comes out, else hand-worked cases.
_FROM = {name: rendered if name in rendered.RENDERED else cases for name in cases.CASES}
QUERIES = queries.QUERIES | rendered.EXTRA | {name: of.query(name) for name, of in _FROM.items()}
ORACLE_SQL = queries.ORACLE_SQL | rendered.EXTRA_SQL | {name: of.oracle(name) for name, of in _FROM.items()}
