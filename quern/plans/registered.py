"""All queries of the library's own operators."""

from . import chunk_queries, data_queries, io_queries, qa_queries

_MODULES = [qa_queries, chunk_queries, data_queries, io_queries]
QUERIES = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLE_SQL = {k: q for m in _MODULES for k, q in m.ORACLE_SQL.items()}
