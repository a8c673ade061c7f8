"""Registered whole-table queries (``catalog``) and their DuckDB twins (``oracle``)."""
