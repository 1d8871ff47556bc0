"""Operators bound to the driver tables.

Each registered query reads the driver tables (or data Spark derives from
them), runs one or more operators over the whole tables, and carries an
equivalent DuckDB SQL oracle where the semantics are expressible in SQL.
"""

from .registry import REGISTRY, oracle_sql, queries  # noqa: F401
