"""DuckDB SQL that recomputes each registered query independently."""

from oracle.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
