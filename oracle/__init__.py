"""DuckDB SQL for every query that SQL can express, on the same parquet tables."""

from oracle.queries import ORACLES

__all__ = ["ORACLES"]
