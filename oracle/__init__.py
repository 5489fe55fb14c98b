"""DuckDB SQL of every registered operator, written independently of the Spark code."""

from . import analytics, operators

SQL = analytics.SQL | operators.SQL
