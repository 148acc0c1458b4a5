"""Registered queries over the given tables, each with DuckDB SQL for the same rows."""
