"""Operators for preparing training data for language models.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their DuckDB SQL.
"""
