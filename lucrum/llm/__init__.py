"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers the thin ``opN_*`` queries and
``oracle`` their DuckDB SQL. Nothing outside this subpackage imports it.
"""
