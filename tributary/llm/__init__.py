"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it; ``queries`` holds the thin
``opN_<name>`` queries and ``oracles`` their SQL.
"""
