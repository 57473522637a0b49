"""Catalogued plans: named queries and their SQL."""
