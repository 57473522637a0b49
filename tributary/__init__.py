"""Tributary: snapshot and change feeds of document collections, on Spark."""
