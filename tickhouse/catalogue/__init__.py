"""Registered queries (Spark) and their SQL counterparts."""
