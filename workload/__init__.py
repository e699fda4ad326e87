"""Queries and their SQL counterparts over the given test tables."""
