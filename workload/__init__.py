"""Queries over the TPC-H-like test tables, with their SQL counterparts."""
