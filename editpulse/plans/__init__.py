"""Composed queries: marts, serving queries, stored warehouse, declared contracts."""
