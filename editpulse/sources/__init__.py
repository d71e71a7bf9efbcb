"""Readers: topics, delimited files, tables, calendars and lookups."""
