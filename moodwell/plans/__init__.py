"""Whole runs over the stored tables, and the registered queries with their SQL."""
