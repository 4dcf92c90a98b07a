"""Scans: catalog tables, database connections, JSON files."""
