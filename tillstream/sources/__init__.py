"""Schemas, settings, table and stream readers."""
