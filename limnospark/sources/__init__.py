"""Readers of instrument files, tables and series, and the writers."""
