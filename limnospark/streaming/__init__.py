"""Consolidation of files as they arrive."""
