"""Incremental landing of registry files."""
