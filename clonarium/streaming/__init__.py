"""Picking up new per-entity files as they arrive."""
