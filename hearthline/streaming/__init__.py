"""Picking up new files as they arrive."""
