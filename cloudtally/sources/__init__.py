"""Landed responses, lookup files and snapshots."""
