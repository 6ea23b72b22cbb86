"""Operators on event frames: ingest, ordered per-user rules, sessions, alerts and rollups."""
