"""Keyed query plans (one module per SURVEY §2 area)."""
