"""Columns and small helpers that operators share."""
