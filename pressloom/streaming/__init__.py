"""Append-mode streams."""
