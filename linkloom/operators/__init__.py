"""Reusable table-in, table-out operators."""
