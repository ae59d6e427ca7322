"""Reusable operators: conform, scd2, dims, report, quality."""
