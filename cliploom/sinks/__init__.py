"""Sinks: metadata as JSON lines, tables, run logs."""
