"""Logs, feature tables and sinks."""
