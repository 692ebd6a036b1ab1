"""Jobs from logs to tables."""
