"""Spark-native batch features, labels and grid rules for event logs."""
