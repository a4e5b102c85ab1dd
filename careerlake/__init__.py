"""Spark-native engine for job-posting data: records, lakehouse tables and telemetry."""
