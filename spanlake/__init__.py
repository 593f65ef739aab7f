"""Telemetry lakehouse operators on Spark."""
