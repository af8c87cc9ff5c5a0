"""Continuous forms of the telemetry operators."""
