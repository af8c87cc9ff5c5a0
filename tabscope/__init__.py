"""Profiling, cleaning, analysis and run telemetry as Spark DataFrame operators."""
