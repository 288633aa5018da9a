"""Charging-telemetry analytics and corpus preparation, expressed with Spark DataFrames."""
