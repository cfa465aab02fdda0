"""Telemetry normalisation and correlation on Spark DataFrames."""
