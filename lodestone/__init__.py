"""Calibration and time-series array analytics on Spark DataFrames."""
