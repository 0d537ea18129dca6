"""Rainfall analytics over hourly weather-station observations, on Spark."""
