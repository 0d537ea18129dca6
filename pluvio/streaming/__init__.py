"""Telemetry and observations as streams."""
