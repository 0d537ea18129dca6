"""Readers: station files, telemetry documents, table extracts."""
