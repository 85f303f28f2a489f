"""Structured Streaming path for live telemetry."""
