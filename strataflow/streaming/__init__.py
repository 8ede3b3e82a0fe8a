"""Structured Streaming: telemetry from the broker to Gold."""
