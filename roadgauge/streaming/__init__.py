"""Structured Streaming sources, windowed metrics, sinks and keyed state."""
